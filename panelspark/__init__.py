"""Analytics over repeatedly observed inventories, as PySpark DataFrame operators."""
