"""Shared tables and components for the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspark.operators.entity import entity_closure
from panelspark.sources.work import cut, drop, shared_folder

__all__ = ["connected_components", "cut", "drop", "shared_folder"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of any orderable type to (node, label): label is the least node reachable. Null ends and self loops add
    nothing; repeated edges count once; no edges give no rows."""
    return entity_closure(edges, *edges.columns[:2]).withColumnRenamed("entity", "label")
