"""JSON payloads as rows: paths of unknown depth, private keys, typed specifications, price series and trees."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions import columns as C

#: Keys of contact fields.
PRIVATE_KEYS = ("phone", "mobile", "seller_phone", "sellerPhone", "phone_number", "phoneNumber", "mobile_number", "mobileNumber", "whatsapp", "telegram", "instagram_id", "email", "contact_info")


def _walk(node: object, path: str = "") -> Iterator[tuple[str, str | None]]:
    if isinstance(node, dict) and node:
        for k, v in node.items():
            yield from _walk(v, f"{path}.{k}" if path else str(k))
    elif isinstance(node, list) and node:
        for i, v in enumerate(node):
            yield from _walk(v, f"{path}[{i}]")
    else:
        yield path, None if node is None else node if isinstance(node, str) else json.dumps(node, ensure_ascii=False)


def flatten_json(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, path, value) of each leaf of a JSON text at any depth, members joined by points and elements by [i].

    An empty object or array is a leaf; a text that is no JSON gives no rows; a null leaf has a null value.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, text in zip(frame["k"], frame["t"], strict=True):
                try:
                    node = json.loads(text)
                except (TypeError, ValueError):
                    continue
                out += [(k, p, v) for p, v in _walk(node)]
            yield pd.DataFrame(out, columns=[key, "path", "value"])

    kind = dict(rows.select(F.col(key).alias("k")).dtypes)["k"]
    return rows.select(F.col(key).alias("k"), F.col(payload).cast("string").alias("t")).mapInPandas(run, f"{key} {kind}, path string, value string")


def strip_keys(payload: Column, keys: tuple[str, ...] = PRIVATE_KEYS) -> Column:
    """a JSON text without the members of these names at any depth; what is no JSON becomes null."""
    names = frozenset(keys)

    def without(node: object) -> object:
        if isinstance(node, dict):
            return {k: without(v) for k, v in node.items() if k not in names}
        return [without(v) for v in node] if isinstance(node, list) else node

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            try:
                return json.dumps(without(json.loads(text)), ensure_ascii=False)
            except (TypeError, ValueError):
                return None
        return pd.Series([one(t) for t in texts], dtype=object)

    return run(payload)


SPECS = "groups array<struct<name: string, items: array<struct<key: string, value: string, type: string>>>>"


def specification_rows(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, group, position, slug, text, boolean, number, unit) of each item of a specification payload.

    A slug that a group repeats gets the place of its repeat as a suffix. Booleans come from declared booleans and the vocabulary.
    Payloads are dealt by their key, so all tasks parse, however few files the rows come from, and an item's place needs no second shuffle.
    """
    parsed = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key).select(key, F.from_json(payload, SPECS)["groups"].alias("g")).select(key, F.posexplode("g").alias("gi", "group"))
    items = parsed.select(key, "gi", F.col("group.name").alias("group"), F.posexplode("group.items").alias("position", "item"))
    w = Window.partitionBy(key, "gi", "base").orderBy("position")
    named = items.withColumn("base", C.slug(F.col("item.key"))).withColumn("n", F.row_number().over(w))
    value = F.col("item.value")
    m = C.measure(value)
    number = F.when(C.normalize_text(value).rlike(r"^-?[\d.,]"), m["number"])
    return named.select(key, "group", "position", F.when(F.col("n") > 1, F.concat_ws("_", "base", F.col("n").cast("string"))).otherwise(F.col("base")).alias("slug"), C.normalize_text(value).alias("text"),
                        F.when((F.col("item.type") == "Boolean") | number.isNull(), C.boolean_word(value)).alias("boolean"), F.when(F.col("item.type") != "Boolean", number).alias("number"), F.when((F.col("item.type") != "Boolean") & number.isNotNull(), m["unit"]).alias("unit"))


def series_id(*parts: Column) -> Column:
    """a stable id of a price series."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, 16)


PRICES = "items array<struct<detail: string, provider: string, history: array<struct<at: string, price: bigint>>>>"


def price_points(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, series_id, detail, provider_kind, point, at, price) of a price payload: points numbered in their order."""
    items = rows.select(key, F.explode(F.from_json(payload, PRICES)["items"]).alias("i"))
    kind = F.when(F.lower("i.provider").contains("market"), "market").when(F.lower("i.provider").contains("factory"), "factory").otherwise("other")
    points = items.select(key, series_id(F.col(key), F.col("i.detail")).alias("series_id"), F.col("i.detail").alias("detail"), kind.alias("provider_kind"), F.posexplode("i.history").alias("point", "h"))
    return points.select(key, "series_id", "detail", "provider_kind", "point", C.iso_timestamp(F.col("h.at")).alias("at"), F.nullif("h.price", F.lit(0)).alias("price"))


def series_sanity(points: DataFrame, series: str, at: str, reported: DataFrame | None = None, least: int = 2, most: int = 400) -> DataFrame:
    """V3: one row of counts: series out of the range of points, points without a time, days given twice, series whose number of points isn't the reported one."""
    by = points.groupBy(series).agg(F.count("*").alias("n"), F.count_if(F.col(at).isNull()).alias("untimed"), (F.count(at) - F.count_distinct(F.to_date(at))).alias("repeated"))
    if reported is not None:
        by = by.join(reported, series, "left")
    differs = F.count_if(~F.col("n").eqNullSafe(F.col("reported"))) if reported is not None else F.lit(0)
    return by.agg(F.count("*").alias("series"), F.count_if(~F.col("n").between(least, most)).alias("odd_size"), F.coalesce(F.sum("untimed"), F.lit(0)).alias("untimed_points"), F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated_days"), differs.alias("differing_counts"))


TREE = "brands array<struct<name: string, models: array<struct<name: string, trims: array<struct<name: string, price: bigint>>>>>>"


def tree_paths(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, path, level, price) of each node of a brand, model, trim tree; of a path given twice the last stands."""
    b = rows.select(key, F.posexplode(F.from_json(payload, TREE)["brands"]).alias("i", "b"))
    m = b.select(key, "i", "b", F.posexplode("b.models").alias("j", "m"))
    t = m.select(key, "i", "j", "b", "m", F.posexplode("m.trims").alias("l", "t"))
    none = F.lit(None).cast("bigint")
    brands = b.select(key, F.col("b.name").alias("path"), F.lit("brand").alias("level"), none.alias("price"), F.struct("i", F.lit(0).alias("j"), F.lit(0).alias("l")).alias("at"))
    models = m.select(key, F.concat_ws("/", "b.name", "m.name").alias("path"), F.lit("model").alias("level"), none.alias("price"), F.struct("i", "j", F.lit(0).alias("l")).alias("at"))
    trims = t.select(key, F.concat_ws("/", "b.name", "m.name", "t.name").alias("path"), F.lit("trim").alias("level"), F.col("t.price").alias("price"), F.struct("i", "j", "l").alias("at"))
    every = brands.unionByName(models).unionByName(trims)
    return every.groupBy(key, "path", "level").agg(F.max_by("price", "at").alias("price"))


DEALER = "id string, name string, score double, inventory array<struct<code: string, price: string, mileage: string>>"


def dealer_rows(rows: DataFrame, payload: str, seed: DataFrame, code: str) -> DataFrame:
    """(dealer, name, score, code, price, mileage, in_seed) of each listing in a dealer payload; scores without their point are descaled."""
    d = rows.select(F.from_json(payload, DEALER).alias("d")).select("d.*", F.explode("d.inventory").alias("i"))
    flat = d.select(F.col("id").alias("dealer"), "name", C.descale_bounded(F.col("score"), 0, 5)["value"].alias("score"), F.col("i.code").alias("code"), C.price(F.col("i.price")).alias("price"), C.mileage(F.col("i.mileage")).alias("mileage"))
    known = seed.select(F.col(code).cast("string").alias("code")).distinct().withColumn("in_seed", F.lit(True))
    return flat.join(known, "code", "left").withColumn("in_seed", F.coalesce("in_seed", F.lit(False)))


REVIEW = "title string, summary string, scores struct<total: string, quality: string>, price struct<from: string, to: string>"


def review_row(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """one typed row a review payload: texts normalised, decimals and prices parsed."""
    r = rows.select(key, F.from_json(payload, REVIEW).alias("r"))
    return r.select(key, C.normalize_text(F.col("r.title")).alias("title"), C.normalize_text(F.col("r.summary")).alias("summary"), C.decimal(F.col("r.scores.total")).alias("score"), C.decimal(F.col("r.scores.quality")).alias("quality"), C.price(F.col("r.price.from")).alias("price_from"), C.price(F.col("r.price.to")).alias("price_to"))


def cards(rows: DataFrame, payload: str) -> DataFrame:
    """(code, title, price, promoted) of the ads in a search payload: banners and entries without a code go, only a lump sum is a
    price, a pin or badge means promoted."""
    schema = "ads array<struct<type: string, code: string, title: string, price_type: string, price: string, pin: boolean, badge: string>>"
    ad = rows.select(F.explode(F.from_json(payload, schema)["ads"]).alias("a")).select("a.*").where("type = 'ad' and coalesce(code, '') <> ''")
    return ad.select("code", C.normalize_text(F.col("title")).alias("title"), F.when(F.col("price_type") == "lumpsum", C.price(F.col("price"))).alias("price"), (F.coalesce("pin", F.lit(False)) | (F.coalesce("badge", F.lit("")) != "")).alias("promoted"))
