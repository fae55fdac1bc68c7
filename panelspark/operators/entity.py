"""Re-listed items: lossless blocking, weighted pair score, one-to-one matching, entity closure."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce
from itertools import combinations
from math import log1p

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from panelspark.functions import columns as C
from panelspark.sources.work import cut, drop


@dataclass(frozen=True)
class Match:
    """Weights and tolerances of the pair score, and the threshold of a match."""

    taxonomy: float = 0.30
    seller: float = 0.20
    mileage: float = 0.15
    price: float = 0.10
    city: float = 0.05
    image: float = 0.20
    description: float = 0.15
    colors: float = 0.05
    mileage_tolerance: int = 5_000
    price_ratio: float = 0.12
    description_min: float = 0.72
    threshold: float = 0.70


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two normalised texts, 0 where either is shorter than 25."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x, y).ratio() if len(x or "") >= TEXT and len(y or "") >= TEXT else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")


FIELDS = ("id", "brand", "model", "year", "seller", "mileage", "price", "city", "images", "description", "body_color", "interior_color")
PARTS, BITS = 9, 64


def image_bits(images: Column) -> Column:
    """(bits, hashed) of each image hash: its 64 bits, or those of a hash of it where it has another form."""

    def of(h: Column) -> Column:
        hashed = ~h.rlike("^[0-9a-fA-F]{16}$")
        return F.struct(F.when(hashed, F.xxhash64(h)).otherwise(F.conv(h, 16, -10).cast("long")).alias("bits"), hashed.alias("hashed"))

    return F.transform(F.array_compact(images), of)


def image_parts(bits: Column) -> Column:
    """Keys of the bits of images: within eight bits of 64 at least one of nine parts is equal. A hash of another form is one key."""
    cuts = [BITS * i // PARTS for i in range(PARTS + 1)]
    part = lambda x, i: F.xxhash64(F.lit(i), F.shiftrightunsigned(x["bits"], BITS - cuts[i + 1]).bitwiseAND((1 << cuts[i + 1] - cuts[i]) - 1))
    return F.array_distinct(F.flatten(F.transform(bits, lambda x: F.when(x["hashed"], F.array(F.xxhash64(F.lit(-1), x["bits"]))).otherwise(F.array(*[part(x, i) for i in range(PARTS)])))))


NORMED = ("brand", "model", "year", "seller", "city", "body_color", "interior_color")
#: Least length of a description that is compared.
TEXT = 25


def block_keys(m: Match) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
    """(fields, fields that must be there): each match agrees on the fields of at least one key.

    Every match holds one of the smallest sets of signals whose weights reach the threshold. Such a set's key is made of
    its exact fields and of its mileage or price cells (both where there are only three fields); the image joins in where fewer than three of these are left. A description
    can't be a key, so it has to be there on both sides. A key whose fields include another's is left out.
    """
    weights = {"taxonomy": m.taxonomy, "seller": m.seller, "mileage": m.mileage, "price": m.price, "city": m.city, "colors": m.colors, "image": m.image, "description": m.description}
    least: list[frozenset[str]] = []
    for size in range(1, len(weights) + 1):
        for some in map(frozenset, combinations(weights, size)):
            if round(min(sum(weights[x] for x in some), 1.0), 4) >= m.threshold and not any(x <= some for x in least):
                least.append(some)
    keys: set[tuple[frozenset[str], frozenset[str]]] = set()
    for some in least:
        fields = some - {"description", "image"}
        fields = fields | (some & {"image"}) if len(fields) < 3 else fields
        fields = fields - {"price"} if "mileage" in fields and len(fields) > 3 else fields  # a second field of cells triples a parent's keys
        keys.add((fields, some & {"description", "image"} - fields))
    apart = [k for k in keys if not any(o != k and o[0] <= k[0] and o[1] <= k[0] | k[1] for o in keys)]
    return sorted((tuple(x for x in weights if x in f), tuple(x for x in weights if x in there)) for f, there in apart)


#: Width of a cell of mileage or price, in reaches; a parent's reach covers one or two cells.
CELL = 4
#: The signals in order of their bits in a mask: (name of the verdict, field).
SIGNALS = (("brand_model_year", "taxonomy"), ("same_seller", "seller"), ("mileage_close", "mileage"), ("price_close", "price"), ("city", "city"), ("image_hash", "image"), ("description_similar", "description"), ("colors", "colors"))


def _lines(m: Match, miles: Column, price: Column) -> dict[str, tuple[Column, float]]:
    """(place, reach) of a mileage and a price: values within the tolerance are at most a reach apart. The scale of prices is logarithmic from 1 on and linear below."""
    cost = price.cast("double")
    return {"mileage": (miles, m.mileage_tolerance * 1.0 + 1.0), "price": (F.when(cost >= 1, F.ln(cost)).otherwise(cost - 1), -log1p(-m.price_ratio) * (1 + 1e-9))}


def _cell(line: tuple[Column, float], side: int = 0) -> Column:
    """The cell of a place, or of the least (-1) or greatest (1) place in its reach."""
    at, reach = line
    return F.floor((at + side * reach) / (CELL * reach)).cast("long")


def _packed(line: tuple[Column, float]) -> Column:
    """Four times the cell of a place, and 1 where its reach goes on into the next cell, 2 where into the one before."""
    cell, low, high = (_cell(line, side) for side in (0, -1, 1))
    return cell * 4 + (high > cell).cast("int") + (low < cell).cast("int") * 2


def _meets(child: Column, parent: Column) -> Column:
    """Whether the child's cell is one of those in the parent's reach, of packed cells."""
    step = F.shiftright(child, 2) - F.shiftright(parent, 2)
    return (step == 0) | ((step == 1) & _has(parent, 1)) | ((step == -1) & _has(parent, 2))


def _prepared(rows: DataFrame, order: str | None, m: Match) -> DataFrame:
    """Rows with normalised fields (n_), the taxonomy, BRIEF and what block keys are made of, written once.

    A key field is a 64-bit hash, null where it is missing. Columns of BRIEF are what a pair is scored on at first sight: facts has the number of images (2 for more,
    and for one that is no 64-bit hash), 4 for a text that is compared, 8 for a field that is there and blank.
    """
    out = rows.select(*FIELDS, *([F.col(order).alias("order")] if order else []))
    out = out.withColumns({f"n_{c}": C.norm(F.col(c)) for c in NORMED})
    raw = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    named = lambda *cs: F.when(reduce(Column.__and__, map(raw, cs)), F.xxhash64(*[F.col(f"n_{c}") for c in cs]))
    out = out.withColumn("__bits", image_bits(F.coalesce(F.col("images"), F.array().cast("array<string>"))))
    images = F.col("__bits")
    pictures = F.when((F.size(images) > 1) | F.coalesce(F.get(images, 0)["hashed"], F.lit(False)), 2).otherwise(F.size(images))
    described = F.coalesce(F.length(C.norm(F.col("description"))) >= TEXT, F.lit(False))
    lines = _lines(m, F.col("mileage"), F.when(F.col("price") != 0, F.col("price")))
    blank = reduce(Column.__or__, [raw(c) & (F.col(f"n_{c}") == "") for c in NORMED])
    made = {
        "taxonomy": F.when(raw("brand") & raw("model") & raw("year"), F.concat_ws("|", *[F.col(f"n_{c}") for c in ("brand", "model", "year")])),
        "__taxonomy": named("brand", "model", "year"), "__seller": named("seller"), "__city": named("city"), "__colors": named("body_color", "interior_color"),
        "__miles": F.col("mileage"), "__price": F.when(F.col("price") != 0, F.col("price")), "__bits": F.when(F.size(images) == 1, F.get(images, 0)["bits"]),
        "__mileage": _packed(lines["mileage"]), "__cost": _packed(lines["price"]), "__facts": (pictures + F.when(described, 4).otherwise(0) + F.when(blank, 8).otherwise(0)).cast("int"), "__image": image_parts(images),
    }
    return cut(out.withColumns(made).drop("description"))


#: Columns that travel with a block key: hashes, numbers, the bits of an only image, facts.
BRIEF = ("taxonomy", "seller", "city", "colors", "miles", "price", "mileage", "cost", "bits", "facts")
#: Rows up to which those that agree on an image key's other fields meet without parts of their images.
FEW = 64


def _has(facts: Column, bit: int) -> Column:
    return facts.bitwiseAND(bit) != 0


def _pictured(facts: Column) -> Column:
    return facts.bitwiseAND(3) > 0


def _block_hashes(m: Match) -> tuple[list[Column], list[Column]]:
    """(k, at) of the keys without image parts, and of the other fields of those with them; null where a field is missing.

    A child has the cell of its mileage and price, a parent the one or two cells in reach, its own among them: at is twice the key's number,
    and one more where a child has the key too.
    """
    cells, facts = {"mileage": F.col("__mileage"), "price": F.col("__cost")}, F.col("__facts")
    single, many = [], []
    for number, (names, there) in enumerate(block_keys(m)):
        ways: list[tuple[list[Column], list[Column], Column]] = [([F.lit(number)], [], F.lit(True))]
        for name in (x for x in names if x != "image"):
            if name in cells:
                cell, packed = F.shiftright(cells[name], 2), cells[name]
                near = ((cell, cell.isNotNull(), F.lit(True)), (cell + 1, _has(packed, 1), F.lit(False)), (cell - 1, _has(packed, 2), F.lit(False)))
                ways = [([*w, at], [*held, held_at], own & mine) for w, held, own in ways for at, held_at, mine in near]
            else:
                ways = [([*w, F.col(f"__{name}")], [*held, F.col(f"__{name}").isNotNull()], own) for w, held, own in ways]
        present = [_has(facts, 4) if x == "description" else _pictured(facts) for x in (*there, *(x for x in names if x == "image"))]
        for w, held, own in ways:
            made = F.struct(F.xxhash64(*w).alias("k"), (2 * number + own.cast("int")).alias("at"))
            (many if "image" in names else single).append(F.when(reduce(Column.__and__, [*held, *present], F.lit(True)), made))
    return single, many


def _keyed(prepared: DataFrame, hashes: list[Column], *more: str) -> DataFrame:
    """(id, order, BRIEF, more, k, at): every key of a row."""
    ends = ["id", *(x for x in ("order", "held") if x in prepared.columns), *[f"__{x}" for x in BRIEF], *more]
    there = {f"__{x}": F.coalesce(f"__{x}", F.lit(0)) for x in ("bits", "facts")}
    return prepared.withColumns(there).select(*ends, F.explode(F.array_compact(F.array(*hashes))).alias("key")).select(*ends, "key.*")


OWN = "at % 2 = 1"


def _with_images(c: DataFrame, p: DataFrame, hashes: list[Column]) -> list[DataFrame]:
    """Rows of both sides by the keys with images. Those of few rows that agree on the other fields have one key; those of more have one for each part of their images."""
    sides = [_keyed(c, hashes, "__image")] if c is p else [_keyed(c, hashes, "__image").where(OWN), _keyed(p, hashes, "__image")]
    child, parent = (F.expr(OWN), F.lit(True)) if c is p else (F.col("side") == 0, F.col("side") == 1)
    ends = reduce(DataFrame.unionByName, [x.select("k", "id", "at", F.lit(i).alias("side")) for i, x in enumerate(sides)])
    both = ends.groupBy("k").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count_if(child).alias("c"), F.count_if(parent).alias("p"))
    met = both.where("c > 0 and p > 0 and a <> b").select("k", (F.greatest("c", "p") <= FEW).alias("few"))
    parts = F.when(F.col("few"), F.array("k")).otherwise(F.array_distinct(F.transform("__image", lambda part: F.xxhash64("k", part))))
    return [x.join(met, "k").withColumn("k", F.explode(parts)).drop("__image", "few") for x in sides]


def _scores(m: Match) -> list[float]:
    """The score of each mask of signals; taxonomy alone is never enough."""
    weights = [getattr(m, field) for _, field in SIGNALS]
    totals = [sum(w for i, w in enumerate(weights) if mask >> i & 1) for mask in range(1 << len(weights))]
    return [-1.0 if mask == 1 else float(Decimal(repr(min(float(x), 1.0))).quantize(Decimal("1.0000"), ROUND_HALF_UP)) for mask, x in enumerate(totals)]


def _first_keys(m: Match) -> list[int]:
    """Of each mask of fields that two rows share, the number of the first key without images on which they meet; -1 for none."""
    at = {field: 1 << i for i, (_, field) in enumerate(SIGNALS)}
    keys = [(number, sum(at[x] for x in (*fields, *there))) for number, (fields, there) in enumerate(block_keys(m)) if "image" not in fields]
    return [next((number for number, key in keys if key & mask == key), -1) for mask in range(1 << len(SIGNALS))]


def _mask(parts: dict[str, Column]) -> Column:
    return reduce(Column.__add__, [F.when(F.coalesce(parts[field], F.lit(False)), 1 << i).otherwise(0) for i, (_, field) in enumerate(SIGNALS)])


def _met(c: DataFrame, p: DataFrame, m: Match) -> DataFrame:
    """(c_id, p_id, hits, sure): each pair that can reach the threshold, once; hits are its signals as a mask, at most so where it isn't sure.

    A pair meets on each key that its rows share and is kept on the first. Nothing but its ids and its mask leaves the join, and no
    shuffle follows, so disk follows the rows and not the pairs. Of one table that is both sides the keys are shuffled once.
    """
    of = lambda x: (F.col(f"c___{x}"), F.col(f"p___{x}"))
    both = lambda x: of(x)[0] == of(x)[1]
    miles, price, bits, facts = of("miles"), of("price"), of("bits"), of("facts")
    same = {x: both(x) for x in ("taxonomy", "seller", "city", "colors")}
    pictured, more = _pictured(facts[0]) & _pictured(facts[1]), _has(facts[0].bitwiseOR(facts[1]), 2)
    described = _has(facts[0].bitwiseAND(facts[1]), 4)
    hits = _mask({**same, "mileage": F.abs(miles[1] - miles[0]) <= m.mileage_tolerance, "price": F.abs(price[1] - price[0]) / F.greatest(price[1], F.lit(1)) <= m.price_ratio,
                  "image": pictured & (more | (F.bit_count(bits[0].bitwiseXOR(bits[1])) <= BITS // 8)), "description": described})
    first = F.get(F.lit(_first_keys(m)), _mask({**same, "mileage": _meets(*of("mileage")), "price": _meets(*of("cost")), "image": pictured, "description": described}))
    # a child's own cells, said of both sides, so that the sides stay one plan and one shuffle
    near = [F.col("c_at").bitwiseAND(1) * 2 > F.col("p_at").bitwiseAND(1), F.col("c_id") != F.col("p_id"), *([F.col("p_order") < F.col("c_order")] if "order" in c.columns else []), F.get(F.lit(_scores(m)), hits) >= m.threshold]
    near += [F.col("p_held").isNull() | (F.col("c_id") < F.col("p_held"))] if "held" in p.columns else []
    side = lambda df, s: df.select("k", *[F.col(x).alias(f"{s}_{x}") for x in df.columns if x != "k"])

    def pairs(children: DataFrame, parents: DataFrame, kept: Column) -> DataFrame:
        # a table of keys is many times the file it comes from, so it's never broadcast
        found = side(children, "c").join(side(parents, "p").hint("merge"), "k").where(reduce(Column.__and__, [*near, kept]))
        return found.select("c_id", "p_id", hits.alias("hits"), (~(described | pictured & more | _has(facts[0].bitwiseOR(facts[1]), 8))).alias("sure"))

    single, many = _block_hashes(m)
    out = []
    if single:
        keys = _keyed(p, single)
        out.append(pairs(keys if c is p else _keyed(c, single).where(OWN), keys, first == F.shiftright("c_at", 1)))
    if many:
        keys = _with_images(c, p, many)
        out.append(pairs(keys[0], keys[-1], first < 0).distinct())
    return reduce(DataFrame.unionByName, out)


def _wide(pairs: DataFrame, c: DataFrame, p: DataFrame) -> DataFrame:
    """Pairs with the fields of both rows under prefixes."""
    side = lambda df, s: df.select(*[F.col(x).alias(f"{s}_{x}") for x in df.columns if x not in ("order", "held") and not x.startswith("__")])
    return pairs.join(side(c, "c"), "c_id").join(side(p, "p"), "p_id")


def _sides(children: DataFrame, parents: DataFrame, order: str | None, m: Match) -> tuple[DataFrame, DataFrame]:
    c = _prepared(children, order, m)
    return c, c if parents is children else _prepared(parents, order, m)


def candidates(children: DataFrame, parents: DataFrame, order: str | None = None, m: Match = Match()) -> DataFrame:
    """Pairs that can reach the threshold, by one equi-join on the keys of ``block_keys``; with an order column parents come before their children.

    No taxonomy or seller alone is a block: a key has three fields or more, or as many as the weights leave. Rows carry a few numbers with
    their keys, so a pair out of reach ends in the join, and only ids leave it.
    """
    c, p = _sides(children, parents, order, m)
    return _wide(_met(c, p, m).select("c_id", "p_id"), c, p)


def _clash(*sides: DataFrame) -> bool:
    """Whether two texts of a field have one hash, so that rows have to be compared themselves."""
    fields = {"taxonomy": ["brand", "model", "year"], "seller": ["seller"], "city": ["city"], "colors": ["body_color", "interior_color"]}
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("field"), F.col(f"__{x}").alias("h"), F.array(*[F.col(f"n_{c}") for c in cs]).alias("text")) for x, cs in fields.items()]))
    texts = reduce(DataFrame.unionByName, [x.select(each.alias("x")).select("x.*").where("h is not null") for x in sides]).distinct()
    return not texts.groupBy("field", "h").count().where("count > 1").isEmpty()


def signals(m: Match, described: Column) -> list[tuple[str, Column, float]]:
    """(name, condition, weight); described: the similarity of the descriptions."""
    both = lambda f: F.col(f"p_n_{f}") == F.col(f"c_n_{f}")
    there = lambda f: F.coalesce(F.col(f"p_{f}"), F.lit("")) != ""
    return [
        ("brand_model_year", F.col("p_taxonomy") == F.col("c_taxonomy"), m.taxonomy), ("same_seller", there("seller") & both("seller"), m.seller),
        ("mileage_close", F.abs(F.col("p_mileage") - F.col("c_mileage")) <= m.mileage_tolerance, m.mileage),
        ("price_close", (F.col("p_price") != 0) & (F.col("c_price") != 0) & (F.abs(F.col("p_price") - F.col("c_price")) / F.greatest(F.col("p_price"), F.lit(1)) <= m.price_ratio), m.price),
        ("city", there("city") & both("city"), m.city), ("image_hash", C.image_overlap(F.col("p_images"), F.col("c_images")) > 0, m.image), ("description_similar", described >= m.description_min, m.description),
        ("colors", there("body_color") & both("body_color") & there("interior_color") & both("interior_color"), m.colors),
    ]


def scored_pairs(children: DataFrame, parents: DataFrame, m: Match = Match(), order: str | None = None) -> DataFrame:
    """(c_id, p_id, score, matched): candidates that reach the threshold, taxonomy alone never enough.

    Texts are compared only for pairs that the other signals leave within reach.
    """
    c, p = _sides(children, parents, order, m)
    return _scored(c, p, children, parents, m)


def _scored(c: DataFrame, p: DataFrame, children: DataFrame, parents: DataFrame, m: Match) -> DataFrame:
    """Pairs are scored in the join, but those with texts, several images or blank fields on their rows."""
    sides = [c] if c is p else [c, p]
    met, clash = _met(c, p, m), _clash(*sides)
    plain = not clash and all(x.where("__facts > 1").isEmpty() for x in sides)
    names = F.array_compact(F.array(*[F.when(_has(F.col("hits"), 1 << i), n) for i, (n, _) in enumerate(SIGNALS)]))
    seen = (met if plain else met.where("sure")).select("c_id", "p_id", F.get(F.lit(_scores(m)), F.col("hits")).alias("score"), names.alias("matched"))
    if plain:
        return seen
    hit = lambda c: F.coalesce(c, F.lit(False))
    cheap = [x for x in signals(m, F.lit(0.0)) if x[0] != "description_similar"]
    partial = sum((F.when(hit(c), w).otherwise(0.0) for _, c, w in cheap), F.lit(0.0))
    unsure = (met if clash else met.where("not sure")).select("c_id", "p_id")
    near = _wide(unsure, c, p).where(F.round(F.least(partial + m.description, F.lit(1.0)), 4) >= m.threshold)
    near = near.select("c_id", "p_id", *[hit(c).alias(f"is_{n}") for n, c, _ in cheap])  # texts meet the verdicts, not the rows
    text = lambda rows, side: rows.select(F.col("id").alias(f"{side}_id"), C.norm(F.col("description")).alias(f"{side}_text")).where(F.length(f"{side}_text") >= TEXT)
    described = near.join(text(children, "c"), "c_id", "left").join(text(parents, "p"), "p_id", "left").withColumn("described", similarity("p_text", "c_text"))
    parts = [(n, F.col("described") >= m.description_min if n == "description_similar" else F.col(f"is_{n}"), w) for n, _, w in signals(m, F.col("described"))]
    total = sum((F.when(hit(c), w).otherwise(0.0) for _, c, w in parts), F.lit(0.0))
    out = described.select("c_id", "p_id", F.round(F.least(total, F.lit(1.0)), 4).alias("score"), F.array_compact(F.array(*[F.when(hit(c), n) for n, c, _ in parts])).alias("matched"))
    out = out.where(F.col("score") >= m.threshold).where(~((F.size("matched") == 1) & F.array_contains("matched", "brand_model_year")))
    return out if clash else seen.unionByName(out)


def match_one_to_one(pairs: DataFrame) -> DataFrame:
    """(c_id, p_id, score): each child in order of id takes its best parent not yet claimed (best score, then least id).

    Choices in one connected component of children and parents don't touch another's. Components are dealt to tasks and sorted by child;
    a task reads its edges in that order and keeps the claimed parents that a later child still asks for, so neither the number of
    jobs nor the memory follows the length of a chain of claims. Null ids match nothing; of repeated pairs the best score counts.
    """
    edges = pairs.where("c_id is not null and p_id is not null").groupBy("c_id", "p_id").agg(F.max("score").alias("score"))
    edges = cut(edges.withColumns({"c_node": F.xxhash64(F.lit("c"), "c_id"), "p_node": F.xxhash64(F.lit("p"), "p_id")}))
    labels = entity_closure(edges, "c_node", "p_node")
    last = edges.groupBy("p_id").agg(F.max("c_id").alias("last_child"))
    found = edges.join(last, "p_id").join(labels.select(F.col("node").alias("c_node"), "entity"), "c_node")
    asked = found.select("entity", "c_id", "p_id", "score", (F.col("c_id") == F.col("last_child")).alias("is_last"))
    sorted_edges = asked.repartition("entity").sortWithinPartitions("entity", "c_id", F.desc("score"), "p_id").drop("entity")

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claimed, child, matched, ending = set(), None, False, []
        for frame in frames:
            chosen = []
            for c, p, score, is_last in zip(frame["c_id"].tolist(), frame["p_id"].tolist(), frame["score"].tolist(), frame["is_last"].tolist(), strict=True):
                if c != child:
                    claimed.difference_update(ending)
                    child, matched, ending = c, False, []
                if not matched and p not in claimed:
                    matched = True
                    claimed.add(p)
                    chosen.append((c, p, score))
                if is_last:
                    ending.append(p)
            yield pd.DataFrame(chosen, columns=["c_id", "p_id", "score"])

    out = cut(sorted_edges.mapInPandas(choose, asked.select("c_id", "p_id", "score").schema))
    drop(edges, labels)
    return out


#: Best parents of a child that are matched first, how many times as many those ask for next that get none of them, and rounds; the last takes all that is left.
LIST, GROW, ROUNDS = 32, 8, 3


def matches(children: DataFrame, parents: DataFrame, order: str | None = None, m: Match = Match()) -> DataFrame:
    """E2 over ``scored_pairs``: (c_id, p_id, score) as ``match_one_to_one`` gives it, without a table of all pairs.

    Each child's best parents alone leave the tasks that join pairs. A child that gets none of them though it has more asks again, for parents that no
    earlier child holds: a parent only ever passes to an earlier child, so the others can't be had any more. A child that is matched within its list
    would take the same parent of a longer one, so the result is the serial one when no child with more to ask for is left unmatched. After
    the last but one round all children with longer lists get all that can still be had, so the rounds are few whatever the chains of claims.
    """
    c, p = _sides(children, parents, order, m)
    asked, offered, lists, more, made = c, p, [], None, [c] if c is p else [c, p]
    best_first = Window.partitionBy("c_id").orderBy(F.desc("score"), "p_id")  # limited before the shuffle
    for turn in range(ROUNDS):
        most, last = LIST * GROW**turn, turn == ROUNDS - 1
        pairs = _scored(asked, offered, children, parents, m).select("c_id", "p_id", "score")
        best = cut(pairs.withColumn("place", F.lit(1)) if last else pairs.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= most + 1))
        lists.append(best.where(F.col("place") <= most).select("c_id", "p_id", "score"))
        longer = best.where(F.col("place") > most).select("c_id")
        more = longer if more is None else more.join(short, "c_id", "left_anti").unionByName(longer)
        found = match_one_to_one(reduce(DataFrame.unionByName, lists))
        made.append(best)
        short = more.join(found.select("c_id"), "c_id", "left_anti")
        if last or short.isEmpty():
            break
        short = cut(more if turn == ROUNDS - 2 else short)
        asked = cut(c.join(short.select(F.col("c_id").alias("id")), "id", "left_semi"))
        offered = cut(p.join(found.select(F.col("p_id").alias("id"), F.col("c_id").alias("held")), "id", "left"))
        made += [short, asked, offered, found]
    drop(*made)
    return found


def entity_closure(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, entity): least id of all nodes joined by links.

    Null ends and self loops add nothing; repeated links count once; no links give no rows. Each round every node takes its least
    neighbour if that is less (pre-aggregated before the shuffle), pointers are followed twice, and the links are drawn between what
    the nodes took, once each and without loops. A component of n nodes needs about log n rounds over ever fewer links; the
    rounds' pointers are joined at the end.
    """
    one = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    edges = cut(one.unionByName(one.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    taken: list[DataFrame] = []
    while not taken or not edges.isEmpty():
        near = edges.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("to"))
        for _ in range(2):
            near = near.join(near.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").select("node", F.col("next").alias("to"))
        taken.append(cut(near))
        ends = [taken[-1].select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in ("x", "y")]
        drawn = cut(edges.join(ends[0], "x").join(ends[1], "y").where("x_to <> y_to").select(F.col("x_to").alias("x"), F.col("y_to").alias("y")).distinct())
        drop(edges)
        edges = drawn
    labels = taken[0].withColumnRenamed("to", "entity")
    for later in taken[1:]:
        labels = labels.join(later.select(F.col("node").alias("entity"), "to"), "entity", "left").select("node", F.coalesce("to", "entity").alias("entity"))
    out = cut(labels)
    drop(edges, *taken)
    return out
