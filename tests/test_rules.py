"""Operators on small frames: re-listings against every pair, event logs, payloads, shapes, merges and columns without a query."""

import itertools
import json
import random
from datetime import datetime
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from panelspark.functions import columns as C
from panelspark.operators import associations as A
from panelspark.operators import entity as E
from panelspark.operators import ledger as G
from panelspark.operators import lifecycle as L
from panelspark.operators import merge as M
from panelspark.operators import panel as P
from panelspark.operators import payload as J
from panelspark.operators import stats as S


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_relistings_against_every_pair(spark):
    r = random.Random(4)
    hashes = [f"{r.getrandbits(64):016x}" for _ in range(6)]
    flip = lambda h, k: f"{int(h, 16) ^ sum(1 << b for b in r.sample(range(64), k)):016x}"
    texts = ["a well kept car with one owner and new tyres", "a well kept car with two owners and new tyres", "short", None, "something else entirely, many words long here"]
    pick = lambda *x: r.choice(x)
    rows = [(i, pick("A", "B", None), pick("m", "n"), pick("1", "2"), pick("s1", " S1 ", "s2", None), pick(10000, 14000, 90000, None), pick(100, 105, 300, 0), pick("x", "y", ""), [flip(r.choice(hashes), r.choice([0, 4, 8, 9])) for _ in range(r.randrange(3))], r.choice(texts), pick("red", None), pick("black", "white")) for i in range(150)]
    names = list(E.FIELDS)
    df = spark.createDataFrame(rows, "id long, brand string, model string, year string, seller string, mileage long, price long, city string, images array<string>, description string, body_color string, interior_color string")
    got = {(x.c_id, x.p_id): x.score for x in E.scored_pairs(df, df, order="id").collect()}
    norm = lambda x: " ".join((x or "").lower().split())
    want = {}
    for p, c in itertools.combinations([dict(zip(names, x)) for x in rows], 2):
        same = lambda f: bool(p[f]) and norm(p[f]) == norm(c[f])
        a, b = norm(p["description"]), norm(c["description"])
        score = 0.30 * all(same(f) for f in ("brand", "model", "year")) + 0.20 * same("seller") + 0.05 * same("city") + 0.05 * (same("body_color") and same("interior_color"))
        score += 0.15 * (None not in (p["mileage"], c["mileage"]) and abs(p["mileage"] - c["mileage"]) <= 5000) + 0.10 * (p["price"] != 0 and c["price"] != 0 and abs(p["price"] - c["price"]) / max(p["price"], 1) <= 0.12)
        score += 0.20 * any(bin(int(x, 16) ^ int(y, 16)).count("1") <= 8 for x in p["images"] for y in c["images"]) + 0.15 * (len(a) >= 25 and len(b) >= 25 and SequenceMatcher(None, a, b).ratio() >= 0.72)
        if round(min(score, 1.0), 4) >= 0.70:
            want[c["id"], p["id"]] = round(min(score, 1.0), 4)
    assert got == want and len(want) > 20


def test_block_keys_cover_every_match():
    for m in (E.Match(), E.Match(threshold=0.5), E.Match(seller=0.7, image=0.0, price_ratio=0.3), E.Match(threshold=0.9)):
        weights = {"taxonomy": m.taxonomy, "seller": m.seller, "mileage": m.mileage, "price": m.price, "city": m.city, "image": m.image, "description": m.description, "colors": m.colors}
        keys = E.block_keys(m)
        for n in range(len(weights) + 1):
            for some in itertools.combinations(weights, n):
                if round(sum(weights[x] for x in some), 4) >= m.threshold:
                    assert any(set(fields) | set(there) <= set(some) for fields, there in keys), some
    assert all(len(fields) >= 3 for fields, _ in E.block_keys(E.Match()))


def serial_matches(pairs):
    taken, out = set(), []
    for c, own in itertools.groupby(sorted(pairs, key=lambda x: (x[0], -x[2], x[1])), key=lambda x: x[0]):
        for _, p, s in own:
            if p not in taken:
                taken.add(p)
                out.append((c, p, s))
                break
    return sorted(out)


def test_matching_is_the_serial_one(spark):
    r = random.Random(9)
    pairs = {(r.randrange(300), r.randrange(1000, 1200)): r.choice([0.7, 0.75, 0.8, 1.0]) for _ in range(700)}
    chained = [(c, 5000 + c + d, 1.0 - 0.1 * d) for c in range(2000, 3500) for d in (0, 1)]  # a chain of 1,500 claims
    rows = [(c, p, s) for (c, p), s in pairs.items()] + chained + [(2000, 5001, 0.1)]
    df = spark.createDataFrame(rows + [(None, 1, 0.9), (1, None, 0.9)], "c_id long, p_id long, score double")
    best = {(c, p): 0.0 for c, p, _ in rows}
    for c, p, s in rows:
        best[c, p] = max(best[c, p], s)
    assert sorted(map(tuple, E.match_one_to_one(df).collect())) == serial_matches([(c, p, s) for (c, p), s in best.items()])
    assert E.match_one_to_one(df.limit(0)).count() == 0


def test_a_large_block_is_matched_in_few_jobs(spark):
    """5,000 children who all want the same 5,000 parents in the same order, each with its forty best of those that may be left."""
    df = spark.range(5000).select(F.col("id").alias("c_id"), F.explode(F.sequence(F.greatest(F.col("id") - 39, F.lit(0)), F.col("id"))).alias("p_id")).withColumn("score", F.lit(0.9))
    seen = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("matching", "matching")
    try:
        got = {x.c_id: x.p_id for x in E.match_one_to_one(df).collect()}
        jobs = len(seen.getJobIdsForGroup("matching"))
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert got == {i: i for i in range(5000)} and jobs < 100  # a chain of 5,000 claims; each shuffle of a plan is a job


def test_matches_from_lists_that_grow(spark, monkeypatch):
    """Few best parents of each child are stored, those left without one ask again, and the matching is the serial one of all pairs."""
    r = random.Random(12)
    rows = [(i, "A", "m", "1", "s", 10000, r.choice([100, 105, 300]), r.choice("xy"), [], None, "red", r.choice(["black", "white"]), r.randrange(40)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, brand string, model string, year string, seller string, mileage long, price long, city string, images array<string>, description string, body_color string, interior_color string, at long")
    pairs = E.scored_pairs(df, df, order="at").select("c_id", "p_id", "score").collect()
    want, stored, cut = serial_matches(map(tuple, pairs)), [], E.cut

    def counted(frame):
        out = cut(frame)
        stored.extend([out.count()] if "place" in out.columns else [])
        return out

    monkeypatch.setattr(E, "cut", counted)
    for most in (2, 8):
        monkeypatch.setattr(E, "LIST", most)
        monkeypatch.setattr(E, "GROW", 2)
        stored.clear()
        assert sorted(map(tuple, E.matches(df, df, order="at").collect())) == want
        assert len(pairs) > 1000 and stored[0] <= 60 * (most + 1) and 1 < len(stored) <= E.ROUNDS


def test_event_log_is_idempotent(spark):
    log = spark.createDataFrame([(1, 1, "seen", "a"), (None, 1, "seen", "n")], "ad long, run long, kind string, note string")
    new = spark.createDataFrame([(1, 1, "seen", "b"), (1, 2, "seen", "c"), (1, 2, "seen", "d"), (None, 1, "seen", "z")], log.schema)
    once = G.append_once(log, new, ["ad", "run", "kind"], ["note"])
    rows = {(x.ad, x.run): x.note for x in once.collect()}
    assert rows == {(1, 1): "a", (None, 1): "n", (1, 2): "c"}
    assert {(x.ad, x.run): x.note for x in G.append_once(once, new, ["ad", "run", "kind"], ["note"]).collect()} == rows
    assert sorted(x.note for x in G.insert_new(log, new, ["ad", "run"]).collect()) == ["c"]
    assert G.append_once(log.limit(0), new.limit(0), ["ad", "run", "kind"], ["note"]).count() == 0


def test_links_and_exits(spark):
    state = spark.createDataFrame([(1, "likely_removed", None, 3), (2, "new", None, 0), (3, "active", None, 0), (4, "missing_once", "veh_x", 1)], "ad long, status string, entity_id string, misses int")
    links = spark.createDataFrame([(1, 2), (4, 3)], "parent long, child long")
    got = {x.ad: x for x in G.apply_links(state.drop("misses"), links, "ad").collect()}
    assert got[1].status == "reposted" and got[1].entity_id == got[2].entity_id != got[3].entity_id and (got[2].parent, got[3].entity_id, got[4].status) == (1, "veh_x", "reposted")
    live = spark.createDataFrame([(1, 5), (3, 5), (4, 500)], "ad long, price long")
    exits = {x.ad: (x.status, x.misses) for x in G.apply_filter_exits(state, live, "ad", C.filter_reason(F.col("price"), F.lit(None).cast("int"), price_from=100, epsilon=0)).collect()}
    assert exits == {1: ("active_outside_filter", 0), 2: ("new", 0), 3: ("active", 0), 4: ("missing_once", 1)}


def test_payloads(spark):
    text = json.dumps({"a": {"phone": 1, "b": [1, {"email": "x", "c": None}], "d": {}}, "mobile": "y"})
    df = spark.createDataFrame([(1, text), (2, "no json"), (3, None)], "id long, p string")
    paths = lambda d: {(x.id, x.path, x.value) for x in J.flatten_json(d, "id", "p").collect()}
    assert paths(df) == {(1, "a.phone", "1"), (1, "a.b[0]", "1"), (1, "a.b[1].email", "x"), (1, "a.b[1].c", None), (1, "a.d", "{}"), (1, "mobile", "y")}
    assert {p for _, p, _ in paths(df.withColumn("p", J.strip_keys(F.col("p"))))} == {"a.b[0]", "a.b[1].c", "a.d"}


def test_shapes_and_strengths(spark):
    shape = lambda p, s, d=None, t=None: one(spark, S.shape_name(*[F.lit(x).cast("double") for x in (p, s, d, t)]))
    assert [shape(0.1, 0.1, 0.4), shape(0.5, 0.7), shape(0.5, 0.7, None, 0.68), shape(0.1, 0.1), shape(0.5, 0.5), shape(0.15, 0.21), shape(None, 0.5)] == [
        "non_monotone_dependence", "monotone_nonlinear", "linear_within_trimmed_range", "no_detected_association", "approximately_linear", "weak_or_unclear", "not_computed"]
    assert [one(spark, S.strength_of(F.lit(x))) for x in (0.1, 0.2, 0.4, 0.6, 0.8)] == ["negligible", "weak", "moderate", "strong", "very_strong"]


def test_associations_leave_aliases_out(spark):
    r = random.Random(1)
    df = spark.createDataFrame([(x := r.random(), 2 * x, r.random(), r.choice("ab"), r.choice("ab")) for _ in range(200)], "x double, x2 double, y double, g string, h string")
    f = A.Features(("x", "x2", "y"), ("g", "h"), (("x", "x2"),))
    pairs = A.pairwise_associations(df, f)
    got = {(p.a, p.b): p for p in pairs.collect()}
    assert ("x", "x2") not in got and len(got) == 2 + 1 + 6 and not any(p.tautology for p in got.values())
    assert all(p.q_value >= p.p_value for p in got.values() if p.p_value is not None)
    assert {p.feature for p in A.target_associations(df, f, "x").collect()} == {"y", "g", "h"}
    assert {p.feature for p in A.differentiating_features(df, f, "g").collect()} == {"x", "x2", "y", "h"}
    assert A.pairwise_associations(df.limit(0), f).where("value is not null").count() == 0


def midranks(v):
    order = sorted(v)
    return [order.index(x) + (order.count(x) + 1) / 2 for x in v]


def pearson(x, y):
    mx, my = sum(x) / len(x), sum(y) / len(y)
    return sum((a - mx) * (b - my) for a, b in zip(x, y, strict=True)) / (sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)) ** 0.5


def quantile(v, p):
    s, at = sorted(v), (len(v) - 1) * p
    low = int(at)
    return s[low] + (s[min(low + 1, len(s) - 1)] - s[low]) * (at - low)


def kruskal(groups):
    every = [x for g in groups for x in g]
    r, n = dict(zip(every, midranks(every), strict=True)), len(every)
    ties = sum(every.count(x) ** 3 - every.count(x) for x in set(every))
    return (12 / (n * (n + 1)) * sum(sum(r[x] for x in g) ** 2 / len(g) for g in groups) - 3 * (n + 1)) / (1 - ties / (n**3 - n))


def test_associations_with_nulls_beside_plain_code(spark):
    """Pairs whose nulls and rare levels leave rows out are ranked on what is left; NaN is missing; all from the sums of one scan else."""
    r = random.Random(6)
    rows = []
    for i in range(240):
        x = r.choice([1.0, 2.0, 3.5, 1e6, r.random()])
        rows.append((x, None if i % 5 == 0 else x * x + r.random(), float("nan") if i % 7 == 0 else r.random(), r.choice("abc") if i % 6 else None, "rare" if i == 3 else r.choice("uv"), r.choice(["p", "q"])))
    df = spark.createDataFrame(rows, "x double, y double, z double, g string, h string, k string").repartition(7)
    got = {(p.a, p.b): p for p in A.pairwise_associations(df, A.Features(("x", "y", "z"), ("g", "h", "k"))).collect()}
    at = {c: i for i, c in enumerate("xyzghk")}
    col = lambda *c: [v for v in ([row[at[x]] for x in c] for row in rows) if not any(x is None or x != x for x in v)]
    for a, b in itertools.combinations("xyz", 2):
        u, v = map(list, zip(*col(a, b), strict=True))
        p = got[a, b]
        clip = lambda w, q: [max(min(t, quantile(w, 1 - q)), quantile(w, q)) for t in w]
        want = (pearson(midranks(u), midranks(v)), pearson(u, v), pearson(clip(u, 0.01), clip(v, 0.01)), pearson(clip(u, 0.1), clip(v, 0.1)))
        assert p.n == len(u) and [p.value, p.pearson, p.trimmed, p.robust] == pytest.approx(list(want), abs=6e-5), (a, b)
    for a, b in itertools.product("xyz", "ghk"):
        pairs = col(a, b)
        groups = [[v for v, g in pairs if g == level] for level in sorted({g for _, g in pairs})]
        mean = sum(v for v, _ in pairs) / len(pairs)
        eta = (sum(len(g) * (sum(g) / len(g) - mean) ** 2 for g in groups) / sum((v - mean) ** 2 for v, _ in pairs)) ** 0.5
        tested = [g for g in groups if len(g) >= 3]
        assert got[a, b].value == pytest.approx(eta, abs=6e-5) and got[a, b].statistic == pytest.approx(kruskal(tested), abs=6e-5) and got[a, b].dof == len(tested) - 1
    for a, b in itertools.combinations("ghk", 2):
        pairs = col(a, b)
        left, right, n = sorted({p[0] for p in pairs}), sorted({p[1] for p in pairs}), len(pairs)
        gap = lambda u, v: abs(sum(p == [u, v] for p in pairs) - (e := sum(p[0] == u for p in pairs) * sum(p[1] == v for p in pairs) / n)) ** 2 / e
        assert got[a, b].statistic == pytest.approx(sum(gap(u, v) for u in left for v in right), abs=6e-5) and got[a, b].dof == (len(left) - 1) * (len(right) - 1)


def test_all_groups_and_levels_are_compared(spark):
    """Forty groups and categories of more levels than the matrices take are tested whole, with the figures of the matrices."""
    r = random.Random(11)
    rows = [(r.choice([1.0, 2.0, 5.0]) + i % 40 // 20, r.random() if i % 9 else None, f"g{i % 40}", f"c{r.randrange(35)}" if i % 7 else None, "ab"[(i % 40 + r.randrange(30)) % 2]) for i in range(800)] + [(9.0, 0.5, "rare", "c1", "a")] * 9
    df = spark.createDataFrame(rows, "x double, y double, g string, c string, h string").repartition(5)
    f = A.Features(("x", "y"), ("g", "c", "h"))
    got = {p.feature: p for p in A.differentiating_features(df, f, "g").collect()}
    kept = [x for x in rows if x[2] != "rare"]
    want = kruskal([[x[0] for x in kept if x[2] == g] for g in sorted({x[2] for x in kept})])
    assert got["x"].groups == 40 and got["x"].n == 800 and got["x"].statistic == pytest.approx(want, abs=1e-4)
    assert got["c"].groups == got["h"].groups == 40 and got["c"].dof == 39 * 34
    few, many = (sorted(map(tuple, A.pairwise_associations(df, f, max_levels=k).collect()), key=repr) for k in (30, 50))
    assert len(few) == len(many) == 10
    for x, y in zip(few, many, strict=True):
        assert all(v == w or v == pytest.approx(w, abs=1e-4) for v, w in zip(x, y, strict=True)), (x, y)


def test_tests_of_two_groups(spark):
    """Mann-Whitney by counting pairs, Yates' correction in a two by two table, p-values beside published ones."""
    r = random.Random(8)
    rows = [(r.choice([1, 2, 3, 4, 9]) + 0.0, r.choice(["no", "yes"]), r.choice(["a", "b"])) for _ in range(200)]
    df = spark.createDataFrame(rows + [(0.0, "yes", "a"), (-1.0, "no", "b"), (None, "no", "b")], "v double, flag string, other string")
    got = {x.feature: x for x in A.target_associations(df, A.Features(("v",), ("flag", "other")), "v").collect()}
    yes, no = ([v for v, f, _ in rows if f == w] for w in ("yes", "no"))
    u = sum((a > b) + 0.5 * (a == b) for a in yes for b in no)
    assert got["flag"].test == "mann_whitney_u" and got["flag"].statistic == pytest.approx(u, abs=1e-4) and got["flag"].effect_size == pytest.approx(2 * u / (len(yes) * len(no)) - 1, abs=6e-5)
    assert got["flag"].p_holm >= got["flag"].p_value and got["flag"].n == 200
    table = [[sum((f, o) == (w, z) for _, f, o in rows + [(0, "yes", "a"), (0, "no", "b"), (0, "no", "b")]) for z in "ab"] for w in ("no", "yes")]
    n, want = sum(map(sum, table)), 0.0
    for i, j in itertools.product((0, 1), (0, 1)):
        e = sum(table[i]) * (table[0][j] + table[1][j]) / n
        want += max(abs(table[i][j] - e) - 0.5, 0) ** 2 / e
    pair = A.categorical_pairs(df, A.Features((), ("flag", "other"))).first()
    assert pair.statistic == pytest.approx(want, abs=6e-5)
    from panelspark.functions import special

    assert special.chi2_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-7) and special.chi2_tail(18.307038, 10) == pytest.approx(0.05, abs=1e-7)
    assert special.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-7) and special.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-7)


def test_findings_have_a_row_for_each_check(spark):
    from panelspark.operators import quality as Q

    df = spark.createDataFrame([(i if i % 10 else None, i) for i in range(300)], "k long, v long").repartition(9)
    got = {x.check: (x.severity, x["count"], x.samples) for x in Q.findings(df, [("big", "error", F.col("v") >= 250), ("none", "critical", F.col("v") < 0), ("null", "warning", F.lit(None).cast("boolean")), ("unkeyed", "warning", F.col("k").isNull())], "k", 3).collect()}
    assert got == {"big": ("error", 50, "251,252,253"), "none": ("critical", 0, ""), "null": ("warning", 0, ""), "unkeyed": ("warning", 30, "")}
    assert {x["count"] for x in Q.findings(df.limit(0), [("a", "error", F.col("v") > 0)], "k").collect()} == {0}
    assert Q.private_columns({"ads": df.withColumnRenamed("v", "Phone"), "x": df}, ("phone", "seller_name")) == ["ads.Phone"]


def test_run_selection_and_private_columns(spark):
    from panelspark.operators import quality as Q

    df = spark.createDataFrame([(1, "valid", at := datetime(2026, 6, 1), True, 5), (2, "valid", at, True, 5), (3, "partial", at, True, 5), (4, "valid", None, True, 5), (5, "valid", at, False, 5), (6, "valid", at, True, 0)], "run_id long, status string, finished_at timestamp, comparison_applied boolean, discovered_count long")
    pick = lambda *a: (lambda x: (x[0].first().run_id, len(x[1])))(Q.select_run(*a))
    assert [pick(df), pick(df, 1), pick(df, 3), pick(df.drop("comparison_applied", "discovered_count"))] == [(2, 0), (1, 0), (3, 1), (6, 2)]
    for bad in ((df, 9), (df.where("run_id > 2"),)):
        with pytest.raises(LookupError):
            Q.select_run(*bad)
    assert Q.without_private(df.withColumnRenamed("status", "Seller_Name"), ("seller_name",)).columns == ["run_id", "finished_at", "comparison_applied", "discovered_count"]


def test_query_ranges(spark):
    got = [tuple(one(spark, C.query_range(F.lit(u), "price"))) for u in ("https://x/car?year=1,2&price=100,200", "https://x/car?price=100", "https://x/car?price=,200", "https://x/car?price=100%2C200", "https://x/car?price=cheap", "https://x/car?price=", "https://x/car")]
    assert got == [(100, 200, True, False), (100, None, True, False), (None, 200, True, False), (100, 200, True, False), (None, None, True, True), (None, None, False, False), (None, None, False, False)]


def test_listing_checks_by_hand(spark):
    from panelspark.operators import quality as Q

    at = lambda d: datetime(2026, 6, d)
    fine = ("A1", "https://x/a1-car", at(1), at(5), None, at(5), "active", "not_sold", 9e8, 10, 1400, None)
    odd = [(1, "https://x/b"), (3, at(1), 2, at(3)), (4, at(2), 6, "likely_removed"), (8, -1.0), (8, 0.0), (9, -5), (10, 2015), (7, "likely_sold"), (7, "confirmed_sold", 6, "likely_sold"), (11, "price", 6, "likely_removed"), (8, 5.0), (5, at(20))]
    rows = [fine]
    for i, change in enumerate(odd):
        row = list(fine)
        row[0], row[1] = f"C{i}", f"https://x/c{i}"
        for k, v in zip(change[::2], change[1::2], strict=True):
            row[k] = v
        rows.append(tuple(row))
    df = spark.createDataFrame(rows, "platform_ad_id string, canonical_url string, first_seen_at timestamp, last_seen_at timestamp, first_missing_at timestamp, snapshot_at timestamp, current_status string, sale_label string, price double, mileage long, year long, filter_exit_reason string")
    got = [(x["count"], x.samples) for x in Q.findings(df, Q.listing_checks(1000, F.lit(at(6))), "platform_ad_id").collect()]
    assert got == [(1, f"C{i}") for i in range(len(odd))]


def test_baseline_follows_valid_runs(spark):
    counts = [100, 100, 10, 100, 10, 10, 10, 10, 100]
    df = spark.createDataFrame([(i, n, "a") for i, n in enumerate(counts)] + [(i, 5, "b") for i in range(3)], "run long, n long, config string")
    got = {(x.config, x.run): (x.baseline_median, x.is_valid) for x in P.run_baseline(df, "run", "n", ["config"], share=0.3).collect()}
    assert [got["a", i][1] for i in range(9)] == [True, True, False, True, False, False, False, False, True] and got["a", 8][0] == 100.0 and got["b", 2] == (5.0, True)


def test_merge_of_numbers(spark):
    a = spark.createDataFrame([(1, 5.0, "x"), (2, 1.0, "A b")], "k long, n double, t string")
    h = spark.createDataFrame([(1, 5, "y"), (2, 2, "a  B")], "k long, n int, t string")
    got = {x.k: (x.n_source, x.t_source) for x in M.merge_records(a, h, "k", [M.Rule("n"), M.Rule("t")]).collect()}
    assert got == {1: ("B", "A"), 2: ("A", "A")}  # case counts
    flags = M.merge_records(spark.createDataFrame([(1, True), (2, False)], "k long, f boolean"), spark.createDataFrame([(1, "true"), (2, "true")], "k long, f string").selectExpr("k", "cast(f as boolean) as f"), "k", [M.Rule("f")])
    assert {x.k: (x.f_source, len(x.conflicts)) for x in flags.collect()} == {1: ("B", 0), 2: ("A", 1)}
    kept = M.replace_children(spark.createDataFrame([(1, 1, "o"), (1, 2, "n"), (1, 2, "m"), (2, 1, "k")], "p long, v long, c string"), "p", "v")
    assert sorted(x.c for x in kept.collect()) == ["k", "m", "n"]


def test_columns_without_a_query(spark):
    s = F.lit
    assert one(spark, C.path_key(s("https://x.y/A/b/c?q=1"))) == "a,b"
    assert one(spark, C.fingerprint(s("B"), s("m"), s("1"), s(12345), s("c"))) == one(spark, C.fingerprint(s(" b "), s("M"), s("1"), s(19999), s("C"))) != one(spark, C.fingerprint(s("b"), s("m"), s("1"), s(20000), s("c")))
    assert one(spark, C.entity_id(s("2"), s("1"), s(""))) == one(spark, C.entity_id(s("1"), s("2"), s(None).cast("string"))) and one(spark, C.entity_id(s("1"), s("2"), s("v"))) == "v"
    assert one(spark, C.local_slot(s("2026-06-01").cast("date"), 9, 30, "Asia/Tehran")) == datetime(2026, 6, 1, 6, 0)
    assert tuple(one(spark, C.filter_evidence(s(5), s(None).cast("int"), price_from=1, year_from=1))) == (["price_from"], ["year_from"])
    assert one(spark, C.published_time(s("1403/01/01"), s(0))) == 1710892800.0 and one(spark, C.published_time(s("x"), s(0))) is None
    at = lambda t: s(t).cast("timestamp")
    assert [one(spark, L.reclassify_start(at("2026-06-01 09:00"), at(t))) for t in ("2026-06-01 09:10", "2026-06-01 08:00", "2026-06-01 12:00", None)] == ["scheduled", "started_before_slot", "manual_or_late", "no_start"]


def test_sessions_and_sliding_volume(spark):
    from panelspark.streaming import streams as T

    rows = spark.createDataFrame([(1, datetime(2026, 1, 1), 1.0), (1, datetime(2026, 1, 2), 3.0), (1, datetime(2026, 1, 9), 5.0), (2, datetime(2026, 1, 2), 1.0)], "ad_id long, ts timestamp, value double")
    assert sorted((x.ad_id, x.sightings) for x in T.presence_episodes(rows).collect()) == [(1, 1), (1, 2), (2, 1)]
    first = {x.start: (x.n, x.mean_value) for x in T.sliding_volume(rows).collect()}
    assert first[datetime(2026, 1, 1)] == (3, pytest.approx(5 / 3))


def test_fastest_disappearing_has_rows_without_an_estimate_last(spark, tmp_path):
    """A listing that came back after its first miss and then went has no estimate; the SQL orders it behind the others."""
    import duckdb

    from panelspark.plans import catalogue
    from tools.compare import compare

    days = {u: range(30) for u in range(100, 160)} | {0: [3, 4, 6, 7], 1: [3, 4, 5], 3: [2, 3, 4, 5, 6], 4: [2, 4, 5]}
    rows = [(n, datetime(2024, 1, d + 1, 12), u, "view", float(50 - d), "{}") for n, (u, d) in enumerate((u, d) for u, some in days.items() for d in some)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    name = "fastest_disappearing"
    assert ": ok, 4 rows" in compare(spark, con, name, catalogue.queries()[name], catalogue.oracle_sql()[name], str(tmp_path))
    got = catalogue.queries()[name](spark, str(tmp_path)).collect()
    assert [x.ad_id for x in got] == [1, 3, 0, 4] and got[2].estimate_days is None


def test_pairs_out_of_reach_end_in_the_join(spark):
    """Listings of one taxonomy, mileage and price with different images share keys, but none of their pairs leaves the join."""
    shown = [f"{(i * 0x9E3779B97F4A7C15 + 0x5851F42D4C957F2D) & (1 << 64) - 1:016x}" for i in range(40)]
    rows = [(i, "A", "m", "1", f"s{i}", 10000, 100, f"c{i}", [shown[i]], None, None, None) for i in range(40)] + [(40, "A", "m", "1", "s", 12000, 105, "c", [shown[7]], None, None, None)]
    df = spark.createDataFrame(rows, "id long, brand string, model string, year string, seller string, mileage long, price long, city string, images array<string>, description string, body_color string, interior_color string")
    near = [i for i in range(40) if bin(int(shown[i], 16) ^ int(shown[7], 16)).count("1") <= 8]
    assert near == [7]
    assert [(x.c_id, x.p_id) for x in E.candidates(df, df, order="id").collect()] == [(40, 7)]


def test_pairs_leave_the_join_once_and_scored(spark, capsys, monkeypatch):
    """Pairs that meet on several keys are kept on the first, with no shuffle of pairs; parts of images and rows compared themselves give the same."""
    r = random.Random(3)
    shown = [f"{(i * 0x9E3779B97F4A7C15 + 0x5851F42D4C957F2D) & (1 << 64) - 1:015x}"[:15] for i in range(3)]
    rows = [(i, "A", "m", r.choice("12"), r.choice(["s", "t", None, " "]), r.choice([10000, 14000, 90000, None]), r.choice([100, 105, 300, 0]), r.choice(["x", "y", ""]), [r.choice(shown) + r.choice("013")], None, r.choice(["red", None]), "black") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, brand string, model string, year string, seller string, mileage long, price long, city string, images array<string>, description string, body_color string, interior_color string")
    found = lambda: sorted((x.c_id, x.p_id, x.score, tuple(x.matched)) for x in E.scored_pairs(df, df, order="id").collect())
    got = found()
    assert len(got) > 1000 and len({x[:2] for x in got}) == len(got)
    monkeypatch.setattr(E, "FEW", 0)
    assert found() == got
    monkeypatch.setattr(E, "_clash", lambda *_: True)
    assert found() == got
    monkeypatch.undo()
    capsys.readouterr()
    some = df.where("seller <> ' '")
    E.scored_pairs(some, some, E.Match(image=0.0, threshold=0.65), order="id").explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(k#") == 2


def test_frequent_bigrams_of_shared_and_null_keys(spark):
    """Rows of one key are one text, a row without a key is none (count(distinct) leaves it out), and n-grams don't cross rows."""
    from panelspark.operators import text as T

    rows = [(1, ["a", "b", "a", "b"]), (1, ["a", "b"]), (2, ["a", "b", "c"]), (None, ["a", "b"]), (3, ["x"]), (4, None)]
    df = spark.createDataFrame(rows, "id long, w array<string>")
    assert sorted(map(tuple, T.frequent_ngrams(df, "id", F.col("w"), 2).collect())) == [("a b", 5, 2), ("b a", 1, 1), ("b c", 1, 1)]
    assert sorted(map(tuple, T.frequent_ngrams(df.where("id > 1 or id is null"), "id", F.col("w"), 2).collect())) == [("a b", 2, 1), ("b c", 1, 1)]


def test_specifications_are_parsed_by_all_tasks(spark, capsys):
    """Payloads of one small file are dealt by number before they are parsed, and not merged again."""
    df = spark.createDataFrame([(1, json.dumps({"groups": []}))], "id long, payload string").coalesce(1)
    J.specification_rows(df, "id", "payload").explain()
    plan = capsys.readouterr().out
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange") == 1


def test_ranked_counts_by_key_over_many_partitions(spark):
    """Rows of smaller values of the same key, whatever partitions and keys stand before; no rows give none."""
    from panelspark.operators import ranks

    rows = [(k, float(v), v % 3 + 1) for k in range(5) for v in range(40 * k + 1)]
    df = spark.createDataFrame(rows, "k int, v double, n long")
    for few in (False, True):
        got = {(r.k, r.v): r.below for r in ranks.ranked_counts(df, ["k"], "v", few_keys=few).collect()}
        assert got == {(k, v): sum(m for j, w, m in rows if j == k and w < v) for k, v, _ in rows}
    assert {r.v: r.below for r in ranks.ranked_counts(df.where("k = 4"), [], "v").collect()} == {v: sum(m for j, w, m in rows if j == 4 and w < v) for k, v, _ in rows if k == 4}
    assert ranks.ranked_counts(df.limit(0), ["k"], "v").count() == 0


def test_association_rows_are_made_once(spark):
    """The rows, which may be a join, are computed once for levels, ranks and sums alike."""
    from panelspark.operators import associations as A

    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    df = spark.createDataFrame([(float(i % 7), float(i), "ab"[i % 2]) for i in range(50)], "x double, y double, g string").mapInPandas(count, "x double, y double, g string")
    assert A.pairwise_associations(df, A.Features(("x", "y"), ("g",))).count() == 3
    assert seen.value == 50
    seen.value = 0
    assert A.differentiating_features(df, A.Features(("x", "y"), ("g",)), "g").count() == 2
    assert seen.value == 50
