import pytest
from pyspark.sql import functions as F

from panelspark.operators import lifecycle as L
from panelspark.operators import panel as P


def fold(spark, seen, valid=None):
    rows = [(1, i, s == "1", valid is None or valid[i] == "1") for i, s in enumerate(seen)]
    return L.fold_status(spark.createDataFrame(rows, "ad_id long, run_id long, was_seen boolean, ok boolean"), valid="ok").collect()


@pytest.mark.parametrize(("seen", "status", "misses"), [
    ("1", "new", 0), ("11", "active", 0), ("10", "missing_once", 1), ("100", "likely_removed", 2), ("1000", "likely_removed", 2), ("101", "reappeared", 0), ("1011", "active", 0), ("1001", "reappeared", 0), ("0010", "missing_once", 1)])
def test_transitions(spark, seen, status, misses):
    r = fold(spark, seen)[0]
    assert (r.status, r.misses) == (status, misses)


def test_invalid_run_is_no_absence(spark):
    assert fold(spark, "100", "101")[0].status == "missing_once"
    assert fold(spark, "000") == []


def test_compare_run_follows_the_fold(spark):
    days = {0: "ABCD", 1: "ABDE", 2: "ADEF", 3: "ABDEF"}
    names = "ABCDEF"
    state = spark.createDataFrame([], "ad_id string, " + ", ".join(f"{c} {'string' if c == 'status' else 'int' if c in ('misses', 'seen_runs', 'missing_runs') else 'long'}" for c in L.STATE))
    for run, ads in days.items():
        state = L.compare_run(state, spark.createDataFrame([(a,) for a in ads + ads[0]], "ad_id string"), run)
    got = {r.ad_id: r.status for r in state.collect()}
    rows = [(a, run, a in ads) for a in names for run, ads in days.items()]
    want = {r.ad_id: r.status for r in L.fold_status(spark.createDataFrame(rows, "ad_id string, run_id long, was_seen boolean")).collect()}
    assert got == want == {"A": "active", "B": "reappeared", "C": "likely_removed", "D": "active", "E": "active", "F": "active"}


def test_durations(spark):
    day = 86400
    rows = spark.createDataFrame([(1, 0, 4 * day, 6 * day, "likely_removed"), (2, 0, 4 * day, 2 * day, "active"), (3, 0, 4 * day, None, "active"), (4, None, None, None, "active")], "id int, f long, l long, m long, status string")
    got = {r.id: (r.min_days, r.max_days, r.estimate_days, r.interval_hours, r.right_censored) for r in L.durations(rows, "f", "l", "m", "status", F.lit(10 * day)).collect()}
    assert got == {1: (4.0, 6.0, 5.0, 48.0, False), 2: (10.0, None, None, None, True), 3: (10.0, None, None, None, True), 4: (None, None, None, None, True)}


def test_kaplan_meier_with_delayed_entry(spark):
    rows = [(float(t), e, s) for t, e, s in [(1, 1, 0), (2, 1, 0), (2, 0, 0), (3, 1, 2), (4, 1, 5), (5, 0, 0)]]
    df = spark.createDataFrame(rows, "t double, e int, s int")
    got = [(r.time, r.at_risk, r.events, r.survival) for r in L.kaplan_meier(df, "t", "e", "s", min_subjects=1, min_events=1).orderBy("time").collect()]
    want, surv = [], 1.0
    for t in (1, 2, 3, 4):
        n = sum(s < t <= x for x, _, s in rows)
        d = sum(x == t and e for x, e, _ in rows)
        if n:
            surv *= max(0.0, 1 - d / n)
            want.append((t, n, d, round(surv, 6)))
    assert got == want
    assert L.kaplan_meier(df, "t", "e", "s").count() == 0


def test_health(spark):
    base = {"run_id": 1, "initial_page_ok": True, "blocked": False, "verified_end": True, "stabilized": True, "persisted": True, "discovered_count": 100, "baseline_median": 100.0, "pages_fetched": 10, "pages_failed": 0, "empty_titles": 0, "missing_urls": 0, "known_active": 100, "expected_missing": 0, "errors": 0}
    schema = ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'double' if isinstance(v, float) else 'long'}" for k, v in base.items())
    cases = [({}, "valid"), ({"blocked": True, "verified_end": False}, "blocked"), ({"initial_page_ok": False}, "failed"), ({"pages_failed": 9}, "partial"), ({"discovered_count": 20}, "invalid"), ({"expected_missing": 51}, "invalid"), ({"expected_missing": 50}, "valid"), ({"baseline_median": None}, "valid"), ({"errors": 1}, "invalid")]
    rows = [tuple((base | change | {"run_id": i}).values()) for i, (change, _) in enumerate(cases)]
    got = {r.run_id: r.status for r in L.classify_runs(L.run_health(spark.createDataFrame(rows, schema))).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_evidence(spark):
    rows = spark.createDataFrame([(1, 2, "http_404", True, 0, 2, False, False, False, 20), (2, 1, "still_active", False, 0, 10, True, True, True, 11), (3, 0, None, None, None, None, None, None, None, 5)], "id int, misses int, verdict string, had_price_reduction boolean, first_seen int, first_missing int, reposted boolean, reappeared boolean, outside_filter boolean, now int")
    got = {r.id: r.s for r in rows.select("id", L.evidence_score(L.evidence_components()).alias("s")).collect()}
    assert got == {1: 0.85, 2: 0.0, 3: 0.1}


def test_leader_clusters_are_not_sessions(spark):
    t = [0, 50, 70, 110, 200]
    df = spark.createDataFrame([(1, m * 60) for m in t], "k int, s long").select("k", F.timestamp_seconds("s").alias("ts"))
    assert sorted(r.n for r in P.leader_clusters(df, "k", "ts", 60).collect()) == [1, 2, 2]


def test_as_of_join(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 3), (None, 3)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("a", 6, "z"), ("c", 1, "w")], "k string, t int, v string")
    got = sorted((r.k or "", r.t, r.v) for r in P.as_of_join(left, right, "k", "t", "t", ["v"]).collect())
    assert got == [("", 3, None), ("a", 1, None), ("a", 5, "y"), ("b", 3, None)]
