import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from panelspark.operators import entity as E
from panelspark.operators import merge as M
from panelspark.operators import panel as P
from panelspark.operators import quality as Q
from panelspark.operators.pages import extract
from panelspark.sources import io
from panelspark.streaming import streams as T


def test_scan_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "id long, tags array<string>")
    rows = io.export({"t": df, "none": df.limit(0)}, str(tmp_path)).collect()
    manifest = {r.table: (r.rows, r.content_hash) for r in rows}
    assert all(r.bytes > 0 and r.files > 0 for r in rows)
    assert manifest["t"][0] == 2 and manifest["none"] == (0, "0")
    back, skipped = io.scan(spark, f"{tmp_path}/t", ["id", "tags", "other"])
    assert skipped == ["other"] and back.columns == ["id", "tags"]
    assert io.content_hash(back.repartition(3)).first().content_hash == manifest["t"][1]
    assert spark.read.parquet(f"{tmp_path}/none").columns == ["id", "tags"]
    io.write_table(df, f"{tmp_path}/csv", "csv")
    assert {r.tags for r in spark.read.option("header", True).csv(f"{tmp_path}/csv").collect()} == {'["a","b"]', None}


def test_pages_and_snapshots(spark, tmp_path):
    for page, codes in ((1, "ab"), (2, "bc")):
        (tmp_path / f"p{page}.json").write_text(json.dumps({"page": page, "ads": [{"code": c, "v": page} for c in codes]}))
    got = {r.code: r.v for r in io.first_pages(spark, f"{tmp_path}/*.json", "code", "ads", "page int, ads array<struct<code: string, v: int>>").collect()}
    assert got == {"a": 1, "b": 1, "c": 2}
    for value in (1, 2):
        io.write_snapshot({"s": spark.createDataFrame([("2026-06-01", 1, value)], "run_date string, run_id int, v int")}, f"{tmp_path}/snap")
    io.write_snapshot({"s": spark.createDataFrame([("2026-06-02", 2, 9)], "run_date string, run_id int, v int")}, f"{tmp_path}/snap")
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/snap/s").collect()) == [2, 9]
    assert {(r.run_id, r.table, r.rows) for r in spark.read.parquet(f"{tmp_path}/snap/runs").collect()} == {(1, "s", 1), (2, "s", 1)}


def test_labels_manifest_and_views(spark):
    df = spark.range(5)
    rows, counter, row = io.labelled(df.where("id > 1"), "some", "select * from x where id > 1")
    assert rows.count() == 3 and counter.get["rows"] == 3 and len(row["query_sha256"]) == 64
    got = {(r.area, r.name): (r.reason, r.n) for r in io.manifest({"ids": df}, [("ids", "too small", df.where("id < 2"))], ["few rows"], [row]).collect()}
    assert got == {("source", "ids"): (None, 5), ("exclusion", "ids"): ("too small", 2), ("warning", "few rows"): (None, None), ("query", "some"): (row["query_sha256"], None)}
    assert io.config_fingerprint({"a": 1, "b": [2], "t": "now"}, ("t",)) == io.config_fingerprint({"b": [2], "a": 1}) != io.config_fingerprint({"a": 2, "b": [2]})
    for _ in range(2):
        io.views({"some_ids": df})
    assert spark.sql("select count(*) as n from some_ids").first().n == 5


def test_enforce(spark):
    df = spark.createDataFrame([(1, -5)], "id int, price int")
    findings = Q.count_where(df, [("negative", Q.CRITICAL, F.col("price") < 0), ("zero", Q.WARNING, F.col("price") == 0)])
    assert {r.check: r["count"] for r in findings.collect()} == {"negative": 1, "zero": 0}
    with pytest.raises(ValueError, match="negative=1"):
        Q.enforce(findings)


TRAIL = '[{"title": "Cars", "url": "/car"}, {"title": "Pride", "url": "/car/pride"}]'


@pytest.mark.parametrize(("mode", "a", "b", "same"), [
    ("text", " A  b", "A b", True), ("text", "a", "b", False), ("text", "Tehran", "tehran", False), ("text", "\u0643", "\u06a9", True), ("text", "\u06f1\u06f2", "12", True), ("text", None, "x", True), ("text", "x", None, True),
    ("loose", "x-1", "x 1", True), ("loose", "Pride, 131", "Pride131", True), ("loose", "x|y/z\\w", "xyzw", True), ("loose", "X 1", "x1", False), ("subset", "red car", "r ed", True), ("subset", "red-car", "redcar x", True), ("subset", "red", "blue", False),
    ("components", "Tehran, East", "East", True), ("components", "Tehran / East", "East,Tehran", True), ("components", "East Tehran", "Tehran", False), ("components", "", "Tehran", False), ("components", "a,b", "a,c", False),
    ("breadcrumb", TRAIL, TRAIL.replace('"url"', '"to"'), True), ("breadcrumb", TRAIL, TRAIL.replace("Pride", "Peride"), False), ("breadcrumb", TRAIL, "x > y", False), ("breadcrumb", "x", "y", True), ("temporal", "1", "2", True), ("boolean", "true", "false", False), ("number", "1", "1.0000001", True), ("number", "1", "1.1", False),
])
def test_equivalence(spark, mode, a, b, same):
    row = spark.createDataFrame([(a, b)], "a string, b string")
    assert row.select(M.equivalent(F.col("a"), F.col("b"), mode).alias("x")).first().x is same


def test_relisting(spark):
    schema = "id long, brand string, model string, year string, seller string, mileage long, price long, city string, images array<string>, description string, body_color string, interior_color string"
    said = "a careful first owner, all services done, no accidents"
    p = spark.createDataFrame([(1, "B", "M", "1400", "Ali", 1000, 100, "T", ["00000000000000ff"], said, "red", "black"), (2, "B", "M", "1400", None, 90000, 900, "X", [], None, None, None)], schema)
    c = spark.createDataFrame([(10, "b", "m ", "1400", "ali", 2000, 105, "t", ["00000000000000fe"], said + "!", "Red", "black"), (11, "B", "M", "1400", "Ali", 1500, 101, "T", [], None, None, None), (12, "Q", "M", "1", "z", 0, 0, "T", [], None, None, None)], schema)
    pairs = {(r.c_id, r.p_id): r.score for r in E.scored_pairs(c, p).collect()}
    assert pairs == {(10, 1): 1.0, (11, 1): 0.8}
    assert [(r.c_id, r.p_id) for r in E.match_one_to_one(E.scored_pairs(c, p)).collect()] == [(10, 1)]


def test_status_stream_from_sightings(spark, tmp_path):
    """Absences come from closed runs alone, over restarts; late and repeated sightings change nothing; a terminal status waits for the next sighting."""
    schema = "ad_id long, ts timestamp"

    def run(rows, name):
        spark.createDataFrame([(k, datetime(1970, 1, 1 + d, h)) for k, d, h in rows], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        s = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        T.status_by_key(s).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
        return {(r.ad_id, r.run_id): (r.status, r.misses, r.seen_runs, r.missing_runs) for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    first = run([(1, 0, 5), (1, 0, 9), (2, 0, 7), (9, 2, 12)], "a")
    assert first == {(k, 0): ("new", 0, 1, 0) for k in (1, 2)} | {(k, 1): ("missing_once", 1, 1, 1) for k in (1, 2)}
    later = run([(1, 3, 1), (2, 0, 8), (9, 6, 12)], "b")
    assert later == first | {
        (1, 2): ("likely_removed", 2, 1, 2), (1, 3): ("reappeared", 0, 2, 2), (1, 4): ("missing_once", 1, 2, 3), (1, 5): ("likely_removed", 2, 2, 4), (2, 2): ("likely_removed", 2, 1, 2),
        (9, 2): ("new", 0, 1, 0), (9, 3): ("missing_once", 1, 1, 1), (9, 4): ("likely_removed", 2, 1, 2)}


def test_baseline_stream_knows_valid_runs(spark, tmp_path):
    """The ring of valid counts over two batches is the fold over all runs at once; a run delivered again changes nothing."""
    counts = [100, 100, 10, 100, 10, 104, 10, 10, 100, 90, 30, 98]
    rows = [(c, i, n + c) for c in (1, 2) for i, n in enumerate(counts)]
    whole = {(x.config, x.run): (x.baseline_median, x.is_valid) for x in P.run_baseline(spark.createDataFrame(rows, "config long, run long, n long"), "run", "n", ["config"], share=0.9).collect()}
    for part in (rows[:5] + rows[12:20], rows[3:12] + rows[19:]):
        spark.createDataFrame(part, "config long, run_id long, n long").write.mode("append").parquet(f"{tmp_path}/in")
        s = spark.readStream.schema("config long, run_id long, n long").parquet(f"{tmp_path}/in")
        T.baseline_by_configuration(s, share=0.9).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert {(x.config, x.run_id): (x.baseline_median, x.is_valid) for x in got} == whole and len(got) == len(rows)


def test_runs_folded_in_batches(spark, tmp_path):
    """Cards that arrive over batches lead to the state of one fold over all runs; a run delivered again changes nothing."""
    from panelspark.operators.lifecycle import fold_status
    from panelspark.operators.panel import with_absences

    cards = [(1, 0), (2, 0), (3, 0), (1, 1), (2, 1), (1, 2), (1, 3), (3, 3), (4, 3)]

    def run(rows):
        spark.createDataFrame(rows, "ad_id long, run_id long").write.mode("append").parquet(f"{tmp_path}/in")
        s = spark.readStream.schema("ad_id long, run_id long").parquet(f"{tmp_path}/in")
        T.fold_runs(s, f"{tmp_path}/state", f"{tmp_path}/checkpoint").awaitTermination()
        return {r.ad_id: tuple(r)[1:] for r in T.read_folded(spark, f"{tmp_path}/state").collect()}

    run([c for c in cards if c[1] < 2])
    got = run([c for c in cards if c[1] >= 2])
    want = {r.ad_id: tuple(r)[1:] for r in fold_status(with_absences(spark.createDataFrame(cards, "ad_id long, run_id long"))).collect()}
    assert got == want
    assert run([c for c in cards if c[1] == 1]) == want


def test_changes_over_batches(spark, tmp_path):
    from datetime import datetime

    def run(rows):
        spark.createDataFrame([(a, datetime(2026, 1, d), v) for a, d, v in rows], "ad_id long, ts timestamp, value double").write.mode("append").parquet(f"{tmp_path}/in")
        s = spark.readStream.schema("ad_id long, ts timestamp, value double").parquet(f"{tmp_path}/in")
        T.change_batches(s, f"{tmp_path}/state", f"{tmp_path}/checkpoint").awaitTermination()
        return sorted((r.ad_id, r["at"].day, r.change_type) for r in spark.read.parquet(f"{tmp_path}/state/changes").collect())

    first = run([(1, 1, 5.0), (1, 2, 6.0), (2, 1, 1.0)])
    assert first == [(1, 2, "increase")]
    assert run([(1, 3, None), (2, 4, 0.5), (2, 5, 0.5)]) == sorted([*first, (1, 3, "hidden"), (2, 4, "decrease")])


def test_page_records(spark):
    html = '<html lang="en"><head><title>A &amp; B</title><style>x</style><script type="application/ld+json">{"a": 1}</script></head><body><p>Hello <a href="/x">you</a></p><script>no()</script></body></html>'
    r = extract(spark.createDataFrame([(1, html), (2, None)], "id long, html string"), "id", "html").orderBy("id").collect()
    assert (r[0].title, r[0].lang, r[0].linked_data, r[0].scripts, r[0].links, r[0].text) == ("A & B", "en", ['{"a": 1}'], 2, 1, "Hello you")
    assert r[1].text is None and r[1].links == 0


def test_page_records_are_read_in_slices(spark, capsys):
    """Pages over several slices of a batch keep their rows; the batch stays in Arrow's buffers."""
    from panelspark.operators import pages as G

    n = 2 * G.SLICE + 3
    df = spark.createDataFrame([(i, f'<html lang="l{i}"><a href="x">t{i}</a></html>' if i % 5 else None) for i in range(n)], "page_id long, html string").coalesce(1)
    out = G.extract(df, "page_id", "html")
    assert {x.page_id: (x.lang, x.links, x.text) for x in out.collect()} == {i: (f"l{i}", 1, f"t{i}") if i % 5 else (None, 0, None) for i in range(n)}
    out.explain()
    assert "MapInArrow" in capsys.readouterr().out
