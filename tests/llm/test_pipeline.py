"""The pipeline's stages one by one and together."""

import hashlib

import pytest

from panelspark.llm._graph import cut

pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    before, now = len(ids), docs
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, now, sf_dir)
        assert out.columns == docs.columns, name
        now = cut(out)
        left = {r.doc_id for r in now.select("doc_id").collect()}
        assert left <= ids and len(left) > 0.4 * before, name
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 0").collect()}
    assert len(left & good) < 0.2 * len(good)
    pieces = pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == left
    assert pieces.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_one_row_of_each_group_of_copies_is_left(spark, sf_dir):
    """Copies whose lines all stand earlier don't go on as empty texts; rows without words and null ids stay."""
    copy = lambda g: "\n".join(hashlib.sha256(f"{g} {k}".encode()).hexdigest() for k in range(4))
    rows = [(10 * g + i, copy(g)) for g in range(5) for i in range(6)] + [(900, ""), (901, " \n "), (902, None), (None, copy(0))]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = pipeline.line_deduplication(spark, docs, sf_dir)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {0, 10, 20, 30, 40, 900, 901, 902, None}


def test_stages_on_awkward_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, columns with clashing names, and no rows at all."""
    word = lambda i: hashlib.sha256(str(i).encode()).hexdigest()[:6]
    long = " ".join(word(i) for i in range(20_000))
    rows = [(1, "a b c", "en", "s", 5, "x", "x"), (1, "a b c", "en", "s", 5, "x", "x"), (None, None, None, None, None, None, None), (2, "", None, None, 0, "x", None), (3, long, "en", "s", len(long), None, "x"), (4, None, "de", "s", None, "x", "x"), (5, long + " more", "en", None, None, "x", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, line string")
    labels = spark.createDataFrame([(3, 1, 0), (None, None, None), (2, None, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table in (docs, docs.limit(0)):
        now = table
        for name, stage in pipeline.STAGES[:-1]:
            now = stage(spark, now, str(tmp_path))
            assert now.columns == docs.columns, name
            assert {r.doc_id for r in now.collect()} <= {None, 1, 2, 3, 4, 5}
        assert pipeline.STAGES[-1][1](spark, table, str(tmp_path)).where("start = 0").count() == table.count()
    assert pipeline.near_duplicates(spark, docs, str(tmp_path)).where("doc_id = 5").count() == 0
