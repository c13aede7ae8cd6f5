import corpus_pipeline as P
from pyspark.sql import functions as F

from tests.llm.test_packing import check


def test_stages(spark, sf_dir, documents):
    docs = documents
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == documents.columns and after.schema.simpleString() == documents.schema.simpleString()
        after = P.keep(after, name)
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert ids and ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after.count() == len(ids)
        docs = after
    pieces = P.packing_stage(spark, docs, sf_dir).collect()
    check(pieces, {r["doc_id"]: r["text"] for r in docs.collect()})


def test_odd_rows_and_empty_tables(spark, sf_dir, odd):
    docs = odd.selectExpr("doc_id", "text", "lang", "source", "length(text) as n_chars")
    for rows in (docs, docs.limit(0)):
        for _, stage in P.STAGES[:-1]:
            rows = P.keep(stage(spark, rows, sf_dir), "stage")
        assert P.packing_stage(spark, rows, sf_dir).where("start = 0").count() == rows.count()


def test_each_stage_acts(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    line = "this is a line of text which more than one document holds for sure"
    text = " ".join(f"v{i}" for i in range(200))
    rows = [(1, line + "\nfirst of its own"), (2, line + "\nsecond of its own"), (3, line), (4, text), (5, text + " and more"), (6, "x " + item)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    lines = {r["doc_id"]: r for r in P.line_stage(spark, docs, sf_dir).collect()}
    assert set(lines) == {1, 2, 4, 5, 6}
    assert lines[2]["text"] == "second of its own" and lines[2]["n_chars"] == 17 and lines[1]["text"] == rows[0][1]
    assert {r["doc_id"] for r in P.near_duplicate_stage(spark, docs, sf_dir).collect()} == {1, 2, 3, 4, 6}
    assert {r["doc_id"] for r in P.decontamination_stage(spark, docs, sf_dir).collect()} == {1, 2, 3, 4, 5}


def test_names_that_the_operators_use_go_through(spark, sf_dir, odd):
    docs = odd.withColumn("n_chars", F.length("text").cast("long")).withColumn("quality score", F.lit(5))
    for name, stage in P.STAGES[:-1]:
        after = P.keep(stage(spark, docs, sf_dir), name)
        assert after.columns == docs.columns
        odd_ones = after.where("removed is not null and removed <> 'y' or score <> 3.0 or `quality score` <> 5").count()
        assert odd_ones == 0, name
    assert P.packing_stage(spark, docs, sf_dir).where("start = 0").count() == docs.count()


def test_near_copies_by_id_and_text(spark, sf_dir):
    """Repeated rows, ids with two texts, and null ids: one document of each group, and no clean one goes."""
    words = [f"w{i}" for i in range(100)]
    copy, near, clean, other = " ".join(words), " ".join(words[:99]), "a clean text of quite different words here", " ".join(reversed(words))
    rows = [(1, copy), (2, near), (2, clean), (3, other), (3, other), (None, copy), (None, other), (None, "only here, without an id, in some words"), (4, None), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"], r["text"]) for r in P.near_duplicate_stage(spark, docs, sf_dir).collect()), key=repr)
    want = [(1, copy), (2, clean), (3, other), (None, "only here, without an id, in some words"), (4, None), (4, None), (5, "")]
    assert got == sorted(want, key=repr)
