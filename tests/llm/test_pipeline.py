import hashlib

import corpus_pipeline
from tessera.llm import decontamination, jaccard_join, line_dedup, toxicity
from tessera.llm.common import saved

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), name)
        assert docs.count() <= n
        n = docs.count()
        if name != "encoding":
            assert docs.columns == columns
    assert n > 50 and docs.where("not round_trip").count() == 0


def test_awkward_rows(spark, documents):
    """All stages on nulls, empties, repeated rows and long texts."""
    docs = documents.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), name)
    assert docs.where("text is null").count() == 1
    assert docs.groupBy("doc_id").count().where("count > 1").count() == 0


def test_rows_that_stay(spark, tmp_path):
    """Each stage on its own input against SQL of its rule, run by another engine over that input."""
    import duckdb

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = toxicity.score(docs, toxicity.fit(docs, labels))
    now = saved(stages["toxicity"](spark, docs, SF), "t")
    assert sorted(r[0] for r in now.select("doc_id").collect()) == sorted(r[0] for r in scores.where("predicted = 0").select("doc_id").collect())
    for name, sql, rule in (
        ("lines", line_dedup.SQL, None), ("near_duplicates", jaccard_join.SQL, "kept"), ("decontamination", decontamination.SQL, "not contaminated"),
    ):
        now.write.parquet(f"{tmp_path}/{name}")
        db = duckdb.connect()
        db.sql(f"create view documents as select * from '{tmp_path}/{name}/*.parquet'")
        db.sql(f"create view benchmark as select * from '{SF}/benchmark.parquet'")
        before, now = now, saved(stages[name](spark, now, SF), name)
        if rule:
            want = db.sql(f"select d.* from documents d join ({sql}) using (doc_id) where {rule}").fetchall()
            assert sorted(map(str, map(tuple, now.select(before.columns).collect()))) == sorted(map(str, want))
        else:
            want = dict(db.sql(f"select doc_id, kept_sha256 from ({sql})").fetchall())
            got = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in now.collect()}
            assert all(want[d] == h for d, h in got.items())
            lost = {r["doc_id"] for r in before.select("doc_id").collect()} - set(got)
            blank = {d for d, t, n in db.sql(f"select doc_id, text, n_removed from documents join ({sql}) using (doc_id)").fetchall() if n and d in lost}
            assert lost == blank


def test_short_lines(spark):
    """Exact repeats of short lines go, in a document and across documents; blank lines and near ones stay."""
    docs = spark.createDataFrame([(1, "Les.\n\nLes.\nLea.", "en", "s", 15), (2, "Les.\n\nalone here", "en", "s", 16)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, SF).collect()}
    assert got == {1: "Les.\n\nLea.", 2: "\nalone here"}


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), name)
    assert docs.count() == 0
