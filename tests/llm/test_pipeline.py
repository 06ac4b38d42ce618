"""The corpus pipeline: each stage's decisions, odd rows, and the whole run."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import decontaminate, importance, toxicity
from shelfwise.llm.common import table

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def odd(spark):
    """The small documents with odd rows and columns whose names the operators use themselves."""
    d = table(spark, SF, "documents")
    more = spark.createDataFrame([(90001, None, "en", "s", 0), (90002, "", "en", "s", 0), (None, "a text without an id", None, None, None),
                                  (90003, "long " * 60_000, "en", "s", 1), (90003, "long " * 60_000, "en", "s", 1)], d.schema)
    d = d.unionByName(more)
    for c in ("score", "key", "n_words", "n_hit", "_id", "node", "log_ratio", "n_grams", "rid", "ids", "_rid"):
        d = d.withColumn(c, F.lit("clash"))
    return d


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows(spark, name):
    d = odd(spark)
    out = STAGES[name](spark, d, SF)
    n = out.count()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == d.columns and [f.dataType for f in out.schema] == [f.dataType for f in d.schema]
        assert 0.5 * d.count() < n < d.count() + (name == "quality_classifier")
        assert out.exceptAll(d).count() == 0
        assert STAGES[name](spark, d.limit(0), SF).count() == 0
    else:
        assert n == d.count() and out.where("NOT round_trip").count() == 0
        assert out.where("ids IS NULL").count() == 1


def test_stages_take_effect(spark):
    d = table(spark, SF, "documents")
    ratio = importance.fit(spark, d, table(spark, SF, "labels"))
    worst = importance.weigh(d, ratio, keep=["doc_id"]).orderBy("log_ratio").first()["doc_id"]
    kept = STAGES["quality_classifier"](spark, d, SF)
    assert kept.where(F.col("doc_id") == worst).count() == 0
    model = toxicity.train(spark, d, table(spark, SF, "labels"))
    bad = {r["doc_id"] for r in toxicity.score(d, model, keep=["doc_id"]).where("score >= 0.7").collect()}
    assert {r["doc_id"] for r in d.collect()} - {r["doc_id"] for r in STAGES["toxicity"](spark, d, SF).collect()} == bad and bad
    hits = decontaminate.hits(spark, d, table(spark, SF, "benchmark"))
    dirty = {r["doc_id"] for r in hits.where(decontaminate.contaminated()).collect()}
    left = {r["doc_id"] for r in STAGES["decontamination"](spark, d, SF).collect()}
    assert dirty and left == {r["doc_id"] for r in d.collect()} - dirty


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    n = table(spark, SF, "documents").count()
    assert 0.4 * n < len(rows) < n and all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(rows)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "toxicity", "ngram_jaccard", "decontamination", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None
