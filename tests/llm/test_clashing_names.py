"""Tables that already have a column of a result's name: it stays, and the new one is found under a free name."""

import numpy as np

from shelfwise.llm import importance, licenses, pieces, toxicity

ROWS = [(1, "Some text, and more of it.", "own", 7.0, "a"), (2, None, None, None, None), (3, "", "x", 0.5, "b")]


def table(spark, *names):
    return spark.createDataFrame([r[:2 + len(names)] for r in ROWS], "doc_id long, text string" + "".join(f", {n} {t}" for n, t in zip(names, ("string", "double", "string"))))


def check(df, out, new):
    assert out.columns == [*df.columns, *new]
    got = {r["doc_id"]: r for r in out.collect()}
    for r in df.collect():
        assert all(got[r["doc_id"]][c] == r[c] for c in df.columns)
    return got


def test_toxicity_score(spark):
    df = table(spark, "score", "score_")
    plain = spark.createDataFrame([r[:2] for r in ROWS], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.train(spark, plain, labels)
    got = check(df, toxicity.score(df, model), ["score__"])
    assert {k: r["score__"] for k, r in got.items()} == {r["doc_id"]: r["score"] for r in toxicity.score(plain, model).collect()}
    assert toxicity.keep_clean(spark, df, model).columns == df.columns


def test_licenses(spark):
    df = table(spark, "licenses", "best")
    got = check(df, licenses.scan(df, best="best"), ["licenses_", "best_"])
    assert got[1]["licenses_"] == [] and got[1]["best_"] is None
    check(df.select("doc_id", "text"), licenses.scan(df.select("doc_id", "text"), out="x", best="x"), ["x", "x_"])


def test_pieces(spark):
    df = table(spark, "ids", "ok")
    v = pieces.load()
    got = check(df, pieces.encode(df, v, check="ok"), ["ids_", "ok_"])
    assert got[1]["ids_"] and got[1]["ok_"] and got[2]["ids_"] is None
    assert {r["doc_id"]: r["text"] for r in pieces.decode(pieces.encode(df, v), v, "ids_").collect()} == {r[0]: r[1] for r in ROWS}


def test_importance(spark):
    df = table(spark, "key", "n_grams", "log_ratio")
    ratio = importance.Ratio(np.zeros(1 << importance.BITS), 1.0)
    got = check(df, importance.weigh(df, ratio), ["n_grams_", "log_ratio_", "key_"])
    assert got[1]["n_grams_"] > 0 and got[1]["key_"] is not None
    assert importance.resample(spark, df, ratio).columns == df.columns
