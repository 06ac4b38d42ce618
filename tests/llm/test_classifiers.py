"""Importance resampling and toxicity: held-out accuracy, plain versions, defined cases."""

import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import importance, toxicity
from shelfwise.llm.common import table

SF = "/root/testdata/sf0.01"


def buffer(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])


def test_shapes():
    a, rows = importance.shapes(*buffer(["The cat", "THE  éa&&", "x X x x x 12 3", ""]))
    assert rows.tolist() == [0, 0, 1, 1, 2, 2, 2, 2, 2, 2, 2]
    assert a[4] == a[6] and a[7] == a[8] and a[7] != a[4] and a[9] == a[10] and a[0] != a[1] and a[4] == a[1] and a[5] == a[2]


def test_ngrams_stay_in_rows():
    b, rows = importance.ngrams(*buffer(["a b c", "d", "", "e f"]))
    assert np.bincount(rows, minlength=4).tolist() == [6, 1, 0, 3]
    one, _ = importance.ngrams(*buffer(["a b c"]))
    assert sorted(b[rows == 0].tolist()) == sorted(one.tolist())


def test_quality_on_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    ratio = importance.fit(spark, docs, labels.where("doc_id % 2 = 0"))
    held = importance.weigh(docs, ratio, keep=["doc_id"]).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r["log_ratio"] for r in held if r["quality"] == 1]
    bad = [r["log_ratio"] for r in held if r["quality"] == 0]
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.99
    kept = importance.resample(spark, docs, ratio)
    assert kept.columns == docs.columns
    assert kept.count() == math.ceil(ratio.share * docs.count())
    clean = labels.where("quality = 1")
    assert kept.join(clean, "doc_id").count() >= 0.98 * docs.join(clean, "doc_id").count()


def test_kth_equals_sorting(spark):
    rows = [(i, float(i % 7)) for i in range(50)] + [(50, 3.0), (50, 3.0), (None, 9.0)]
    df = spark.createDataFrame(rows, "id long, key double").repartition(3)
    order = sorted(rows, key=lambda r: (r[1], r[0] is not None, r[0] or 0), reverse=True)
    for k in (1, 2, 10, 25, 53):
        cut = importance.kth(spark, df, k)
        assert (cut["id"], cut["key"]) == order[k - 1]
        kept = df.where(importance.sampled(cut, "id")).count()
        assert kept >= k and kept <= k + 1
    assert importance.kth(spark, df, 54) is None and importance.kth(spark, df, 0) is None


CASES = [(1, "good words here " * 20, "w"), (2, None, "w"), (3, "", "w"), (None, "no id", "w"), (1, "good words here " * 20, "w"), (4, "A!! " * 9000, "w"), (5, "éà ü", "w")]


def test_importance_cases(spark):
    docs = spark.createDataFrame([(*r, 0.5, "k") for r in CASES], "doc_id long, text string, log_ratio string, key double, _id string")
    labels = spark.createDataFrame([(1, 1, 9), (1, 0, 9), (4, 0, 9), (None, 1, 9), (5, None, 9)], "doc_id long, quality int, good int")
    ratio = importance.fit(spark, docs, labels)
    out = importance.resample(spark, docs, ratio, share=0.6)
    assert out.columns == docs.columns and 5 <= out.count() <= 6
    assert importance.resample(spark, docs, ratio, share=1.0).count() == len(CASES)
    none = importance.fit(spark, docs, labels.limit(0))
    assert none.share == 1.0 and importance.resample(spark, docs, none).count() == len(CASES)
    assert importance.resample(spark, docs.limit(0), importance.fit(spark, docs.limit(0), labels)).count() == 0
    w = {r["text"]: r["w"] for r in importance.weigh(docs.drop("key"), ratio, keep=["doc_id", "text"], names=("n", "w", "key")).collect()}
    assert w[None] == w[""] == 0.0 and w["good words here " * 20] > w["A!! " * 9000]


def test_gumbel_is_standard(spark):
    g = spark.range(20_000).select(importance.gumbel("id").alias("g")).agg(F.avg("g"), F.var_samp("g")).first()
    assert g[0] == pytest.approx(0.5772, abs=0.03) and g[1] == pytest.approx(math.pi ** 2 / 6, abs=0.06)


def test_toxicity_held_out(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    model = toxicity.train(spark, docs, labels, where=F.col("id") % 4 != 1)
    got = toxicity.score(docs, model, keep=["doc_id"]).join(labels, "doc_id").where("doc_id % 4 = 1").collect()
    pos, neg = ([r["score"] for r in got if r["toxic"] == y] for y in (1, 0))
    assert np.mean([[(p > n) + 0.5 * (p == n) for n in neg] for p in pos]) > 0.85         # some 300 texts to learn from; over 0.99 with 14,000
    assert sum(n >= 0.7 for n in neg) <= 0.02 * len(neg)


def plain_features(text, model):
    raw = bytes(toxicity._FOLD[list(text.encode())]) if text else b""
    buckets = set()
    for n in model.orders:
        for i in range(len(raw) - n + 1):
            data = np.frombuffer(raw[i:i + n], np.uint8)
            buckets |= {int(b[0]) for k, b in toxicity._buckets(data, model.orders, model.bits) if k == n}
    return [w for f, w in zip(model.features.tolist(), model.weights) if f in buckets]


def test_toxicity_cases(spark):
    rows = [(i, ("you total scumbag " if i % 3 == 0 else "you kind person ") + f"number {i}", "s") for i in range(60)]
    docs = spark.createDataFrame([*rows, (100, None, "s"), (101, "", "s"), (None, "SCUMBAG", "s"), (5, rows[5][1], "s"), (102, "scumbag\t" * 20_000, "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(50)] + [(None, 1, 1), (51, None, 1), (0, 0, 1)], "doc_id long, toxic int, label int")
    model = toxicity.train(spark, docs, labels)
    out = toxicity.score(docs.drop("score"), model).collect()
    assert len(out) == 65
    by = {r["text"]: r["score"] for r in out}
    assert by["SCUMBAG"] > 0.5 > by["you kind person number 1"] and by["you total scumbag number 57"] >= 0.7
    assert by[None] == by[""] == pytest.approx(1 / (1 + math.exp(-model.bias)), abs=1e-8)
    for t in ("you kind person number 1", "SCUMBAG"):
        assert by[t] == pytest.approx(1 / (1 + math.exp(-(model.bias + sum(plain_features(t, model))))), abs=1e-6)
    kept = toxicity.keep_clean(spark, docs, model)
    assert kept.columns == docs.columns and not [r for r in kept.collect() if r["text"] and "scumbag" in r["text"].lower()]
    for some, exp in ((labels.limit(0), 0.0), (labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0)):
        assert {round(r["score"]) for r in toxicity.score(docs.drop("score"), toxicity.train(spark, docs, some)).collect()} == {exp}
    assert toxicity.score(docs.limit(0), model, "s").count() == 0


def plain_fit(sizes, f, y, ratio, l2, steps):
    """The same descent over all features at once."""
    row, x = np.repeat(np.arange(len(y)), sizes), ratio[f]
    cw = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    step = 4.0 / (np.sum(cw * (np.bincount(row, weights=x * x, minlength=len(y)) + 1)) + l2)
    w, b = np.zeros(len(ratio)), 0.0
    vw, vb, t = w, b, 1.0
    for _ in range(steps):
        z = np.bincount(row, weights=vw[f] * x, minlength=len(y)) + vb
        g = cw * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        nw, nb = vw - step * (np.bincount(f, weights=g[row] * x, minlength=len(ratio)) + l2 * vw), vb - step * g.sum()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


@pytest.mark.parametrize("block", [1, 7, 100, 1 << 18])
def test_fit_over_parts_equals_the_whole(block):
    rng = np.random.default_rng(block)
    for sizes in ([3, 0, 5, 1, 0], [0, 0, 2], [0, 0], rng.integers(0, 30, 200)):
        sizes = np.array(sizes)
        f = np.concatenate([np.zeros(0, int), *[np.sort(rng.choice(40, n, replace=False)) for n in sizes]])
        y = (np.arange(len(sizes)) % 2).astype(float)
        ratio = rng.normal(size=40)
        w, b = toxicity._logistic(sizes, f.astype(np.uint16), y, ratio, 1e-4, 20, block)
        pw, pb = plain_fit(sizes, f, y, ratio, 1e-4, 20)
        assert np.array_equal(w, pw) and b == pb


def test_driver_holds_few_bytes_a_feature(spark):
    rng = np.random.default_rng(5)
    rows = [(i, bytes(rng.integers(97, 123, 30_000, np.uint8)).decode(), i % 2) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    tracemalloc.start()
    model = toxicity.train(spark, docs.drop("toxic"), docs.drop("text"), orders=(3,), bits=14, steps=3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    present = sum(len(set(toxicity._present(*buffer([t]), model.lookup(), (3,), 14)[1].tolist())) for _, t, _ in rows)
    assert len(model.features) == 8192 and present > 1_000_000
    assert peak < 20 * present
