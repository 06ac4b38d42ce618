"""Katz backoff against a plain model on whole texts, and its sums to one."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import katz

SPACES = " \t\n\x0b\x0c\r"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for s in SPACES:
        low = low.replace(s, " ")
    return [w for w in low.split(" ") if w]


class Plain:
    """The model as its formulas say, over dictionaries."""

    def __init__(self, texts):
        self.uni, self.bi, self.ctx = Counter(), Counter(), Counter()
        for t in texts:
            seq = [*words(t), None]
            self.uni.update(seq)
            for h, w in zip([0, *seq], seq):
                self.bi[h, w] += 1
                self.ctx[h] += 1
        self.n = sum(self.uni.values())
        self.d1, self.d2 = (katz.discounts([0, *(sum(c == r for c in x.values()) for r in range(1, katz.K + 2))]) for x in (self.uni, self.bi))
        self.unknown = 1 - sum(self.dis(c, self.d1) for c in self.uni.values()) / (self.n + 1)
        kept, low = defaultdict(float), defaultdict(float)
        for (h, w), c in self.bi.items():
            kept[h] += self.dis(c, self.d2)
            low[h] += self.p1(w)
        self.alpha = {h: (1 - kept[h] / (c + 1)) / (1 - low[h]) for h, c in self.ctx.items()}

    @staticmethod
    def dis(c, d):
        return c * (d[c] if c <= katz.K else 1.0)

    def p1(self, w):
        return self.dis(self.uni[w], self.d1) / (self.n + 1) if w in self.uni else self.unknown

    def p2(self, h, w):
        if (h, w) in self.bi:
            return self.dis(self.bi[h, w], self.d2) / (self.ctx[h] + 1)
        return self.alpha.get(h, 1.0) * self.p1(w)

    def score(self, text):
        seq = [*words(text), None]
        return sum(math.log10(self.p2(h, w)) for h, w in zip([0, *seq], seq))

    def base(self, text):
        return sum(math.log10((self.uni.get(w, 0) + 1) / (self.n + len(self.uni) + 1)) for w in [*words(text), None])


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def compare(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = katz.score(spark, df.repartition(3), F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, **how).collect()
    model = Plain([t for i, t, _ in rows if not held(i)])
    assert len(got) == len(rows)
    exp = sorted((str(i), held(i), len(words(t)) + 1, sum(w in model.uni for w in [*words(t), None]), round(model.base(t), 4), round(model.score(t), 4))
                 for i, t, _ in rows)
    out = sorted((str(r["id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 4), round(r["score"], 4)) for r in got)
    for a, b in zip(exp, out):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], abs=2e-4)
    assert {r["train_tokens"] for r in got} == {model.n}
    return model


@pytest.fixture(scope="module")
def rows(spark, documents):
    some = [(i, t, "x") for i, t in documents[:150]]
    return [*some, (9000, None, "x"), (9001, "", "x"), (None, "no id of its own", "x"), some[0], some[0], (9002, "the " * 3000, "x"), (9003, "Éa\x0bé\x1cb  the　The", "x")]


def test_equals_plain_model(spark, rows):
    model = compare(spark, rows)
    for h in [0, "the", "of", next(iter(model.ctx))]:
        total = sum(model.p2(h, w) for w in model.uni) + model.p2(h, "never seen")
        assert total == pytest.approx(1.0, abs=1e-9)


def test_hot_contexts_and_small_packs(spark, rows):
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        compare(spark, rows, flush=700)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_few_texts(spark):
    compare(spark, [(1, "a b a b", ""), (2, "a c", ""), (16, "b b z", "")])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert katz.score(spark, df, F.lit(False)).collect() == []


def test_discounts_keep_the_mass():
    d = katz.discounts([0, 1000, 300, 150, 80, 50, 40])
    assert d[0] == 0 and all(0 < x <= 1 for x in d[1:])
    n = [0, 1000, 300, 150, 80, 50]
    freed = sum((1 - d[r]) * r * n[r] for r in range(1, 6))
    assert freed == pytest.approx(n[1])          # Good-Turing leaves n1 to the unseen
    assert all(0 < x < 1 for x in katz.discounts([0, 3, 0, 0, 0, 0, 0])[1:])


class PlainOrder(Plain):
    """Any order, as the recursive formula says."""

    def __init__(self, texts, order):
        super().__init__(texts)
        self.order, self.grams, self.followers = order, Counter(), defaultdict(dict)
        for t in texts:
            seq = [0] * (order - 1) + [*words(t), None]
            for i in range(order - 1, len(seq)):
                for k in range(1, order + 1):
                    self.grams[tuple(seq[i - k + 1: i + 1])] += 1
        for g, c in self.grams.items():
            self.followers[g[:-1]][g[-1]] = c
        by = {k: Counter(c for g, c in self.grams.items() if len(g) == k) for k in range(1, order + 1)}
        self.d = {k: katz.discounts([0, *(n[r] for r in range(1, katz.K + 2))]) for k, n in by.items()}
        self.weights = {}

    def p(self, h, w):
        if not h:
            return self.p1(w)
        seen = self.followers.get(h, {})
        total = sum(seen.values())
        if w in seen:
            return self.dis(seen[w], self.d[len(h) + 1]) / (total + 1)
        if not seen:
            return self.p(h[1:], w)
        if h not in self.weights:
            kept = sum(self.dis(c, self.d[len(h) + 1]) for c in seen.values())
            self.weights[h] = (1 - kept / (total + 1)) / (1 - sum(self.p(h[1:], x) for x in seen))
        return self.weights[h] * self.p(h[1:], w)

    def score(self, text):
        seq = [0] * (self.order - 1) + [*words(text), None]
        return sum(math.log10(self.p(tuple(seq[i - self.order + 1: i]), seq[i])) for i in range(self.order - 1, len(seq)))


@pytest.mark.parametrize("order", [1, 3, 4])
def test_orders_equal_plain_model(spark, rows, order):
    df = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    got = katz.score(spark, df, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, order=order).collect()
    m = PlainOrder([t for i, t, _ in rows if not held(i)], order)
    exp = sorted((str(i), held(i), len(words(t)) + 1, sum(w in m.uni for w in [*words(t), None]), round(m.base(t), 4), round(m.score(t), 4)) for i, t, _ in rows)
    out = sorted((str(r["id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 4), round(r["score"], 4)) for r in got)
    for a, b in zip(exp, out, strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=2e-4)


def test_longer_contexts_tell_texts_apart(spark):
    """The same bigrams in another order: only contexts of two words see it."""
    df = spark.createDataFrame([(1, "a b c a d b e", False), (2, "a b c a d b e", False), (3, "a b e", True), (4, "d b e", True)], "doc_id long, text string, h boolean")
    s = {k: {r["id"]: r["score"] for r in katz.score(spark, df, F.col("h"), order=k).collect()} for k in (2, 3)}
    m = PlainOrder(["a b c a d b e"] * 2, 3)
    assert all(s[3][i] == pytest.approx(m.score(t), abs=1e-5) for i, t in ((3, "a b e"), (4, "d b e")))
    assert s[3][3] != pytest.approx(s[2][3], abs=1e-3)


def test_stored_orders_sum_to_one(spark, rows):
    d = spark.createDataFrame([(i, t, not held(i)) for i, t, _ in rows], "id long, text string, train boolean")
    g = katz._grams(d, 3).groupBy("w0", "w1", "w2").agg(F.sum(F.col("train").cast("long")).alias("c"))
    tables, _, _ = katz.model(spark, g, 3)
    for k, context in ((2, ["w1"]), (3, ["w1", "w2"])):
        below = tables[k - 2].select(*[f"w{j}" for j in range(k - 1)], F.col("p").alias("q"))
        t = tables[k - 1].where("c > 0").join(below, [f"w{j}" for j in range(k - 1)])
        sums = t.groupBy(*context).agg(F.sum("p").alias("p"), F.sum("q").alias("q"), F.max("alpha").alias("a"))
        far = sums.select(F.max(F.abs(F.col("p") + F.col("a") * (1 - F.col("q")) - 1))).first()[0]
        assert far < 1e-9
    words_ = tables[0].where("c > 0").agg(F.sum("p")).first()[0]
    unknown = tables[0].where("c = 0").select("p").distinct().collect()
    assert all(words_ + r["p"] == pytest.approx(1.0, abs=1e-9) for r in unknown)
