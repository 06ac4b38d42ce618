"""Toxicity by a linear classifier over character n-grams (NB-SVM style).

Features are the presence of hashed n-grams of the UTF-8 bytes of a text
(A-Z lowered, white space as a space).  Each feature is scaled by its naive
Bayes log-count ratio between toxic and other training texts, and a logistic
model with an L2 penalty is trained on the scaled features.

Training uses at most ``max_rows`` labelled texts, chosen by the hash of their
id, and the ``n_features`` n-grams with the largest chi-square statistic: both
bounds are parameters, so the sample, the count vectors and the model that
pass through the driver have a fixed size.  Counting and feature extraction
run in tasks over the sample; scoring is a map over all whole texts.  The
driver holds two bytes for each feature of a sampled text and fits over parts
of them.

Defined cases: null and empty texts get the score of a text without features;
labels with a null id or class are left out, repeated labels count as toxic if
any is; without labels of both classes every score is the base rate (0 without
labels); extra columns are ignored in training and kept in scoring.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from shelfwise.llm.arrowtext import LOWER, SPACE, blocks, byte_table, free, map_rows, release, small_batches
from shelfwise.llm.common import fresh, written

BITS = 20
ORDERS = (3, 4, 5, 6)
_SLICE = 1 << 14                    # buckets in one row of the count vectors

_FOLD = LOWER.copy()
_FOLD[SPACE] = 32
_TABLE = (byte_table(11, _FOLD) >> np.uint64(32)).astype(np.uint32)


def _buckets(data: np.ndarray, orders: tuple[int, ...], bits: int):
    """(order, bucket of the n-gram starting at each byte); n-grams may cross rows."""
    t = _TABLE[data]
    h = t
    for n in range(2, max(orders, default=0) + 1):
        if len(t) < n:
            return
        h = h[:-1] * np.uint32(0x01000193) + t[n - 1:]
        if n in orders:
            yield n, ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits)


def _in_rows(pos: np.ndarray, n: int, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions whose n-gram ends within its row, and those rows."""
    row = np.searchsorted(off, pos, "right") - 1
    ok = pos + n <= off[row + 1]
    return ok, row[ok]


@dataclass
class Model:
    """Feature buckets, their weights (already scaled by the log-count ratios) and the bias."""
    features: np.ndarray
    weights: np.ndarray
    bias: float
    orders: tuple[int, ...] = ORDERS
    bits: int = BITS

    def lookup(self) -> np.ndarray:
        t = np.full(1 << self.bits, -1, np.int32)
        t[self.features] = np.arange(len(self.features), dtype=np.int32)
        return t


def _present(data: np.ndarray, off: np.ndarray, lookup: np.ndarray, orders: tuple[int, ...], bits: int):
    """(row, feature) pairs, each once, in order."""
    keys = []
    m = np.int64(max(1, lookup.max() + 1))
    for n, b in _buckets(data, orders, bits):
        f = lookup[b]
        pos = np.flatnonzero(f >= 0)
        ok, row = _in_rows(pos, n, off)
        keys.append(row * m + f[pos[ok]])
    key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return key // m, key % m


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int, id_col: str = "doc_id",
                    text_col: str = "text", where: Column | None = None) -> DataFrame:
    """(id, text, label): the texts of at most ``max_rows`` labelled ids."""
    small_batches(docs.sparkSession)
    y = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    y = y if where is None else y.where(where)
    y = y.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return d.join(F.broadcast(y), "id")           # at most max_rows rows of two numbers


def _count_vectors(sample: DataFrame, orders: tuple[int, ...], bits: int) -> DataFrame:
    """(slice, label, counts): presence counts of all buckets by class, summed over tasks."""
    def count(batches):
        sums = np.zeros((2, 1 << bits), np.int32)
        for batch in batches:
            for rows, data, off in blocks(batch, "text"):
                y = rows.column("label").to_numpy(zero_copy_only=False)
                for n, b in _buckets(data, orders, bits):
                    ok, row = _in_rows(np.arange(len(b)), n, off)
                    key = np.unique((row.astype(np.int64) << bits) | b[ok])
                    for c in (0, 1):
                        sums[c] += np.bincount(key[y[key >> bits] == c] & ((1 << bits) - 1), minlength=1 << bits).astype(np.int32)
        for c in (0, 1):
            for k in range(0, 1 << bits, _SLICE):
                part = sums[c, k: k + _SLICE]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int64()), pa.array([c], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "label", "counts"])

    def add(key, pdf):
        import pandas as pd
        s = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in pdf["counts"])
        return pd.DataFrame({"slice": [key[0]], "label": [key[1]], "counts": [s.tobytes()]})

    parts = sample.mapInArrow(count, "slice long, label int, counts binary")
    return parts.groupBy("slice", "label").applyInPandas(add, "slice long, label int, counts binary")


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", where: Column | None = None, max_rows: int = 20_000, n_features: int = 8192,
          orders: tuple[int, ...] = ORDERS, bits: int = BITS, alpha: float = 1.0, l2: float = 1e-4, steps: int = 150) -> Model:
    """A model from at most ``max_rows`` labelled texts; ``where`` (on the column ``id``) picks the labels to learn from."""
    sample = labelled_sample(docs, labels, label_col, max_rows, id_col, text_col, where)
    sample = written(spark, sample.repartition(8, F.xxhash64("id")), "toxic-sample")
    by_class = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = by_class.get(1, 0), by_class.get(0, 0)
    if not n1 or not n0:
        rate = n1 / max(1, n1 + n0)
        bias = -30.0 if not rate else 30.0
        return Model(np.zeros(0, np.int64), np.zeros(0), bias, orders, bits)
    counts = np.zeros((2, 1 << bits))
    for r in _count_vectors(sample, orders, bits).collect():      # two fixed-size vectors
        counts[r["label"], r["slice"]: r["slice"] + _SLICE] = np.frombuffer(r["counts"], np.int64)
    p, q = counts[1], counts[0]
    both = p + q
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = (n1 + n0) * (p * (n0 - q) - q * (n1 - p)) ** 2 / (both * (n1 + n0 - both).clip(1) * n1 * n0)
    chi[both < 3] = 0
    chi = np.nan_to_num(chi)
    features = np.sort(np.argsort(-chi, kind="stable")[:n_features])
    features = features[chi[features] > 0]
    ratio = np.log((p[features] + alpha) / (n1 + 2 * alpha)) - np.log((q[features] + alpha) / (n0 + 2 * alpha))

    chosen = Model(features, ratio, 0.0, orders, bits)
    number = np.uint16 if len(features) <= 1 << 16 else np.int32
    look = spark.sparkContext.broadcast(chosen.lookup())

    def extract(batches):
        for batch in batches:
            for rows, data, off in blocks(batch, "text"):
                row, f = _present(data, off, look.value, orders, bits)
                cut = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows.num_rows))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id").cast(pa.string()), rows.column("label"),
                     pa.array([f[a:b].astype(number).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["id", "label", "f"])

    del counts, p, q, both, chi
    got = sample.mapInArrow(extract, "id string, label int, f binary").toArrow().sort_by([("id", "ascending"), ("label", "ascending")])
    y = got["label"].to_numpy().astype(float)
    f = [np.frombuffer(x.as_buffer(), number) for x in got["f"]]
    sizes = np.array([len(x) for x in f], np.int64)
    f = np.concatenate(f) if f else np.zeros(0, number)
    del got
    release()
    w, b = _logistic(sizes, f, y, ratio, l2, steps)
    look.unpersist()
    return Model(features, w * ratio, b, orders, bits)


def _logistic(sizes: np.ndarray, f: np.ndarray, y: np.ndarray, ratio: np.ndarray, l2: float, steps: int,
              block: int = 1 << 18) -> tuple[np.ndarray, float]:
    """Weights and bias by Nesterov's accelerated gradient on the penalised log loss, with class-balanced weights.

    ``f`` has the features of all rows, one after another, and ``sizes`` how many each row has.  Only whole rows of about
    ``block`` features are held as products at a time; the sums add up in the same order as over all rows at once.
    """
    off = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(off, np.arange(block, off[-1], block)), [len(y)]])).astype(np.int64)

    def parts():
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield slice(a, b), np.repeat(np.arange(b - a), sizes[a:b]), f[off[a]: off[b]].astype(np.int64)

    n1 = y.sum()
    cw = np.where(y > 0, 0.5 / n1, 0.5 / (len(y) - n1))
    # A bound of the curvature: the largest weighted squared norm of a row.
    norms, squares = np.zeros(len(y)), ratio * ratio
    for at, row, x in parts():
        norms[at] = np.bincount(row, weights=squares[x], minlength=at.stop - at.start)
    step = 4.0 / (np.sum(cw * (norms + 1)) + l2)
    w, b = np.zeros(len(ratio)), 0.0
    vw, vb, t = w.copy(), b, 1.0
    g = np.zeros(len(y))
    for _ in range(steps):
        scaled, sums = vw * ratio, np.zeros(len(ratio))
        for at, row, x in parts():
            z = np.bincount(row, weights=scaled[x], minlength=at.stop - at.start) + vb
            g[at] = cw[at] * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[at])
            np.add.at(sums, x, g[at][row] * ratio[x])
        nw = vw - step * (sums + l2 * vw)
        nb = vb - step * g.sum()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


def score(docs: DataFrame, model: Model, out: str = "score", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its ``keep`` columns) with the probability of class 1, rounded to 9 places.

    A column of that name stays, and the new one gets underscores until its name is free."""
    out = free(out, docs.columns if keep is None else keep)
    shared = docs.sparkSession.sparkContext.broadcast((model.lookup(), model.weights, model.bias))
    orders, bits = model.orders, model.bits

    def fn(rows, data, off):
        lookup, weights, bias = shared.value
        row, f = _present(data, off, lookup, orders, bits)
        z = np.bincount(row, weights=weights[f], minlength=rows.num_rows) + bias
        return [pa.array(np.round(1 / (1 + np.exp(-np.clip(z, -40, 40))), 9))]

    return map_rows(docs, fn, [StructField(out, DoubleType())], text_col, keep)


def keep_clean(spark: SparkSession, docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; same columns."""
    name = fresh("score", docs)
    return score(docs, model, name, text_col).where(F.col(name) < threshold).drop(name)
