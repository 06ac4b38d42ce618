"""Quality by importance resampling: hashed n-gram models and Gumbel top-k.

Two generative models over hashed n-grams are counted: the target model from
texts labelled good, the raw model from all texts.  A document's importance is
the log ratio of its probability under the two.  Adding independent Gumbel
noise and taking the k largest keys samples k documents without replacement in
proportion to their importance.

The n-grams (orders 1 to 3) run over word shapes, so that they carry over to
words never seen: runs of lower-case and non-ASCII letters, of capitals and of
digits become one mark each, every other character stays itself, and a word
equal to the one before it is marked as a repetition.

The raw model covers all texts.  Target texts come from at most ``max_rows``
labelled ids chosen by the hash of the id (a parameter, so the broadcast list
has a proven bound).  The models are two vectors of fixed size.  The noise is
a function of the id and the seed, so a lost task draws the same again; rows
with one id share it.

``k`` is a share of the rows.  By default it is the upper end of the 99 %
interval of the share of good rows among the sampled labels (everything is
kept without labels).

Defined cases: null and empty texts have no n-grams and importance 0; ties of
the key are broken by the id, rows equal in both stay or go together; labels
with a null id or class are left out, repeated labels count as good if any is;
extra columns stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField

from shelfwise.llm.arrowtext import SPACE, blocks, byte_table, free, hash_spans, map_rows, mix, small_batches, spans
from shelfwise.llm.common import fresh, partitions, written

BITS = 16
ORDERS = 3
_SLICE = 1 << 12

_CLASS = np.arange(256, dtype=np.uint8)          # the mark a byte counts as
_CLASS[97:123] = 97
_CLASS[128:] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48
_RUNS = np.isin(np.arange(256), (97, 65, 48))    # marks that stand for a whole run
_SHAPES, _WORDS = byte_table(21), byte_table(22)


def shapes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shape hash, row) of each word."""
    starts, ends, row = spans(data, off, SPACE)
    if not len(starts):
        return np.zeros(0, np.uint64), row
    marks = _CLASS[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (marks[1:] != marks[:-1]) | ~_RUNS[marks[1:]]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    shape = hash_spans(marks[keep], at[starts], at[ends], _SHAPES)
    word = hash_spans(data, starts, ends, _WORDS)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    shape[again] ^= np.uint64(0x5851F42D4C957F2D)
    return shape, row


def ngrams(data: np.ndarray, off: np.ndarray, orders: int = ORDERS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of all n-grams of 1 to ``orders`` words."""
    s, row = shapes(data, off)
    b, r, h = [], [], s
    for n in range(1, orders + 1):
        if n > 1:
            if len(s) < n:
                break
            h = mix(h[:-1] * np.uint64(3) + s[n - 1:])
        ok = row[: len(h)] == row[n - 1:]
        b.append((h[ok] >> np.uint64(64 - bits)).astype(np.int64))
        r.append(row[: len(h)][ok])
    return np.concatenate(b), np.concatenate(r)


@dataclass
class Ratio:
    """Log ratio of target to raw probability for each bucket, and the estimated share of good rows."""
    log_ratio: np.ndarray
    share: float


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", max_rows: int = 20_000, bits: int = BITS, orders: int = ORDERS, alpha: float = 0.5) -> Ratio:
    small_batches(spark)
    y = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("good")).dropna()
    y = y.groupBy("_id").agg(F.max("good").alias("good")).orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    y = written(spark, y, "quality-labels")
    stat = y.agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("g")).first()
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    d = d.join(F.broadcast(y), "_id", "left").select("text", F.coalesce("good", F.lit(0)).alias("good"))

    def count(batches):
        sums = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            for rows, data, off in blocks(batch, "text"):
                good = rows.column("good").to_numpy(zero_copy_only=False) == 1
                b, row = ngrams(data, off, orders, bits)
                sums[0] += np.bincount(b, minlength=1 << bits)
                sums[1] += np.bincount(b[good[row]], minlength=1 << bits)
        for c in (0, 1):
            for k in range(0, 1 << bits, _SLICE):
                part = sums[c, k: k + _SLICE]
                used = np.flatnonzero(part)
                if len(used):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int64()), pa.array([c], pa.int32()),
                         pa.array([used.astype(np.uint16).tobytes()], pa.binary()), pa.array([part[used].tobytes()], pa.binary())],
                        names=["slice", "model", "at", "n"])

    def add(key, pdf):
        import pandas as pd
        s = np.zeros(_SLICE, np.int64)
        for a, n in zip(pdf["at"], pdf["n"]):
            s[np.frombuffer(a, np.uint16)] += np.frombuffer(n, np.int64)
        return pd.DataFrame({"slice": [key[0]], "model": [key[1]], "n": [s.tobytes()]})

    parts = d.mapInArrow(count, "slice long, model int, at binary, n binary")
    counts = np.zeros((2, 1 << bits))
    for r in parts.groupBy("slice", "model").applyInPandas(add, "slice long, model int, n binary").collect():   # fixed size
        counts[r["model"], r["slice"]: r["slice"] + _SLICE] = np.frombuffer(r["n"], np.int64)
    p = (counts + alpha) / (counts.sum(axis=1, keepdims=True) + alpha * (1 << bits))
    n, g = stat["n"], stat["g"] or 0
    ratio = np.log(p[1]) - np.log(p[0]) if g else np.zeros(1 << bits)
    share = min(1.0, g / n + 2.58 * math.sqrt(g / n * (1 - g / n) / n) + 1 / n) if n else 1.0
    return Ratio(ratio, share)


def gumbel(id_col: str = "doc_id", seed: int = 1) -> Column:
    """A standard Gumbel variate for each id."""
    u = (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def weigh(docs: DataFrame, ratio: Ratio, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
          seed: int = 1, names: tuple[str, str, str] = ("n_grams", "log_ratio", "key"), orders: int = ORDERS) -> DataFrame:
    """``docs`` with the number of n-grams, the importance (rounded to 6 places) and the perturbed key.

    Columns of these names stay, and the new ones get underscores until their names are free."""
    kept = docs.columns if keep is None else keep
    names = tuple(free(x, kept) for x in names)
    bits = int(math.log2(len(ratio.log_ratio)))
    shared = docs.sparkSession.sparkContext.broadcast(ratio.log_ratio)

    def fn(rows, data, off):
        b, row = ngrams(data, off, orders, bits)
        w = np.bincount(row, weights=shared.value[b], minlength=rows.num_rows).astype(float)     # integers without rows
        return [pa.array(np.bincount(row, minlength=rows.num_rows).astype(np.int64)), pa.array(np.round(w, 6))]

    out = map_rows(docs, fn, [StructField(names[0], LongType()), StructField(names[1], DoubleType())], text_col, keep)
    return out.withColumn(names[2], F.col(names[1]) + F.coalesce(gumbel(id_col, seed), F.lit(0.0)))


def kth(spark: SparkSession, keys: DataFrame, k: int, id_col: str = "id", key_col: str = "key"):
    """(key, id) of the k-th largest row, or None when there are fewer rows.

    The keys are range-partitioned; the counts of the partitions tell which
    one holds the row, and only that one is sorted.
    """
    if k <= 0:
        return None
    r = keys.select(F.col(key_col).alias("key"), F.col(id_col).alias("id"))
    r = r.repartitionByRange(partitions(spark), F.col("key").desc(), F.col("id").desc_nulls_last())
    r = written(spark, r.withColumn("part", F.spark_partition_id()), "keys")
    before = 0
    for p in r.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():     # a row for each partition
        if before + p["n"] >= k:
            top = r.where(F.col("part") == p["part"]).orderBy(F.col("key").desc(), F.col("id").desc_nulls_last())
            return top.offset(k - before - 1).limit(1).select("key", "id").first()
        before += p["n"]
    return None


def sampled(cut, id_col: str = "doc_id", key_col: str = "key") -> Column:
    """Whether a row is among the k: its key and id reach those of ``cut``."""
    if cut is None:
        return F.lit(True)
    same = F.lit(True) if cut["id"] is None else F.coalesce(F.col(id_col) >= cut["id"], F.lit(False))
    return (F.col(key_col) > cut["key"]) | ((F.col(key_col) == cut["key"]) & same)


def resample(spark: SparkSession, docs: DataFrame, ratio: Ratio, share: float | None = None, seed: int = 1,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sampled rows of ``docs`` with its columns."""
    names = tuple(fresh(x, docs) for x in ("n_grams", "log_ratio", "key"))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keys = written(spark, weigh(slim, ratio, "id", "text", ["id"], seed), "importance")
    n = keys.count()
    cut = kth(spark, keys, math.ceil((ratio.share if share is None else share) * n)) if n else None
    return weigh(docs, ratio, id_col, text_col, None, seed, names).where(sampled(cut, id_col, names[2])).drop(*names)
