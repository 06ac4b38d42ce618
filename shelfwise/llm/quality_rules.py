"""Quality rules with host verdicts, in DataFrame functions only.

Every document is measured against text rules.  Rule failures are then summed
by host, each host's failure rate is shrunk towards the rate of all hosts with
a beta prior fitted to the hosts themselves, and the host's verdict is joined
back to its documents: a document is kept when it passes the rules itself and
its host's shrunk failure rate stays within the limit.

Shuffles: one partial aggregate by host (a row for each host and task) and the
join of host verdicts to the measured rows, which carry no text.  The measures
are arrays within a row and never leave it.

Defined cases: a null or empty text has no words and fails the minimum of
words; a null host is a host of its own; repeated rows count and stay as often
as they occur; extra columns are ignored; an empty table gives an empty result.
A window of words is compared by its 64-bit hash within its own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import space_words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Columns (id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    d = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    d = d.select("id", "host", space_words(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
                 F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    d = d.select("id", "host", "n_symbols", F.size("w").cast("long").alias("n_words"),
                 F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.transform("w", lambda x: F.xxhash64(x)).alias("w"))
    return repeated(d).select(
        "id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated(d: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words of ``w`` (word hashes) inside windows that occur at least twice.

    The window hashes of one text are sorted with their positions; only texts
    whose distinct hashes are fewer than their windows pay for the sort.
    """
    at = F.get
    spans = F.when(F.size("w") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("w") - WINDOW),
        lambda i: F.xxhash64(*[at(F.col("w"), i + k) for k in range(WINDOW)])))
    d = d.withColumn("h", F.coalesce(spans, F.array().cast("array<bigint>")))
    d = d.withColumn("s", F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    twice = F.filter("s", lambda x, i: (F.coalesce(at(F.col("s"), i - 1)["h"] == x["h"], F.lit(False)))
                     | F.coalesce(at(F.col("s"), i + 1)["h"] == x["h"], F.lit(False)))
    d = d.withColumn("p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = _sum(F.transform("p", lambda p, i: F.when(i == 0, F.lit(WINDOW)).otherwise(
        F.least(F.lit(WINDOW), p - at(F.col("p"), i - 1))).cast("long")))
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


def failed(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words", min_words: int = 10,
           max_repeat_percent: int = 20) -> Column:
    return (F.col(n_words) < min_words) | (100 * F.col(n_repeat_words) > max_repeat_percent * F.col(n_words))


def host_rates(measured: DataFrame, max_strength: float = 1e6, min_strength: float = 1.0) -> DataFrame:
    """(host, host_docs, host_failed, host_rate): failure rates shrunk by an empirical beta prior.

    The prior's mean m and strength a + b come from the moments of the hosts'
    raw rates, m (1 - m) / variance - 1, held between ``min_strength`` and
    ``max_strength``; equal rates give the largest strength.
    """
    by_host = measured.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"),
                                           F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    moments = by_host.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    strength = F.coalesce(F.try_divide(F.col("m") * (1 - F.col("m")), F.col("v")) - 1, F.lit(max_strength))
    prior = moments.select(F.struct("m", F.least(F.greatest(strength, F.lit(min_strength)), F.lit(max_strength)).alias("k")).alias("x"))
    out = by_host.withColumn("prior", prior.scalar())
    shrunk = (F.col("host_failed") + F.col("prior.m") * F.col("prior.k")) / (F.col("host_docs") + F.col("prior.k"))
    return out.select("host", "host_docs", "host_failed", shrunk.alias("host_rate"))


def judge(measured: DataFrame, max_host_rate: float = 0.5) -> DataFrame:
    """``measured`` (with base_failed, already written) with host_rate and kept."""
    hosts = host_rates(measured).select(F.col("host").alias("_h"), "host_rate")
    out = measured.join(hosts, measured["host"].eqNullSafe(hosts["_h"]), "left").drop("_h")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate))
