"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Every benchmark item is cut into windows of consecutive words (a shorter item
is one window).  A window occurs in a document when its words stand there in a
row.  For whole containment the necessary prefix of a window, with its
shingles ordered by rarity, is its rarest shingle alone, so:

1. shingles of all documents that occur in any window are counted (a partial
   aggregate before the shuffle); the counts order each window's shingles;
2. the rarest shingle of each window is joined to the documents' shingle
   positions, with the length and positional bounds: the window has to fit
   between the start and the end of the document;
3. the few candidates are joined back to the documents' words and verified
   word by word; hits are merged into covered word counts.

The joins of steps 1 and 2 broadcast the benchmark side only when its counted
rows are within ``broadcast_rows`` (of about 100 bytes each); beyond it the
same joins are shuffled, where adaptive execution splits hot shingles.

Defined cases: null texts have no words; items without words have no windows;
equal windows of several items count for each of them; an item id that occurs
repeatedly counts once; a null item id counts as the empty string; rows of
documents are judged by their text, so repeated rows get equal results; extra
columns are left out by ``hits`` and stay in ``clean``; empty tables give no
hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import alnum_words, count_alnum_words, fresh, written

WINDOW = 13
SHINGLE = 3


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, w): distinct windows of each item as arrays of words."""
    i = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), alnum_words(F.col(text_col)).alias("ws"))
    i = i.where(F.size("ws") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - window + 1, F.lit(1)))
    return i.select("item", F.explode(F.transform(starts, lambda s: F.slice("ws", s, F.lit(window)))).alias("w")).distinct()


def _hash(words: Column, at: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(n)])


def _shingles(words: Column, n: int) -> Column:
    """Hashes of the n-word shingles of ``words``, by position from 0."""
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(0), F.size(words) - n), lambda i: _hash(words, i, n))).otherwise(F.array().cast("array<bigint>"))


def _positions(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(rid, n, k, pos, h): hashed shingles of all documents, for each shingle size in use."""
    d = docs.select("rid", F.size("ws").alias("n"), "ws")
    out = None
    for k in sizes:
        # Sizes under SHINGLE only exist for items of so few words.
        e = d.select("rid", "n", F.lit(k).alias("k"), F.posexplode(_shingles(F.col("ws"), k)).alias("pos", "h"))
        out = e if out is None else out.unionAll(e)
    return out


def _hint(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def _key(id_col: str, text_col: str) -> Column:
    """What equal rows share: the id and the hash of the text."""
    return F.struct(F.col(id_col).cast("string").alias("id"), F.xxhash64(text_col).alias("x"))


def found(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", window: int = WINDOW, shingle: int = SHINGLE, broadcast_rows: int = 200_000) -> DataFrame:
    """(rid, n_words, n_hit, n_items, items_sha256) of the documents with occurrences, as a written table."""
    texts = docs.select(_key(id_col, text_col).alias("rid"), F.col(text_col).alias("text"))
    words = texts.select("rid", alnum_words(F.col("text")).alias("ws"))
    win = item_windows(items, item_col, "text", window)
    wins = win.select("w").distinct().select(
        F.xxhash64("w").alias("wid"), "w", F.least(F.size("w"), F.lit(shingle)).alias("k"), F.size("w").alias("len"))
    wins = written(spark, wins, "windows")
    n_wins = wins.count()
    sizes = sorted(r["k"] for r in wins.select("k").distinct().collect())     # at most ``shingle`` rows
    if not sizes:
        return spark.createDataFrame([], words.select("rid").schema.add("n_words", "long").add("n_hit", "long")
                                     .add("n_items", "long").add("items_sha256", "string"))

    cut = None
    for k in sizes:
        e = wins.where(F.col("k") == k).select("wid", "k", "len", F.posexplode(_shingles(F.col("w"), k)).alias("off", "h"))
        cut = e if cut is None else cut.unionAll(e)
    # Over all documents, how often each shingle of a window occurs; the rarest is the window's prefix.
    known = written(spark, cut.select("k", "h").distinct(), "shingles")
    counts = _positions(words, sizes).join(_hint(known, known.count(), broadcast_rows), ["k", "h"])
    counts = counts.groupBy("k", "h").agg(F.count(F.lit(1)).alias("df"))
    rare = cut.join(counts, ["k", "h"], "left").groupBy("wid", "k", "len").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h", "off")).alias("m"))
    prefix = written(spark, rare.where("m.df > 0").select("wid", "k", "len", "m.h", "m.off"), "prefix")

    start = F.col("pos") - F.col("off")
    at = _positions(words, sizes).join(_hint(prefix, n_wins, broadcast_rows), ["k", "h"])
    at = at.where((start >= 0) & (start + F.col("len") <= F.col("n"))).select("rid", "wid", start.alias("at")).distinct()
    at = written(spark, at, "candidates")

    # Verify on the words themselves; only texts of documents with candidates travel.
    rids = at.select("rid").distinct()
    some = texts.join(_hint(rids, rids.count(), broadcast_rows), "rid", "left_semi").dropDuplicates(["rid"])
    per_doc = at.join(_hint(wins.select("wid", "w"), n_wins, broadcast_rows), "wid").groupBy("rid").agg(
        F.collect_list(F.struct("at", "wid", "w")).alias("cs"))
    v = some.join(per_doc, "rid").select("rid", "cs", alnum_words(F.col("text")).alias("ws"))
    same = F.filter("cs", lambda c: F.slice(F.col("ws"), c["at"] + 1, F.size(c["w"])) == c["w"])
    spans = F.sort_array(F.transform(same, lambda c: F.struct(c["at"].alias("at"), F.size(c["w"]).alias("len"), c["wid"].alias("wid"))))
    v = v.select("rid", F.size("ws").cast("long").alias("n_words"), spans.alias("cs"))
    v = written(spark, v.where(F.size("cs") > 0), "occurrences")
    merged = F.aggregate("cs", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), lambda s, c: F.struct(
        F.greatest(s["end"], c["at"] + c["len"]).alias("end"),
        (s["n"] + F.greatest(F.lit(0), c["at"] + c["len"] - F.greatest(s["end"], c["at"]))).cast("long").alias("n")))
    of = win.select("item", F.xxhash64("w").alias("wid"))
    ids = v.select("rid", F.explode(F.array_distinct(F.transform("cs", lambda c: c["wid"]))).alias("wid")).join(of, "wid")
    ids = ids.select("rid", "item").distinct().groupBy("rid").agg(F.sort_array(F.collect_list("item")).alias("items"))
    r = v.select("rid", "n_words", merged["n"].alias("n_hit")).join(ids, "rid")
    return written(spark, r.select("rid", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                                   F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "found")


def hits(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items and items_sha256."""
    r = found(spark, docs, items, id_col, text_col, **how).drop("n_words")
    base = docs.select(F.col(id_col), _key(id_col, text_col).alias("_r"),
                       count_alnum_words(F.col(text_col)).alias("n_words"))
    none = {"n_hit": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long"), "items_sha256": F.sha2(F.lit(""), 256)}
    out = base.join(r, base["_r"] == r["rid"], "left")
    return out.select(id_col, "n_words", *[F.coalesce(F.col(k), c).alias(k) for k, c in none.items()])


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          broadcast_rows: int = 200_000, **how) -> DataFrame:
    """``docs`` without contaminated rows; same columns."""
    r = found(spark, docs, items, id_col, text_col, broadcast_rows=broadcast_rows, **how)
    bad = written(spark, r.where(contaminated()).select(F.col("rid").alias(fresh("_rid", docs))), "contaminated")
    return docs.join(_hint(bad, bad.count(), broadcast_rows), _key(id_col, text_col) == bad[bad.columns[0]], "left_anti")


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words", one_in: int = 20) -> Column:
    return (F.col(n_hit) > 0) & (one_in * F.col(n_hit) >= F.col(n_words))
