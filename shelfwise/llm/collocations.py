"""Phrase collocation mining: Apriori levels counted by double-array tries.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words ``[^\\x20\\x09]+``; all counts are per
language.  The steps, each a written table:

1. Word counts (added up in each task, then a grouped sum).  Words found less than ``least`` times can't be in a
   frequent phrase; the others get ids, by the order of their 64-bit hashes.
2. The text as ids, 0 where a phrase can't run on (an end of a piece, a rare word).  A dictionary is sent out in parts
   of ``DICTIONARY`` words; a larger one takes a pass for each part.
3. For two, then three words: the phrases of the text all of whose parts are frequent are counted by task and dealt out by
   ranges of their hashes.  Candidates are those whose hash bucket has ``least`` occurrences; buckets only ever add counts,
   so no frequent phrase is lost.  For three words, both pairs must have their bit in a bitmap of the frequent pairs, sent
   to the tasks: where another pair shares a bit, there are candidates more, none less.
4. The candidates of a range are dealt into tries of ``SHARD`` phrases.  Each is a double array: the phrase's ids, in
   bytes, are the path from the root; ``base[state] + byte`` is the next state if its ``check`` is the state.  numpy takes
   the states of all phrases dealt to the range one level further at a time and adds up the counts of the accepting ones.
5. Scores in exact decimals, absorption into longer phrases, and the ranks.

Every broadcast has a bound that doesn't depend on the input (32 MB of words, ``BITS`` bits).

Defined cases: null texts have no words; a null language counts as ``und``; empty texts give nothing; repeated rows count
each time; words are compared by 64-bit hashes in which two frequent ones never meet (else another seed is taken); long
texts are handled by blocks of rows, a single row at least; an empty table gives no row.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.arrowtext import LOWER, blocks, byte_table, hash_spans, mix, release, small_batches, spans
from shelfwise.llm.common import partitions, written

BLOCK = 2 << 20                  # bytes of text that one count of words covers
HELD = 400_000                   # counts of words that a task holds to add them up
DICTIONARY = 1 << 22             # words of one broadcast
SHARD = 250_000                  # phrases of one trie
GROUP = 2                        # tries that a range of hashes needs if no phrase of its texts comes twice
DEAL = 1 << 20                   # occurrences of phrases that are dealt out at a time
BITS = 1 << 28                   # of the bitmap of frequent pairs
BUCKETS = 1 << 20
HEATS = (64, 4, 1)               # parts in which a language's phrases are ranked, round by round

#: The bytes that end a piece, and those that end a word.
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
GAP = BREAK.copy()
GAP[[9, 32]] = True


def _seeds(langs: list[str | None]) -> np.ndarray:
    known = {x: int.from_bytes(hashlib.sha256((x or "und").encode()).digest()[:8], "little") for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def _words(rows: pa.RecordBatch, data: np.ndarray, off: np.ndarray, seed: int):
    """(starts, ends, row, hash, joined): the words of a block; joined: no piece ends before the word."""
    starts, ends, row = spans(data, off, GAP)
    h = mix(hash_spans(data, starts, ends, byte_table(seed, LOWER)) ^ _seeds(rows.column("lang").to_pylist())[row]).view(np.int64)
    piece = np.cumsum(BREAK[data], dtype=np.int32)[starts] if len(starts) else starts
    joined = np.zeros(len(starts), bool)
    joined[1:] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
    return starts, ends, row, h, joined


def _counted(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, c): how often each word stands in a block of texts."""
    def run(batches):
        held, n = [], 0
        for batch in batches:
            for rows, data, off in blocks(batch, "text", BLOCK):
                starts, ends, row, h, _ = _words(rows, data, off, seed)
                if not len(h):
                    continue
                _, at, c = np.unique(h, return_index=True, return_counts=True)
                # Words and the gaps behind them by turns, over the block's own bytes.
                edges = np.stack([starts, ends], 1).ravel().astype(np.int32)
                words = pa.Array.from_buffers(pa.string(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(LOWER[data])])
                langs = pa.array([x or "und" for x in rows.column("lang").to_pylist()], pa.string())
                held.append(pa.table([langs.take(pa.array(row[at])), words.take(pa.array(2 * at)), pa.array(h[at]), pa.array(c.astype(np.int64))], names=names))
                n += len(at)
                if n >= HELD:
                    held, n = [merged(held)], 0
                    if len(held[0]) >= HELD // 2:
                        yield from held.pop().to_batches()
        if held:
            yield from merged(held).to_batches()
        release()

    names = ["lang", "word", "h", "c"]
    merged = lambda held: pa.concat_tables(held).group_by(names[:3], use_threads=False).aggregate([("c", "sum")]).rename_columns(names).combine_chunks()
    return docs.mapInArrow(run, "lang string, word string, h long, c long")


def _vocabulary(spark: SparkSession, counts: DataFrame, least: int) -> DataFrame:
    """(id, lang, word, h, c) of the frequent words, ids from 1 by ascending hash."""
    by_range = counts.where(F.col("c") >= least).repartitionByRange("h").withColumn("part", F.spark_partition_id())
    by_range = written(spark, by_range, "vocabulary")
    sizes = by_range.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()     # a row per partition
    offset = dict(zip([r["part"] for r in sizes], np.cumsum([0, *[r["n"] for r in sizes]]).tolist()))
    place = F.create_map(*[F.lit(x) for kv in offset.items() for x in kv]) if offset else F.create_map()
    row = F.row_number().over(Window.partitionBy("part").orderBy("h"))
    start = F.element_at(place, F.col("part")) if offset else F.lit(0)
    return written(spark, by_range.select((row + start).cast("int").alias("id"), "lang", "word", "h", "c"), "vocabulary")


def _coded(spark: SparkSession, docs: DataFrame, vocabulary: DataFrame, size: int, seed: int) -> DataFrame:
    """(ids): int32 ids of blocks of texts, 0 where no phrase runs on."""
    out = docs.withColumn("ids", F.lit(None).cast("binary"))
    for low in range(0, max(size, 1), DICTIONARY):
        part = vocabulary.where((F.col("id") > low) & (F.col("id") <= low + DICTIONARY)).select("h").toArrow()
        sent = spark.sparkContext.broadcast(np.sort(part.column("h").to_numpy()))
        last = low + DICTIONARY >= size
        out = written(spark, out.mapInArrow(_coder(sent, low, seed, last), "ids binary" if last else "lang string, text string, ids binary"), "ids")
        sent.unpersist()
    return out


def _begins(known: np.ndarray) -> np.ndarray:
    """Where the hashes with the same first bits begin in ``known``, which is in order."""
    k = max(1, len(known).bit_length())
    return np.searchsorted(known, np.arange(-(1 << k - 1), 1 << k - 1) << 64 - k).astype(np.int32)


def _place(known: np.ndarray, begins: np.ndarray, h: np.ndarray) -> np.ndarray:
    """``np.searchsorted(known, h)``, from the places where the first bits begin."""
    at = begins[(h >> 64 - (len(begins).bit_length() - 1)) + len(begins) // 2].astype(np.int64)
    todo = np.flatnonzero(at < len(known))
    while len(todo):
        todo = todo[known[at[todo]] < h[todo]]
        at[todo] += 1
        todo = todo[at[todo] < len(known)]
    return at


def _coder(sent, low: int, seed: int, last: bool):
    def run(batches):
        known = sent.value
        begins = _begins(known)
        for batch in batches:
            for rows, data, off in blocks(batch, "text"):
                starts, _, row, h, joined = _words(rows, data, off, seed)
                at = _place(known, begins, h)
                found = known[np.minimum(at, len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)
                ids = np.where(found, at + low + 1, 0).astype(np.int32)
                place = np.arange(len(ids)) + np.cumsum(~joined)          # a 0 before each word that begins a piece
                flat = np.zeros(place[-1] + 1 if len(place) else 0, np.int32)
                flat[place] = ids
                if last and rows.column("ids").null_count == len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary())], names=["ids"])
                    continue
                per_row = np.concatenate([[0], np.cumsum(np.bincount(row, 1 + ~joined, rows.num_rows))]).astype(np.int64)
                own = [flat[a:b] for a, b in zip(per_row, per_row[1:])]
                own = [x if old is None else x | np.frombuffer(old, np.int32) for x, old in zip(own, rows.column("ids").to_pylist())]
                ids = pa.array([x.tobytes() for x in own], pa.binary())
                yield (pa.RecordBatch.from_arrays([ids], names=["ids"]) if last else
                       pa.RecordBatch.from_arrays([rows.column("lang"), rows.column("text"), ids], names=["lang", "text", "ids"]))
        release()

    return run


def _unique(words: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of ``words`` in order, and the sums of their counts (1 each without)."""
    bits = int(words.max()).bit_length() if words.size else 1
    if counts is None and bits * words.shape[1] <= 63:              # a row as one number
        key = reduce(lambda k, col: k << bits | col, words.T.astype(np.int64))
        key, counts = np.unique(key, return_counts=True)
        shifts = bits * np.arange(words.shape[1] - 1, -1, -1)
        return (key[:, None] >> shifts & (1 << bits) - 1).astype(words.dtype), counts
    order = np.lexsort(words.T[::-1])
    words = words[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]).any(1)
    first = np.flatnonzero(new)
    counts = np.ones(len(words), np.int64) if counts is None else counts[order]
    return words[first], np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)


def _hash(words: np.ndarray) -> np.ndarray:
    h = np.zeros(len(words), np.uint64)
    for col in words.T:
        h = mix(h + col.astype(np.uint64) + np.uint64(1))
    return h


def _frequent(spark: SparkSession, occurrences, coded: DataFrame, length: int, ranges: int, digits: int, least: int) -> DataFrame:
    """(words, n, f): a pack for each range of hashes, of its phrases with ``least`` occurrences and their counts.

    ``occurrences`` gives those of a row of ids.  Each goes to its range once, so the work grows with the text, however
    many tries there are."""
    def dealt_out(found):
        words, counts = _unique(np.concatenate(found))
        at = _range(_hash(words), ranges)
        order = np.argsort(at, kind="stable")
        words, counts, at = words[order], counts[order].astype(np.int32), at[order]
        cuts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)]])
        return pa.RecordBatch.from_arrays([pa.array(at[cuts[:-1]].astype(np.int64)), _pieces(words, 4 * length * cuts), _pieces(counts, 4 * cuts)],
                                          names=["range", "words", "counts"])

    def deal(batches):
        found, n = [], 0
        for batch in batches:
            for blob in batch.column("ids").to_pylist():
                own = occurrences(np.frombuffer(blob, np.int32))
                if len(own):
                    found.append(own)
                    n += len(own)
                if n >= DEAL:
                    yield dealt_out(found)
                    found, n = [], 0
        if n:
            yield dealt_out(found)
        release()

    def count(table):
        words = np.frombuffer(b"".join(table.column("words").to_pylist()), np.int32).reshape(-1, length)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int32)
        bucket = (_hash(words) % np.uint64(BUCKETS)).astype(np.int64)
        held = (np.bincount(bucket, counts, BUCKETS) >= least)[bucket]
        words, counts = words[held], counts[held]
        candidates, _ = _unique(words)
        flat, starts = words.ravel(), np.arange(0, words.size, length)
        f = np.zeros(len(candidates), np.int64)
        for low in range(0, len(candidates), SHARD):
            own = candidates[low: low + SHARD]
            base, check = double_array(own, digits)
            at, phrase = advance(flat, base, check, length, digits, starts)
            f[low: low + SHARD] = np.bincount(phrase, counts[at // length], len(own))
        kept = f >= least
        blobs = [x.tobytes() for x in (candidates[kept], f[kept])]
        n = int(kept.sum())
        release()
        return pa.table({"words": pa.array(blobs[:1] if n else [], pa.binary()), "n": pa.array([n] if n else [], pa.int64()),
                         "f": pa.array(blobs[1:] if n else [], pa.binary())})

    dealt = coded.mapInArrow(deal, "range long, words binary, counts binary")
    return written(spark, dealt.groupBy("range").applyInArrow(count, "words binary, n long, f binary"), f"frequent{length}")


def _range(h: np.ndarray, ranges: int) -> np.ndarray:
    return (h >> np.uint64(32)) % np.uint64(ranges)


def _pieces(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of ``values`` between the cuts."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _places(words: np.ndarray, ranges: int, size: int) -> np.ndarray:
    """The bit of each phrase: its range has ``size`` of them."""
    h = _hash(words)
    return (_range(h, ranges) * np.uint64(size) + h % np.uint64(size)).astype(np.int64)


def _bitmap(packs: DataFrame, length: int, ranges: int) -> tuple[np.ndarray, int]:
    """A bitmap in which the bit of each phrase of the packs is set, and its bits a range (``BITS`` or fewer in all)."""
    n = packs.agg(F.sum("n")).first()[0] or 0
    size = 8 * max(1, min(BITS, 16 * n) // ranges // 8)

    def run(batches):
        for batch in batches:
            for blob in batch.column("words").to_pylist():
                at = _places(np.frombuffer(blob, np.int32).reshape(-1, length), ranges, size)
                own = np.zeros(size, bool)
                own[at % size] = True
                yield pa.RecordBatch.from_arrays([pa.array([int(at[0] // size)], pa.int64()), pa.array([np.packbits(own).tobytes()], pa.binary())], names=["range", "bits"])

    bits = np.zeros((ranges, size // 8), np.uint8)
    for batch in packs.select("words").mapInArrow(run, "range long, bits binary").toArrow().to_batches():
        for at, own in zip(batch.column("range").to_pylist(), batch.column("bits")):
            bits[at] |= np.frombuffer(own.as_buffer(), np.uint8)
    return bits.ravel(), size


def double_array(words: np.ndarray, digits: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(base, check) of the trie of distinct sorted phrases; a phrase's last state has its index as base.

    The path of a phrase are the ``digits`` bytes of each of its ids.  Level by level, the states with most children
    come first; all states of a kind try random places at once, and those whose places are free and wanted by no
    state before them stay.
    """
    n = len(words)
    path = np.concatenate([(words >> 8 * (digits - 1 - d) & 255)[:, :, None] for d in range(digits)], 2).reshape(n, -1).astype(np.int64)
    differ = np.zeros(n, np.int64)
    if n > 1:
        differ[1:] = np.argmax(path[1:] != path[:-1], 1)            # the first level at which a phrase leaves the one before
    rng = np.random.default_rng(seed)
    base, check = np.zeros(1024, np.int32), np.full(1024, -1, np.int32)
    check[0] = -2                                                   # the root's place
    state = np.zeros(n, np.int64)                                   # of each phrase's prefix so far
    for level in range(path.shape[1]):
        new = differ <= level                                       # one phrase for each edge of this level
        first = np.flatnonzero(new)
        parent, byte = state[first], path[first, level]
        node = np.concatenate([[0], np.cumsum(parent[1:] != parent[:-1])]) if len(first) else first
        sizes = np.bincount(node)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        todo = np.argsort(-sizes, kind="stable")
        # Room: crowded states get 256 places of their own, the others share twice as many places as they need.
        crowded = todo[sizes[todo] >= 32]
        rest = todo[len(crowded):]
        start = len(base)
        room = 256 * len(crowded) + 2 * int(sizes[rest].sum()) + 512
        base = np.concatenate([base, np.zeros(room, np.int32)])
        check = np.concatenate([check, np.full(room, -1, np.int32)])
        chosen = np.zeros(len(sizes), np.int64)
        chosen[crowded] = start + 256 * np.arange(len(crowded))
        taken = np.zeros(len(base), bool)
        taken[(chosen[node] + byte)[sizes[node] >= 32]] = True
        tries = 0
        while len(rest):
            tries += 1
            if tries > 200:                                         # more room for what doesn't fit
                extra = 256 * len(rest)
                chosen[rest] = len(base) + 256 * np.arange(len(rest))
                base = np.concatenate([base, np.zeros(extra, np.int32)])
                check = np.concatenate([check, np.full(extra, -1, np.int32)])
                break
            want = rng.integers(start, len(base) - 255, len(rest))
            k = sizes[rest]
            own = np.repeat(np.arange(len(rest)), k)
            edge = np.repeat(begins[rest], k) + np.arange(len(own)) - np.repeat(np.cumsum(k) - k, k)
            place = want[own] + byte[edge]
            free = ~taken[place]
            firsts = np.zeros(len(place), bool)
            firsts[np.unique(place, return_index=True)[1]] = True
            bad = np.zeros(len(rest), bool)
            bad[own[~(free & firsts)]] = True
            chosen[rest[~bad]] = want[~bad]
            taken[place[~bad[own]]] = True
            rest = rest[bad]
        base[parent] = chosen[node]
        places = chosen[node] + byte
        check[places] = parent
        state = places[np.cumsum(new) - 1]
    base[state] = np.arange(n)
    return base, check


def advance(ids: np.ndarray, base: np.ndarray, check: np.ndarray, length: int, digits: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(positions, phrase indexes) of all occurrences of the trie's phrases in ``ids``, or of those that begin at ``at``."""
    if at is None:
        at = np.flatnonzero(ids[:max(len(ids) - length + 1, 0)])
    state = np.zeros(len(at), np.int32)
    for word in range(length):
        here = ids[at + word]
        live = here > 0
        at, state, here = at[live], state[live], here[live]
        for d in range(digits):
            to = base[state] + (here >> 8 * (digits - 1 - d) & 255)
            live = check[to] == state
            at, state, here = at[live], to[live], here[live]
    return at, base[state]


def _pairs(ids: np.ndarray) -> np.ndarray:
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    return np.stack([ids[at], ids[at + 1]], 1)


def _triples(sent, ranges: int, size: int):
    """Occurrences of three words both pairs of which have their bit in the sent bitmap."""
    def run(ids):
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        place = _places(np.stack([ids[at], ids[at + 1]], 1), ranges, size)
        flag = np.zeros(len(ids), bool)
        flag[at] = sent.value[place >> 3] >> (7 - (place & 7)) & 1
        at = np.flatnonzero(flag[:-1] & flag[1:])
        return np.stack([ids[at], ids[at + 1], ids[at + 2]], 1)

    return run


def _rows(packs: DataFrame, length: int) -> DataFrame:
    """(w1, w2[, w3], f): a row for each phrase of the packs."""
    names = [f"w{k + 1}" for k in range(length)]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words = np.frombuffer(row["words"], np.int32).reshape(-1, length)
                yield pa.RecordBatch.from_arrays([*[pa.array(np.ascontiguousarray(words[:, k])) for k in range(length)], pa.array(np.frombuffer(row["f"], np.int64))], names=[*names, "f"])

    return packs.mapInArrow(run, ", ".join(f"{n} int" for n in names) + ", f long")


def _score(a: str, left: str, right: str):
    """floor(1000000 * a * a / (left * right)), in decimals of 38 digits."""
    return F.expr(f"(cast({a} as decimal(16,0)) * cast({a} as decimal(16,0)) * 1000000) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def mine(spark: SparkSession, docs: DataFrame, least: int = 10, top: int = 2000, absorb: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two or three words.

    A phrase is left out if a longer candidate holds it with at least ``absorb`` percent of its occurrences.
    """
    small_batches(spark, 2048)
    docs = docs.select("lang", "text")
    for seed in range(11, 20):
        counts = written(spark, _counted(docs, seed).groupBy("lang", "word", "h").agg(F.sum("c").alias("c")), "words")
        vocabulary = _vocabulary(spark, counts, least)
        size, distinct = vocabulary.agg(F.count(F.lit(1)), F.count_distinct("h")).first()
        if size == distinct:                                        # else two frequent words share a hash
            break
    totals = counts.groupBy("lang").agg(F.sum("c").alias("n"))
    n_words = counts.agg(F.sum("c")).first()[0] or 0
    ranges = max(partitions(spark), -(-n_words // (GROUP * SHARD)))
    digits = max(1, -(-int(size).bit_length() // 8))
    coded = _coded(spark, docs, vocabulary, size, seed)

    pairs = _frequent(spark, _pairs, coded, 2, ranges, digits, least)
    bits, size = _bitmap(pairs, 2, ranges)
    sent = spark.sparkContext.broadcast(bits)
    del bits
    triples = _frequent(spark, _triples(sent, ranges, size), coded, 3, ranges, digits, least)
    sent.unpersist()
    return _ranked(_rows(pairs, 2), _rows(triples, 3), vocabulary, totals, top, absorb)


def _ranked(two: DataFrame, three: DataFrame, vocabulary: DataFrame, totals: DataFrame, top: int, absorb: int) -> DataFrame:
    word = lambda k: vocabulary.select(F.col("id").alias(f"w{k}"), F.col("lang").alias(f"lang{k}"), F.col("word").alias(f"x{k}"), F.col("c").alias(f"c{k}"))
    longer = (three.select("w1", "w2", "f").unionAll(three.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "f"))
              .groupBy("w1", "w2").agg(F.max("f").alias("longer")))
    pairs = (two.join(longer, ["w1", "w2"], "left").where(f"coalesce(100 * longer < {absorb} * f, true)")
             .join(word(1), "w1").join(word(2), "w2")
             .select(F.col("lang1").alias("lang"), F.concat_ws(" ", "x1", "x2").alias("phrase"), F.col("f").alias("a"),
                     F.col("c1").alias("l"), F.col("c2").alias("r"), _score("f", "c1", "c2").alias("score")))
    front, back = [two.select(F.col("w1").alias(a), F.col("w2").alias(b), F.col("f").alias(f)) for a, b, f in (("w1", "w2", "f12"), ("w2", "w3", "f23"))]
    cuts = (three.join(front, ["w1", "w2"]).join(back, ["w2", "w3"]).join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
            .withColumns({"s1": _score("f", "c1", "f23"), "s2": _score("f", "f12", "c3")}))
    triples = cuts.select(F.col("lang1").alias("lang"), F.concat_ws(" ", "x1", "x2", "x3").alias("phrase"), F.col("f").alias("a"),
                          F.expr("if(s1 <= s2, c1, f12)").alias("l"), F.expr("if(s1 <= s2, f23, c3)").alias("r"), F.least("s1", "s2").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    best = pairs.unionAll(triples)
    for parts in HEATS:                                             # no task sorts more than 16 * top rows after the first round
        heat = F.pmod(F.xxhash64("phrase"), F.lit(parts))
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", heat).orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
