"""Word n-gram scoring by Katz backoff, of order 2 by packed ranges, of any other order by recursive tables.

Counts are discounted by Good-Turing (counts up to ``K``), and what the
discounts free goes to the next lower order with weights that make every
distribution sum to exactly one:

    P(w | h) = d(c(h,w)) c(h,w) / (c(h) + 1)    where c(h,w) > 0
             = alpha(h) P(w)                    where c(h) > 0 only
             = P(w)                             for contexts never seen
    P(w)     = d1(c(w)) c(w) / (N + 1)          where c(w) > 0
             = what is left                     for all unknown words, as one

One count of every context is reserved (the + 1), so contexts without small
counts back off too.  A text is its words and one end; the first word's
context is the start of the text.

Other orders.  ``order`` words make an n-gram, and P(w | h) backs off to
P(w | h without its first word), down to the words; contexts before the start
of a text are filled with it.  ``recursive`` counts the n-grams of all
documents once, sums them to the lower orders, and makes the written table of
each order (n-gram, count, probability) from that of the next lower one: an
aggregate for the weights of the contexts and two joins, none of them by
single tokens.

Jobs of order 2.  Words are 64-bit hashes.  The unigram table is counted first, in
ranges of words.  Then tasks pack their bigrams (with the documents they stand
in) by the range of the context, and this exchange is read twice in one plan:
once for the counts of counts and for the words whose unigram counts a range
needs (requests go to the unigram ranges, answers come back), and once to
build the range of the model and to score its tokens.  The result is written
as a table partitioned by kind: ``model`` holds a row of packed contexts,
followers, counts and backoff weights for each range, ``score`` the sums of
each range for the documents of each pack, which are added up at last.

Contexts with more than a quarter of a range's share of the tokens are hot;
their number is below four times the ranges, so their list has a proven bound.
Their bigrams are dealt by both words, and their backoff weights are gathered
from all ranges at the end, where documents wait for them with a count.  A
document sends a bigram once, with its number.

Defined cases: a null or empty text is an end only; documents with a null id
are learned from; repeated rows are documents of their own; without training
documents every word is unknown and the model gives log10 1 = 0; too few
counts for Good-Turing use fewer discounted counts or an absolute discount.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.arrowtext import LOWER, SPACE, blocks, byte_table, hash_spans, mix, release, small_batches, spans
from shelfwise.llm.common import partitions, written
from shelfwise.session import app_id, shared_dir

K = 5
_U = np.uint64
_TABLE = byte_table(61, LOWER)
START, END = (int(x) for x in mix(np.array([0x53544152, 0x454E44], np.uint64)))


def planes(a: np.ndarray, width: int) -> bytes:
    """Non-negative integers as ``width`` planes of bytes; the higher planes compress well."""
    return np.ascontiguousarray(a.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(raw: bytes, width: int) -> np.ndarray:
    p = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((p.shape[1], 8), np.uint8)
    out[:, :width] = p.T
    return out.reshape(-1).view(np.uint64)


def range_of(h: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges of hashes; ascending with the hash."""
    return (((h >> _U(32)) * _U(n)) >> _U(32)).astype(np.int64)


def discounts(n: list[int]) -> np.ndarray:
    """d(0..K) from the counts of counts n[1..K+1]; larger counts keep all of theirs."""
    for k in range(K, 0, -1):
        if min(n[1: k + 2]) <= 0:
            continue
        a = (k + 1) * n[k + 1] / n[1]
        if a >= 1:
            continue
        d = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)]
        if all(0 < x <= 1 for x in d):
            return np.array([0.0, *d, *[1.0] * (K - k)])
    off = min(0.9, n[1] / (n[1] + 2 * n[2])) if n[1] else 0.5
    return np.array([0.0, *[(r - off) / r for r in range(1, K + 1)]])


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(c <= K, d[np.minimum(c, K)], 1.0) * c


@dataclass
class Unigrams:
    """What all ranges know of the unigrams: totals, discounts, the mass of unknown words, hot contexts."""
    tokens: int
    types: int
    ends: int
    d: np.ndarray
    unknown: float
    hot: np.ndarray              # sorted hashes
    hot_count: np.ndarray

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, self.d) / (self.tokens + 1), self.unknown)

    def is_hot(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hot):
            return np.zeros(len(w), bool), np.zeros(len(w), np.int64)
        at = np.searchsorted(self.hot, w)
        at[at == len(self.hot)] = 0
        return self.hot[at] == w, self.hot_count[at]


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, word, row) of every token of a block, the ends included."""
    starts, ends, row = spans(data, off, SPACE)
    w = hash_spans(data, starts, ends, _TABLE)
    n = np.bincount(row, minlength=len(off) - 1) + 1
    last = np.cumsum(n) - 1
    word = np.empty(int(n.sum()), np.uint64)
    inner = np.ones(len(word), bool)
    inner[last] = False
    word[inner] = w
    word[last] = END
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[last - n + 1] = START
    return context, word, np.repeat(np.arange(len(n)), n)


def count_unigrams(spark: SparkSession, docs: DataFrame, ranges: int, flush: int = 1_000_000) -> tuple[DataFrame, Unigrams]:
    """The table (part, words, counts) of the training documents, a row for each range, and what is known of all."""
    def send(batches):
        held, n = [], 0

        def out():
            w, c = np.unique(np.concatenate(held), return_counts=True)
            cut = np.searchsorted(range_of(w, ranges), np.arange(ranges + 1))
            used = [i for i in range(ranges) if cut[i + 1] > cut[i]]
            part = [slice(cut[i], cut[i + 1]) for i in used]
            return pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([planes(w[s], 8) for s in part], pa.binary()),
                 pa.array([planes(c[s], 5) for s in part], pa.binary())], names=["part", "words", "counts"])

        for batch in batches:
            for rows, data, off in blocks(batch, "text"):
                train = rows.column("train").to_numpy(zero_copy_only=False)
                _, w, row = tokens(data, off)
                w = w[train[row]]
                held.append(w)
                n += len(w)
                if n >= flush:
                    yield out()
                    held, n = [], 0
                    release()
        if n:
            yield out()
        release()

    def add(key, pdf):
        w = np.concatenate([unplanes(x, 8) for x in pdf["words"]])
        c = np.concatenate([unplanes(x, 5) for x in pdf["counts"]]).astype(np.int64)
        w, at = np.unique(w, return_inverse=True)
        return pd.DataFrame({"part": [key[0]], "words": [planes(w, 8)], "counts": [planes(_sums(at, c, len(w)), 5)]})

    packs = docs.select("text", "train").mapInArrow(send, "part int, words binary, counts binary")
    table = written(spark, packs.groupBy("part").applyInPandas(add, "part int, words binary, counts binary"), "unigrams")

    def stats(limit: int | None):
        def run(batches):
            n = np.zeros(K + 2, np.int64)
            total = types = ends = 0
            hot, hot_n = [], []
            for batch in batches:
                for words, counts in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist()):
                    w, c = unplanes(words, 8), unplanes(counts, 5).astype(np.int64)
                    n += np.bincount(np.minimum(c, K + 2), minlength=K + 3)[: K + 2]
                    total, types = total + int(c.sum()), types + len(c)
                    ends += int(c[w == END].sum())
                    if limit is not None:
                        often = (c > limit) & (w != END)
                        hot += w[often].astype(np.int64).tolist()
                        hot_n += c[often].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([n.tolist()], pa.list_(pa.int64())), pa.array([total]), pa.array([types]), pa.array([ends]),
                 pa.array([hot], pa.list_(pa.int64())), pa.array([hot_n], pa.list_(pa.int64()))],
                names=["n", "total", "types", "ends", "hot", "hot_n"])
        return table.mapInArrow(run, "n array<long>, total long, types long, ends long, hot array<long>, hot_n array<long>")

    rows = stats(None).collect()                    # a few numbers for each task
    n = np.sum([r["n"] for r in rows], axis=0).tolist() if rows else [0] * (K + 2)
    total, types, ends = (sum(r[k] for r in rows) for k in ("total", "types", "ends"))
    limit = max(1, total // (4 * ranges))
    hot = [(int(np.int64(w).view(np.uint64)), c) for r in stats(limit).collect() for w, c in zip(r["hot"], r["hot_n"])]     # under 4 * ranges words
    if ends > limit:
        hot.append((START, ends))
    hot.sort()
    d = discounts(n)
    # The mass of counts up to K from the counts of counts; larger counts keep theirs.
    small = sum(r * n[r] for r in range(1, K + 1))
    seen = sum(d[r] * r * n[r] for r in range(1, K + 1)) + (total - small)
    u = Unigrams(total, types, ends, d, 1 - seen / (total + 1), np.array([h for h, _ in hot], np.uint64), np.array([c for _, c in hot], np.int64))
    return table, u


def _sums(which: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    np.add.at(out, which, n)
    return out


_PACK = "part int, base long, words binary, w1 binary, w2 binary, runs binary, docs binary, times binary, train binary"


def _bigram_packs(docs: DataFrame, shared, ranges: int, flush: int) -> DataFrame:
    """Bigrams of all documents by the range of their context, a row for each range and some million tokens.

    ``words`` are the distinct words of a row, ``w1`` and ``w2`` the distinct
    bigrams as places in it, ``runs`` the number of documents of each bigram,
    ``docs`` and ``times`` these documents (counted from ``base``) and how often
    each holds it; ``train`` has a bit for each document.  A row without words
    holds the documents themselves: their ids, which are null, and lengths.
    """
    def send(batches):
        u = shared.value
        task = TaskContext.get().partitionId()
        seq, held, n, n_docs, trains, ids, sizes = 0, [], 0, 0, [], [], []

        def out():
            a, b, d = (np.concatenate(x) for x in zip(*held))
            held.clear()
            words, code = np.unique(np.concatenate([a, b]), return_inverse=True)
            key = (code[: len(a)].astype(np.uint64) << _U(24)) | code[len(a):].astype(np.uint64)
            del code
            hot, _ = u.is_hot(a)
            key |= range_of(np.where(hot, mix(a ^ (b * _U(3))), a), ranges).astype(np.uint64) << _U(48)
            del a, b, hot
            o = np.argsort(key, kind="stable")
            key, d = key[o], d[o]
            del o
            new_pair = np.concatenate([[True], key[1:] != key[:-1]])
            new_post = new_pair | np.concatenate([[True], d[1:] != d[:-1]])
            at = np.flatnonzero(new_post)
            times = np.diff(np.append(at, len(key)))
            key, d, new_pair = key[at], d[at], new_pair[at]
            first = np.flatnonzero(new_pair)
            runs, key = np.diff(np.append(first, len(d))), key[first]
            part = (key >> _U(48)).astype(np.int64)
            cut = np.searchsorted(part, np.arange(ranges + 1))
            posts = np.append(first, len(d))
            train = np.packbits(np.array(trains, bool)).tobytes()
            base = (task << 40) + (seq << 20)
            rows = {k: [] for k in ("part", "words", "w1", "w2", "runs", "docs", "times")}
            for p in range(ranges):
                i, j = cut[p], cut[p + 1]
                if i == j:
                    continue
                k1, k2 = (key[i:j] >> _U(24)) & _U((1 << 24) - 1), key[i:j] & _U((1 << 24) - 1)
                local, both = np.unique(np.concatenate([k1, k2]), return_inverse=True)
                s = slice(posts[i], posts[j])
                for name, x in (("part", p), ("words", planes(words[local.astype(np.int64)], 8)), ("w1", planes(both[: j - i], 3)), ("w2", planes(both[j - i:], 3)),
                                ("runs", planes(runs[i:j], 3)), ("docs", planes(d[s], 3)), ("times", planes(times[s], 4))):
                    rows[name].append(x)
            # The documents themselves go to a range by their place.
            rows["part"].append(int((task * 7919 + seq) % ranges))
            for name, x in (("words", b""), ("w1", b""), ("w2", b""), ("runs", np.array([x is None for x in ids]).tobytes()),
                            ("docs", np.array([0 if x is None else x for x in ids], np.int64).tobytes()), ("times", np.array(sizes, np.int64).tobytes())):
                rows[name].append(x)
            m = len(rows["part"])
            return pa.RecordBatch.from_arrays(
                [pa.array(rows["part"], pa.int32()), pa.array([base] * m, pa.int64()), *(pa.array(rows[c], pa.binary()) for c in ("words", "w1", "w2", "runs", "docs", "times")),
                 pa.array([train] * m, pa.binary())], names=[x.split()[0] for x in _PACK.split(", ")])

        for batch in batches:
            for rows, data, off in blocks(batch, "text"):
                a, b, row = tokens(data, off)
                held.append((a, b, (row + n_docs).astype(np.int64)))
                trains += rows.column("train").to_pylist()
                ids += rows.column("id").to_pylist()
                sizes += np.bincount(row, minlength=rows.num_rows).tolist()
                n, n_docs = n + len(a), n_docs + rows.num_rows
                if n >= flush or n_docs >= 1 << 17:
                    yield out()
                    seq, held, n, n_docs, trains, ids, sizes = seq + 1, [], 0, 0, [], [], []
                    release()
        if n_docs:
            yield out()
        release()

    return docs.mapInArrow(send, _PACK)


class _Range:
    """The bigrams of one range, from its packs: distinct pairs with their training counts.

    Documents of a pack are only unpacked while it is looked at.
    """

    def __init__(self, pdf: pd.DataFrame):
        release()
        self.docs = [r for r in pdf.itertuples() if not r.words]
        self.packs = [r for r in pdf.itertuples() if r.words]
        words, w1, w2, counts = [], [], [], []
        for r in self.packs:
            own = unplanes(r.words, 8)
            a, b = (own[unplanes(x, 3).astype(np.int32)] for x in (r.w1, r.w2))
            pair, doc, times = self.posts(r)
            train = np.unpackbits(np.frombuffer(r.train, np.uint8)).astype(bool)
            w1.append(a)
            w2.append(b)
            counts.append(np.bincount(pair, weights=times * train[doc], minlength=len(a)).astype(np.int64))
        none = np.zeros(0, np.uint64)
        self.contexts, i1 = np.unique(np.concatenate(w1) if w1 else none, return_inverse=True)
        i1 = i1.astype(np.int64) << 32
        del w1
        self.words, i2 = np.unique(np.concatenate(w2) if w2 else none, return_inverse=True)
        del w2, words
        # Pairs are told apart by both words.
        i1 |= i2
        del i2
        key, at = np.unique(i1, return_inverse=True)
        del i1
        self.c = _sums(at, np.concatenate(counts) if counts else np.zeros(0, np.int64), len(key))
        ends = np.cumsum([len(x) for x in counts])
        self.pairs = np.split(at.astype(np.int32), ends[:-1]) if counts else []
        self.i1, self.i2 = (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32)

    @staticmethod
    def posts(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, document, times) of a pack."""
        runs, doc, times = (unplanes(x, k).astype(np.int32) for x, k in ((r.runs, 3), (r.docs, 3), (r.times, 4)))
        return np.repeat(np.arange(len(runs), dtype=np.int32), runs), doc, times


def _ask(ranges: int):
    def run(key, pdf):
        r = _Range(pdf)
        n = np.bincount(np.minimum(r.c, K + 2), minlength=K + 3)[: K + 2]
        to = range_of(r.words, ranges)
        cut = np.searchsorted(to, np.arange(ranges + 1))
        used = [i for i in range(ranges) if cut[i + 1] > cut[i]]
        return pd.DataFrame({"to": [-1, *used], "part": key[0], "words": [n.astype(np.int64).tobytes(), *(planes(r.words[cut[i]: cut[i + 1]], 8) for i in used)]})
    return run


def _answer(ranges: int):
    def run(key, asked, known):
        if key[0] < 0:            # counts of counts: their sum goes to every range
            n = sum(np.frombuffer(x, np.int64) for x in asked["words"])
            return pd.DataFrame({"part": np.arange(ranges), "to": -1, "counts": [n.tobytes()] * ranges})
        w = np.concatenate([unplanes(x, 8) for x in known["words"]]) if len(known) else np.zeros(0, np.uint64)
        c = np.concatenate([unplanes(x, 5) for x in known["counts"]]) if len(known) else w
        out = []
        for x in asked["words"]:
            q = unplanes(x, 8)
            at = np.searchsorted(w, q)
            at[at == len(w)] = 0
            out.append(planes(np.where(w[at] == q, c[at], 0) if len(w) else np.zeros(len(q), np.uint64), 5))
        return pd.DataFrame({"part": asked["part"].to_numpy(), "to": key[0], "counts": out})
    return run


_OUT = "kind string, part int, base long, rid long, word long, x double, y double, n long, " + ", ".join(f"b{i} binary" for i in range(6))
_OUT_NAMES = [x.split()[0] for x in _OUT.split(", ")]


def _frame(kind: str, **columns) -> pd.DataFrame:
    return pd.DataFrame({"kind": kind, **columns})


def _score(shared):
    def run(key, packs, answers):
        u, none = shared.value, np.zeros(0, np.uint64)
        r = _Range(packs)
        answers = answers.sort_values("to")
        n = np.frombuffer(answers["counts"].iloc[0], np.int64).tolist()
        d = discounts(n)
        got = [unplanes(x, 5) for x in answers["counts"].iloc[1:]]
        p2 = u.p((np.concatenate(got) if got else none).astype(np.int64))
        m = len(r.contexts)
        c1 = _sums(r.i1, r.c, m)
        hot, hot_count = u.is_hot(r.contexts)
        c1 = np.where(hot, hot_count, c1)
        seen = r.c > 0
        kept = np.bincount(r.i1[seen], weights=discounted(r.c[seen], d), minlength=m)
        low = np.bincount(r.i1[seen], weights=p2[r.i2[seen]], minlength=m)
        alpha = np.where(c1 > 0, (1 - kept / (c1 + 1)) / (1 - low), 1.0)
        alpha[hot] = 1.0                                   # added at the end
        with np.errstate(divide="ignore"):
            score = np.where(seen, np.log10(discounted(r.c, d) / (c1[r.i1] + 1)), np.log10(alpha[r.i1]) + np.log10(p2[r.i2]))
        first = r.contexts[r.i1] == START
        base = np.where(first, 0.0, np.log10((c1[r.i1] + 1) / (u.tokens + u.types + 1)))
        known = np.where(first, 0, c1[r.i1] > 0)
        waits = hot[r.i1] & ~seen
        out = []
        for pack, which in zip(r.packs, r.pairs):
            pair, doc, times = r.posts(pack)
            pair = which[pair]
            # The sums of the pack's documents that the range has bigrams of.
            here, to = np.unique(doc, return_inverse=True)
            add = lambda z: np.bincount(to, weights=z[pair] * times, minlength=len(here))
            out.append(_frame("score", base=[pack.base], b0=[add(base).tobytes()], b1=[add(score).tobytes()],
                              b2=[planes(add(known).astype(np.int64), 4)], b3=[planes(here, 3)]))
            del to
            late = waits[pair]
            if late.any():
                k, to = np.unique((doc[late].astype(np.int64) << 32) | r.i1[pair[late]], return_inverse=True)
                out.append(_frame("waits", base=pack.base, rid=k >> 32, word=r.contexts[k & 0xFFFFFFFF].view(np.int64), n=_sums(to, times[late], len(k))))
        for z in r.docs:
            out.append(_frame("docs", base=[z.base], b0=[z.docs], b1=[z.runs], b2=[z.times], b3=[z.train]))
        h = np.flatnonzero(hot)
        if len(h):
            out.append(_frame("hot", word=r.contexts[h].view(np.int64), x=kept[h], y=low[h], n=c1[h]))
        out.append(_frame("model", b0=[planes(r.contexts, 8)], b1=[planes(np.bincount(r.i1[seen], minlength=m), 4)], b2=[planes(r.words, 8)],
                          b3=[planes(r.i2[seen], 4)], b4=[planes(r.c[seen], 5)], b5=[alpha.astype("<f8").tobytes()]))
        res = pd.concat(out, ignore_index=True).reindex(columns=_OUT_NAMES)
        res["part"] = key[0]
        for c in ("base", "rid", "word", "n"):
            res[c] = res[c].astype("Int64")
        return res
    return run


def score(spark: SparkSession, docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
          flush: int = 1_000_000, per_range: int = 1_500_000, order: int = 2) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    ``held_out`` is a boolean column over ``docs``: rows not to learn from
    (null: learned from).  Tasks pack ``flush`` tokens at a time, and a range
    holds about ``per_range`` training tokens.  ``order`` is the number of
    words of an n-gram; what is not 2 goes by ``recursive``.
    """
    small_batches(spark)
    ranges = min(partitions(spark), 1 << 15)          # of words; those of contexts hold some million tokens each
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.coalesce(~held_out, F.lit(True)).alias("train"))
    if order != 2:
        return recursive(spark, d, order)
    unigrams, u = count_unigrams(spark, d, ranges, flush)
    shared = spark.sparkContext.broadcast(u)
    parts = min(max(ranges, -(-u.tokens // per_range)), 1 << 15)
    packs = _bigram_packs(d, shared, parts, flush).repartition(parts, "part")
    asked = packs.groupBy("part").applyInPandas(_ask(ranges), "to int, part int, words binary")
    known = unigrams.select(F.col("part").alias("to"), "words", "counts")
    answers = asked.groupBy("to").cogroup(known.groupBy("to")).applyInPandas(_answer(parts), "part int, to int, counts binary")
    out = packs.groupBy("part").cogroup(answers.groupBy("part")).applyInPandas(_score(shared), _OUT)

    path = shared_dir(spark, "llm", app_id(spark), f"katz-{uuid.uuid4().hex[:12]}")
    out.write.partitionBy("kind").parquet(path)
    t = spark.read.schema(out.schema).parquet(path)
    # Backoff weights of the hot contexts, from the sums of all ranges.
    hot = t.where("kind = 'hot'").groupBy("word").agg(F.sum("x").alias("kept"), F.sum("y").alias("low"), F.max("n").alias("c"))
    hot = hot.select("word", F.log10((1 - F.col("kept") / (F.col("c") + 1)) / (1 - F.col("low"))).alias("a"))
    late = t.where("kind = 'waits'").join(F.broadcast(hot), "word").groupBy("base", "rid").agg(      # under 4 * ranges words
        F.sum(F.col("a") * F.col("n")).alias("x"))
    rows = t.where("kind IN ('score', 'docs')").select("kind", "base", F.lit(None).cast("long").alias("rid"), F.lit(None).cast("double").alias("x"), "b0", "b1", "b2", "b3")
    none = [F.lit(None).cast("binary").alias(f"b{i}") for i in range(4)]
    rows = rows.unionAll(late.select(F.lit("late").alias("kind"), "base", "rid", "x", *none))
    end = float(np.log10((u.ends + 1) / (u.tokens + u.types + 1)))
    s = rows.groupBy("base").applyInPandas(_documents, "id long, train boolean, n_tokens long, n_known long, base double, score double")
    return s.select("id", (~F.col("train")).alias("held_out"), "n_tokens", (F.col("n_known") + F.lit(int(u.ends > 0))).alias("n_known"),
                    F.lit(u.tokens).cast("long").alias("train_tokens"), F.round(F.col("base") + F.lit(end), 6).alias("base_score"),
                    F.round("score", 6).alias("score"))


def _documents(pdf: pd.DataFrame) -> pd.DataFrame:
    """The documents of one pack with the sums of all ranges."""
    kind = pdf["kind"]
    d = pdf[kind == "docs"].iloc[0]
    ids, null = np.frombuffer(d["b0"], np.int64), np.frombuffer(d["b1"], bool)
    n = len(ids)
    base, score, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    for r in pdf[kind == "score"].itertuples():
        here = unplanes(r.b3, 3).astype(np.int64)
        base[here] += np.frombuffer(r.b0, np.float64)
        score[here] += np.frombuffer(r.b1, np.float64)
        known[here] += unplanes(r.b2, 4).astype(np.int64)
    late = pdf[kind == "late"]
    score += np.bincount(late["rid"].astype(np.int64), weights=late["x"], minlength=n) if len(late) else 0
    return pd.DataFrame({"id": pd.Series(ids).astype("Int64").mask(null), "train": np.unpackbits(np.frombuffer(d["b3"], np.uint8))[:n].astype(bool),
                         "n_tokens": np.frombuffer(d["b2"], np.int64), "n_known": known, "base": base, "score": score})


def _grams(docs: DataFrame, order: int) -> DataFrame:
    """(rid, id, train, w0, w1, ...) of every token: its word and the ``order - 1`` words before it, the last first."""
    words = [f"w{j}" for j in range(order)]

    def run(batches):
        for batch in batches:
            for rows, data, off in blocks(batch, "text"):
                _, word, row = tokens(data, off)
                place = np.arange(len(word)) - np.searchsorted(row, row)
                before = [word]
                for j in range(1, order):
                    w = np.full(len(word), START, np.uint64)
                    w[place >= j] = word[np.flatnonzero(place >= j) - j]
                    before.append(w)
                for lo in range(0, len(word), 1 << 16):
                    s = slice(lo, lo + (1 << 16))
                    at = pa.array(row[s])
                    yield pa.RecordBatch.from_arrays([*(rows.column(c).take(at) for c in ("rid", "id", "train")), *(pa.array(w[s].view(np.int64)) for w in before)],
                                                     names=["rid", "id", "train", *words])

    numbered = docs.withColumn("rid", F.monotonically_increasing_id())
    return numbered.mapInArrow(run, "rid long, id long, train boolean, " + ", ".join(f"{w} long" for w in words))


def _kept(c, d: np.ndarray):
    """What the discounts leave of a count."""
    return F.when(c <= K, F.get(F.array(*[F.lit(float(x)) for x in d]), F.least(c, F.lit(K)).cast("int")) * c).otherwise(c.cast("double"))


def _counts_of_counts(grams: DataFrame) -> list[int]:
    n = {r["c"]: r["n"] for r in grams.where(F.col("c").between(1, K + 1)).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [0, *(n.get(r, 0) for r in range(1, K + 2))]


def model(spark: SparkSession, grams: DataFrame, order: int) -> tuple[list[DataFrame], int, int]:
    """The written tables of the orders 1 to ``order``, the training tokens and the training words.

    ``grams`` has (w0, w1, ..., c): every n-gram with its training count, which
    may be 0.  The table of order k has (w0 to w(k-1), c, alpha, p, c1): the
    n-gram's count, the weight of its context, its probability and the count
    of its word.
    """
    words = [f"w{j}" for j in range(order)]
    lower = {k: grams.groupBy(*words[:k]).agg(F.sum("c").alias("c")) if k < order else grams for k in range(1, order + 1)}
    c = F.col("c")
    first = written(spark, lower[1], "grams-1")
    n = _counts_of_counts(first)
    d = discounts(n)
    tot = first.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(c > 0, 1)).alias("types")).first()
    small = sum(r * n[r] for r in range(1, K + 1))
    unknown = 1 - (sum(d[r] * r * n[r] for r in range(1, K + 1)) + tot["n"] - small) / (tot["n"] + 1)
    p = F.when(c > 0, _kept(c, d) / F.lit(tot["n"] + 1)).otherwise(F.lit(float(unknown)))
    out = [written(spark, first.select("w0", "c", F.lit(1.0).alias("alpha"), p.alias("p"), c.alias("c1")), "model-1")]
    for k in range(2, order + 1):
        d = discounts(_counts_of_counts(lower[k]))
        suffix, context = words[:k - 1], words[1:k]
        g = lower[k].join(out[-1].select(*suffix, F.col("p").alias("q"), "c1"), suffix)
        g = written(spark, g.select(*words[:k], "c", "q", "c1", _kept(c, d).alias("kept")), f"grams-{k}")
        a = g.where("c > 0").groupBy(*context).agg(F.sum("c").alias("all"), F.sum("kept").alias("used"), F.sum("q").alias("low"))
        a = a.select(*context, "all", ((1 - F.col("used") / (F.col("all") + 1)) / (1 - F.col("low"))).alias("alpha"))
        g = g.join(a, context, "left").withColumn("alpha", F.coalesce("alpha", F.lit(1.0)))
        p = F.when(c > 0, F.col("kept") / (F.col("all") + 1)).otherwise(F.col("alpha") * F.col("q"))
        out.append(written(spark, g.select(*words[:k], "c", "alpha", p.alias("p"), "c1"), f"model-{k}"))
    return out, tot["n"], tot["types"]


def recursive(spark: SparkSession, d: DataFrame, order: int) -> DataFrame:
    """``score`` of (id, text, train) for any order, every token looked up in the written table of the highest."""
    if order < 1:
        raise ValueError("order counts the words of an n-gram, 1 at least")
    words = [f"w{j}" for j in range(order)]
    t = written(spark, _grams(d, order), "tokens")
    grams = written(spark, t.groupBy(*words).agg(F.sum(F.col("train").cast("long")).alias("c")), "grams")
    tables, n, types = model(spark, grams, order)
    s = t.join(tables[-1].select(*words, "p", "c1"), words).groupBy("rid", "id", "train").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.count(F.when(F.col("c1") > 0, 1)).alias("n_known"),
        F.sum(F.log10((F.col("c1") + 1) / F.lit(n + types + 1))).alias("base"), F.sum(F.log10("p")).alias("score"))
    return s.select("id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                    F.round("base", 6).alias("base_score"), F.round("score", 6).alias("score"))
