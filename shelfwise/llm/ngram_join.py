"""N-gram Jaccard join with token-combination prefixes, and its components.

A document is the set of its distinct five-word shingles ("tokens").  Two
documents link when 100 * intersection >= percent * union.

Prefixes.  Tokens have one global order: tokens that stand in one document
only, then rare tokens, both by hash, then frequent ones by ascending
frequency.  A document of n tokens lets a partner miss at
most t = n - ceil(percent * n / 100) of them.  Rare tokens are indexed alone.
Frequent tokens fall into classes by hash, and pairs of tokens of one class
are indexed; a class of c prefix tokens then only vouches for c - 1 of them.  Tokens of one
document fill its prefix, but need no index.  So a prefix is extended until its rare tokens and the c - 1 of its classes add
up to t + 1.  Of two linked documents the one whose prefix ends first shares
so many prefix tokens with the other that a rare token, or two of a class,
are common, and both index it.  The number of classes goes by the size of the
smaller document of a pair (a power of two), so a document indexes for the one
or two sizes its smaller partners can have; classes hold about four prefix
tokens, which keeps the pairs linear in the size of a document.

Frequent are the tokens that stand in more than ``rare_df`` documents; where
these are more than ``max_frequent``, the least frequent of them count as rare.
Which tokens stand in several documents is told by a bitmap of ``2**bits``
places; a token that shares its place counts as rare.  So what tasks are sent
has a fixed size, and the class of a token never changes the result.

Components.  Equal sets are one node.  Of the documents that index a key only
neighbours in the order of nodes are compared first, and the links found are
joined to components.  In the next rounds neighbours in other orders are
compared, where they lie in different components; so a large group of near
copies comes together without giving all its pairs.  What is left are keys
whose documents lie in several components for good; there every pair across
components is a candidate.  So no link between two components is missed.

Links.  Every link lies inside one component.  Where each row's number of
links is asked for, all pairs of nodes of a component are compared by whole
sets: its nodes are dealt into blocks of about ``block`` tokens by hash, every
two blocks of a component make a task's group, and only numbers leave it.  A
row's links are all other rows that it links with, copies included.

Bounds.  Linked sets have near sizes, and their difference is small: each set
has a sketch of 1024 parity bits, one token flipping one of them, so the bits in
which two sketches differ are a lower bound of the tokens in which the sets
do.  Candidates beyond either bound are dropped before sets are compared.

Defined cases: a text of fewer words than five is one token, its whole word
sequence; null texts and texts without words are empty and link with nothing;
repeated rows, also with one id, are equal sets; a null id is never the
smallest unless all are null; extra columns stay in ``one_of_each``, where all
rows with a null id and all empty documents stay; an empty table gives an
empty result.  Sets are held as 64-bit hashes of their tokens, nodes as 64-bit
hashes of their sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import LongType, StructField

from shelfwise.llm.arrowtext import LOWER, SPACE, blocks, byte_table, hash_spans, map_rows, mix, release, small_batches, spans
from shelfwise.llm.common import fresh, partitions, written
from shelfwise.llm.components import components

_TABLE = byte_table(51, LOWER)
_U = np.uint64


def shingles(data: np.ndarray, off: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(token, row) of all shingles in place; a shorter row of words is one token."""
    starts, ends, row = spans(data, off, SPACE)
    w = hash_spans(data, starts, ends, _TABLE)
    if not len(w):
        return w, row
    n = np.bincount(row, minlength=len(off) - 1)
    whole = n[row] >= size
    h, r = w[whole], row[whole]
    if len(h) >= size:
        x = h[: len(h) - size + 1].copy()
        for j in range(1, size):
            x = mix(x * _U(3) + h[j: len(h) - size + 1 + j])
        ok = r[: len(x)] == r[size - 1:]
        h, r = x[ok], r[: len(x)][ok]
    # Few words: the chain over all of them, with their number.
    few = np.flatnonzero((n > 0) & (n < size))
    if len(few):
        begin, count = np.searchsorted(row, few), n[few]
        x = w[begin].copy()
        for j in range(1, size - 1):
            more = count > j
            x[more] = mix(x[more] * _U(3) + w[begin[more] + j])
        x = mix(x + count.astype(_U))
        h, r = np.concatenate([h, x]), np.concatenate([r, few])
        o = np.argsort(r, kind="stable")
        h, r = h[o], r[o]
    return h, r


def _sets(data: np.ndarray, off: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct tokens of each row."""
    h, r = shingles(data, off, size)
    cut = np.searchsorted(r, np.arange(len(off)))
    return [np.unique(h[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def _node(s: np.ndarray) -> int:
    """A hash of a set, as a signed 64-bit integer."""
    with np.errstate(over="ignore"):
        a = mix(s ^ _U(0x5BD1E995)).sum(dtype=np.uint64)
        b = mix(s + _U(0xC2B2AE35)).sum(dtype=np.uint64)
        x = mix(np.array([a + _U(len(s)) * _U(0x9E3779B97F4A7C15)], np.uint64)) + b
    return int(mix(x).view(np.int64)[0])


SKETCH = [f"q{i}" for i in range(16)]


def _sketch(s: np.ndarray) -> np.ndarray:
    """The parities of the tokens at each of 1,024 places, as 16 integers."""
    flips = np.bincount((mix(s ^ _U(0x94D049BB133111EB)) & _U(1023)).astype(np.int64), minlength=1024) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def profile(docs: DataFrame, size: int = 5) -> DataFrame:
    """(id, n, node, sketch columns) of each row of (id, text)."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for rows, data, off in blocks(batch, "text"):
                sets = _sets(data, off, size)
                sketches = np.array([_sketch(s) for s in sets]).reshape(-1, len(SKETCH)).T
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_node(s) for s in sets], pa.int64()),
                     *(pa.array(np.ascontiguousarray(q)) for q in sketches)], names=["id", "n", "node", *SKETCH])

    schema = docs.select("id").schema.add("n", "long").add("node", "long")
    for q in SKETCH:
        schema = schema.add(q, "long")
    return docs.mapInArrow(run, schema)


# Token counts: sorted keys of 48 bits, as six planes of bytes in which the
# slowly changing high bytes compress well.  A key stands for its tokens.

def _pack(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    p = np.frombuffer(raw, np.uint8).reshape(6, -1)
    out = np.zeros((p.shape[1], 8), np.uint8)
    out[:, :6] = p.T
    return out.reshape(-1).view(np.uint64)


@dataclass
class Classes:
    """Which tokens are frequent, and which may stand in several documents, by keys of 48 bits."""
    keys: np.ndarray             # of the frequent ones, sorted
    ranks: np.ndarray            # from 1, ascending in frequency
    shared: np.ndarray           # bitmap over the keys' first bits
    bits: int

    def of(self, s: np.ndarray) -> np.ndarray:
        """-1 for tokens of one document, 0 for rare ones, the rank of frequent ones."""
        k = s >> _U(16)
        place = k >> _U(48 - self.bits)
        out = ((self.shared[(place >> _U(3)).astype(np.int64)] >> (_U(7) - (place & _U(7))).astype(np.uint8)) & 1).astype(np.int32) - 1
        if len(self.keys):
            at = np.searchsorted(self.keys, k)
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == k
            out[hit] = self.ranks[at[hit]]
        return out


def token_classes(spark: SparkSession, docs: DataFrame, size: int = 5, rare_df: int = 4, max_frequent: int = 1 << 20,
                  bits: int = 26, flush: int = 1_000_000) -> Classes:
    """The classes of all tokens, from how many documents each stands in.

    Tasks send their tokens in sorted packs, one for each range of keys.
    """
    small_batches(spark)
    parts = partitions(spark)
    r = min(bits - 3, int(np.ceil(np.log2(max(2, 4 * parts)))))
    ranges, shift = 1 << r, _U(48 - r)

    def send(batches):
        held, n = [], 0

        def out():
            k = np.sort(np.concatenate(held))
            cut = np.searchsorted(k, np.arange(ranges + 1, dtype=np.uint64) << shift)
            used = np.flatnonzero(cut[1:] > cut[:-1])
            return pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array([_pack(k[cut[i]: cut[i + 1]]) for i in used], pa.binary())], names=["part", "keys"])

        for batch in batches:
            for _, data, off in blocks(batch, "text"):
                for s in _sets(data, off, size):
                    held.append(s >> _U(16))
                    n += len(s)
                    if n >= flush:
                        yield out()
                        held, n = [], 0
                        release()
        if n:
            yield out()
        release()

    def count(key, pdf):
        import pandas as pd
        k = np.sort(np.concatenate([_unpack(x) for x in pdf["keys"]]))
        at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        df = np.diff(np.append(at, len(k)))
        places = np.zeros(1 << (bits - r), bool)
        places[((k[at[df > 1]] >> _U(48 - bits)) & _U(len(places) - 1)).astype(np.int64)] = True
        often = df > rare_df
        return pd.DataFrame({"part": key[0], "key": [-1, *k[at[often]].astype(np.int64)], "df": [0, *df[often]],
                             "places": [np.packbits(places).tobytes(), *[None] * int(often.sum())]})

    counts = docs.select("text").mapInArrow(send, "part int, keys binary").groupBy("part").applyInPandas(
        count, "part int, key long, df long, places binary")
    counts = written(spark, counts, "tokens")
    shared = np.zeros((ranges, 1 << (bits - r - 3)), np.uint8)
    for x in counts.where("key < 0").select("part", "places").collect():            # 2**bits bits in all
        shared[x["part"]] = np.frombuffer(x["places"], np.uint8)
    # The lowest frequency above which there are max_frequent tokens at most.
    step = F.floor(8 * F.log2("df")).cast("int")
    tops = sorted(counts.where("key >= 0").groupBy(step.alias("s")).count().collect(), reverse=True)     # 8 rows a doubling
    total, least = 0, 1 << 30
    for x in tops:
        total += x["count"]
        if total > max_frequent:
            break
        least = x["s"]
    t = counts.where((F.col("key") >= 0) & (step >= least)).select("key", "df").toArrow()         # max_frequent rows at most
    keys, df = (t[c].to_numpy() for c in ("key", "df"))
    ranks = np.empty(len(keys), np.int32)
    ranks[np.lexsort((keys, df))] = np.arange(1, len(keys) + 1)
    o = np.argsort(keys)
    return Classes(keys[o].astype(np.uint64), ranks[o], shared.reshape(-1), bits)


def _allowed(n: int, percent: int) -> int:
    """Tokens of a set of n that a linked partner can miss."""
    return n - -(-percent * n // 100)


def _classes(b: int, percent: int) -> int:
    """Classes of frequent tokens for smaller documents of 2**b tokens or more."""
    return max(1, (_allowed(1 << b, percent) + 1) // 3)


def signatures(s: np.ndarray, rank: np.ndarray, percent: int = 80) -> np.ndarray:
    """The keys under which a set is indexed; ``rank`` is as in ``Classes.of``."""
    n = len(s)
    need = _allowed(n, percent) + 1 - int((rank < 0).sum())
    if need <= 0:
        return np.zeros(0, np.uint64)
    rare = s[rank == 0]
    single = mix(rare[:need] ^ _U(0xA0761D6478BD642F))
    if len(rare) >= need:
        return single
    need -= len(rare)
    often = rank > 0
    f = s[often][np.argsort(rank[often], kind="stable")]
    out = [single]
    for b in range((-(-percent * n // 100)).bit_length() - 1, n.bit_length()):
        m = _classes(b, percent)
        cls = (mix(f ^ _U(0xE7037ED1A0B428DB)) % _U(m)).astype(np.int64)
        again = np.ones(len(f), bool)
        again[np.unique(cls, return_index=True)[1]] = False
        vouched = np.cumsum(again)
        end = int(np.searchsorted(vouched, need)) + 1
        g, c = f[:end], cls[:end]
        o = np.lexsort((g, c))
        g, c = g[o], c[o]
        salt = _U(0x8EBC6AF09C88C6E3) + _U(b)
        for d in range(1, len(g)):
            same = c[d:] == c[:-d]
            if not same.any():
                break
            out.append(mix(mix(g[:-d][same] + salt) ^ g[d:][same]))
    return np.concatenate(out)


def index(spark: SparkSession, docs: DataFrame, classes: Classes, size: int, percent: int) -> DataFrame:
    """(sig, n, node): every key of every row."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(classes)

    def run(batches):
        for batch in batches:
            for _, data, off in blocks(batch, "text"):
                sigs, sizes, nodes, counts = [], [], [], []
                for s in _sets(data, off, size):
                    if len(s) < 2:
                        continue
                    g = signatures(s, shared.value.of(s), percent)
                    if len(g):
                        sigs.append(g)
                        sizes.append(len(s))
                        nodes.append(_node(s))
                        counts.append(len(g))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64) if sigs else [], pa.int64()),
                     pa.array(np.repeat(np.array(sizes, np.int64), counts), pa.int64()),
                     pa.array(np.repeat(np.array(nodes, np.int64), counts), pa.int64())], names=["sig", "n", "node"])

    return docs.select("text").mapInArrow(run, "sig long, n long, node long")


def _near(a: str, b: str, percent: int):
    """Sizes that can belong to a link."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _alike(x: str, y: str, percent: int):
    """Sketches that can belong to a link: its sets of sizes a and b differ in (100 - p) (a + b) / (100 + p) tokens at most."""
    differ = sum((F.bit_count(F.col(x + q).bitwiseXOR(F.col(y + q))) for q in SKETCH), F.lit(0))
    return (100 + percent) * differ <= (100 - percent) * (F.col(f"{x}n") + F.col(f"{y}n"))


def _sent(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def _sets_of(spark: SparkSession, docs: DataFrame, classes: DataFrame, nodes: DataFrame, size: int, broadcast_rows: int) -> DataFrame:
    """(node, tokens) of ``nodes`` (node), a row for each."""
    small_batches(spark, 128)
    first = written(spark, nodes.join(classes, "node").select("node", F.col("id").alias("_id")), "compared")
    # Only texts of compared documents travel; the list is broadcast if its counted rows allow.
    d = docs.join(_sent(first, first.count(), broadcast_rows), docs["id"].eqNullSafe(first["_id"])).select("node", "text")

    def sets(batches):
        for batch in batches:
            for rows, data, off in blocks(batch, "text"):
                want = rows.column("node").to_pylist()
                got = _sets(data, off, size)
                ok = [i for i, s in enumerate(got) if _node(s) == want[i]]     # another row may have the id
                yield pa.RecordBatch.from_arrays([pa.array([want[i] for i in ok], pa.int64()),
                                                  pa.array([got[i].tobytes() for i in ok], pa.binary())], names=["node", "tokens"])

    return d.mapInArrow(sets, "node long, tokens binary").groupBy("node").agg(F.first("tokens").alias("tokens"))


def compared(spark: SparkSession, docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int,
             broadcast_rows: int) -> DataFrame:
    """(x, y, linked) of ``pairs`` (x, y of nodes), from whole sets of tokens."""
    nodes = pairs.select(F.col("x").alias("node")).unionAll(pairs.select("y")).distinct()
    # One set for each node, dealt by node: the same exchange serves both joins.
    t = _sets_of(spark, docs, classes, nodes, size, broadcast_rows)
    p = pairs.join(t.select(F.col("node").alias("x"), F.col("tokens").alias("tx")), "x")
    p = p.join(t.select(F.col("node").alias("y"), F.col("tokens").alias("ty")), "y")

    def check(batches):
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("tx"), batch.column("ty")):
                a, b = (np.frombuffer(z.as_buffer(), np.uint64) for z in (a, b))
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(linked, pa.bool_())], names=["x", "y", "linked"])

    return written(spark, p.mapInArrow(check, "x long, y long, linked boolean"), "compared")


def _link_counts(a: list[np.ndarray], b: list[np.ndarray], wa: np.ndarray, wb: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For the sets of ``a`` the weights of their links in ``b``, and the other way round."""
    na, nb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    if not a or not b:
        return na, nb
    o = np.argsort([len(x) for x in b], kind="stable")
    sizes, w = np.array([len(b[i]) for i in o]), wb[o]
    off = np.concatenate([[0], np.cumsum(sizes)])
    words, code = np.unique(np.concatenate([b[i] for i in o]), return_inverse=True)
    got = np.zeros(len(b), np.int64)
    for i, s in enumerate(a):
        n = len(s)
        lo, hi = np.searchsorted(100 * sizes, percent * n), np.searchsorted(percent * sizes, 100 * n, "right")
        if lo >= hi:
            continue
        at = np.searchsorted(words, s)
        at[at == len(words)] = 0
        here = np.zeros(len(words), np.uint8)
        here[at[words[at] == s]] = 1
        both = np.add.reduceat(here[code[off[lo]: off[hi]]], off[lo:hi] - off[lo], dtype=np.int64)
        linked = 100 * both >= percent * (n + sizes[lo:hi] - both)
        na[i] = w[lo:hi][linked].sum()
        got[lo:hi][linked] += wa[i]
    nb[o] = got
    return na, nb


def link_counts(spark: SparkSession, docs: DataFrame, classes: DataFrame, comp: DataFrame, size: int, percent: int,
                broadcast_rows: int, block: int = 1 << 16) -> DataFrame:
    """(node, others): the rows of other nodes that each node of ``comp`` links with."""
    of = comp.join(classes.select("node", "n", "n_copies"), "node")
    all_ = of.groupBy("component").agg(F.least(F.ceil(F.sum("n") / F.lit(block)), F.count(F.lit(1))).cast("int").alias("blocks"))
    of = of.join(all_, "component").select("node", "component", "n_copies", "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("own"))
    of = written(spark, of, "members")
    t = of.join(_sets_of(spark, docs, classes, of.select("node"), size, broadcast_rows), "node")
    t = t.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "n_copies", "tokens")

    def count(key, pdf):
        import pandas as pd
        sides = []
        for k in dict.fromkeys(key[1:]):
            x = pdf[pdf["own"] == k]
            sides.append((x["node"].to_numpy(), [np.frombuffer(z, np.uint64) for z in x["tokens"]], x["n_copies"].to_numpy()))
        (u, a, wa), (v, b, wb) = sides[0], sides[-1]
        na, nb = _link_counts(a, b, wa, wb, percent)
        if len(sides) == 1:
            return pd.DataFrame({"node": u, "others": na - wa})          # a set links with itself
        return pd.DataFrame({"node": np.concatenate([u, v]), "others": np.concatenate([na, nb])})

    counts = t.groupBy("component", "lo", "hi").applyInPandas(count, "node long, others long")
    return written(spark, counts.groupBy("node").agg(F.sum("others").alias("others")), "counts")


def join(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
         percent: int = 80, rare_df: int = 4, max_frequent: int = 1 << 20, bits: int = 26, rounds: int = 2, broadcast_rows: int = 200_000,
         links: bool = False, block: int = 1 << 16, nodes: bool = False) -> DataFrame:
    """(id, n_shingles, component_id, n_copies) of each row; copies are the rows with an equal set, the row included.

    With ``links`` also n_links, the number of other rows that the row links with, and with ``nodes`` the row's node.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = written(spark, profile(d, size), "profile")
    classes = rows.where("n > 0").groupBy("node").agg(
        F.min("id").alias("id"), F.min("n").alias("n"), F.count(F.lit(1)).alias("n_copies"), F.first(F.struct(*SKETCH)).alias("q"))
    classes = written(spark, classes.select("node", "id", "n", "n_copies", "q.*"), "classes")

    kinds = token_classes(spark, d, size, rare_df, max_frequent, bits)
    w = Window.partitionBy("sig").orderBy("node")
    keyed = index(spark, d, kinds, size, percent)
    keyed = keyed.withColumn("prev", F.lag("node").over(w)).withColumn("last", F.max("node").over(Window.partitionBy("sig")))
    # Keys of one document only are most of them and need nothing more; of equal rows one stays.
    keyed = keyed.where("(prev IS NULL AND last > node) OR prev < node")
    keyed = written(spark, keyed.drop("last"), "keys")
    tested = None

    def marked(x: str) -> DataFrame:
        return classes.select(F.col("node").alias(x), *[F.col(c).alias(x + c) for c in ("n", *SKETCH)])

    def test(p: DataFrame) -> DataFrame:
        """Compares the pairs that were not compared yet; all results so far are in ``tested``."""
        nonlocal tested
        p = p.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        for x in ("x", "y"):
            p = p.join(marked(x), x)
        p = p.where(_near("xn", "yn", percent) & _alike("x", "y", percent)).select("x", "y")
        if tested is not None:
            p = p.join(tested.select("x", "y"), ["x", "y"], "left_anti")
        got = compared(spark, d, classes, written(spark, p, "pairs"), size, percent, broadcast_rows)
        tested = got if tested is None else tested.unionAll(got)
        return got.where("linked")

    near = keyed.where("prev IS NOT NULL").select(F.col("prev").alias("x"), F.col("node").alias("y"))
    comp = components(spark, test(near))

    def split() -> DataFrame:
        """The keys whose documents lie in several components, with these (c) and the largest of the key (main)."""
        k = keyed.select("sig", "node", "n").join(comp, "node", "left").select("sig", "node", "n", F.coalesce("component", "node").alias("c"))
        several = k.groupBy("sig", "c").agg(F.count(F.lit(1)).alias("m")).groupBy("sig").agg(
            F.max_by("c", F.struct("m", "c")).alias("main"), F.count(F.lit(1)).alias("cs")).where("cs > 1")
        return written(spark, k.join(several.select("sig", "main"), "sig"), "split")

    def merge(links: DataFrame) -> bool:
        nonlocal comp
        if not links.limit(1).count():
            return False
        comp = components(spark, comp.select(F.col("node").alias("x"), F.col("component").alias("y")).unionAll(links.select("x", "y")))
        return True

    k = split()
    for seed in range(1, rounds + 1):
        # The first of these orders is the same for all keys, the next ones are each key's own.
        order = F.xxhash64("node", F.lit(seed)) if seed == 1 else F.xxhash64("node", "sig", F.lit(seed))
        o = Window.partitionBy("sig").orderBy(order, "node")
        b = k.select("node", "n", "c", *[F.lag(x).over(o).alias(f"p{x}") for x in ("node", "n", "c")])
        b = b.where((F.col("c") != F.col("pc")) & _near("n", "pn", percent)).select("node", "pnode").distinct()
        if not merge(test(b.select(F.col("node").alias("x"), F.col("pnode").alias("y")))):
            break
        k = split()

    # What is left: every pair across components of a key that the bounds allow.
    k = k.select("sig", "node", "c", "main")
    rest, main, other = (k.where(side).select("sig", F.col("node").alias(x), F.col("c").alias(f"{x}c")).join(marked(x), x)
                         for side, x in (("c <> main", "x"), ("c = main", "y"), ("c <> main", "y")))
    may = _near("xn", "yn", percent) & _alike("x", "y", percent)
    across = rest.join(main, "sig").where(may).select("x", "y").unionAll(
        rest.join(other, "sig").where((F.col("xc") < F.col("yc")) & may).select("x", "y"))
    merge(test(across))

    of = classes.join(comp, "node").groupBy("component").agg(F.min("id").alias("least"))
    of = comp.join(of, "component").select("node", "least")
    more = ["n_links"] if links else []
    if links:
        counts = link_counts(spark, d, classes, comp, size, percent, broadcast_rows, block)
        classes = classes.join(counts, "node", "left").withColumn("n_links", F.coalesce("others", F.lit(0)) + F.col("n_copies") - 1)
    classes = classes.join(of, "node", "left").select("node", "n_copies", F.coalesce("least", "id").alias("label"), *more)
    out = rows.join(classes, (rows["node"] == classes["node"]) & (rows["n"] > 0), "left")
    return out.select("id", rows["n"].alias("n_shingles"), F.when(F.col("n") > 0, F.col("label")).otherwise(F.col("id")).alias("component_id"),
                      F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"), *[F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in more],
                      *([rows["node"]] if nodes else []))


def one_of_each(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                broadcast_rows: int = 200_000, **how) -> DataFrame:
    """The rows of ``docs`` without those that are linked, over any number of links, with a row of a smaller id.

    Of rows with one id and equal sets, one stays.
    """
    j = written(spark, join(spark, docs, id_col, text_col, broadcast_rows=broadcast_rows, nodes=True, **how), "joined")
    key, node, own = fresh("_id", docs), fresh("_node", docs), fresh("_own", docs)
    moved = F.col("id") != F.col("component_id")
    ids = j.where("id IS NOT NULL").groupBy(F.col("id").alias(key)).agg(F.min(moved).alias("every"), F.max(moved).alias("some")).where("some")
    gone, mixed = ids.where("every").select(key), written(spark, ids.where("NOT every").select(key), "mixed")
    out = docs.join(_sent(gone, gone.count(), broadcast_rows), F.col(id_col) == F.col(key), "left_anti")
    n = mixed.count()
    if n:
        # Ids on several texts of which only some are linked with a smaller id: these rows go by their sets.
        some = out.join(_sent(mixed, n, broadcast_rows), F.col(id_col) == F.col(key), "left_semi")
        rest = out.join(_sent(mixed, n, broadcast_rows), F.col(id_col) == F.col(key), "left_anti")
        size = how.get("size", 5)
        some = map_rows(some, lambda rows, data, off: [pa.array([_node(x) for x in _sets(data, off, size)], pa.int64())],
                        [StructField(own, LongType())], text_col)
        left = j.where(moved).select(F.col("id").alias(key), F.col("node").alias(node)).distinct()
        some = some.join(left, (F.col(id_col) == F.col(key)) & (F.col(own) == F.col(node)), "left_anti")
        out = rest.unionAll(some.select(*[F.col(f"`{c}`") for c in docs.columns]))
    again = j.where("id = component_id AND n_shingles > 0").groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    again = written(spark, again.select(F.col("id").alias(key)), "again")
    n = again.count()
    if not n:
        return out
    # Repeated ids are rare; only their rows are compared.
    some = out.join(_sent(again, n, broadcast_rows), F.col(id_col) == F.col(key), "left_semi")
    rest = out.join(_sent(again, n, broadcast_rows), F.col(id_col) == F.col(key), "left_anti")
    return rest.unionAll(some.dropDuplicates([id_col, text_col]))
