"""N-gram Jaccard join: signatures and results against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import ngram_join as nj
from shelfwise.llm.components import components


def plain_set(t):
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()).split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_join(rows):
    """(n, smallest id reachable) of each row, by comparing all pairs of different sets."""
    sets = [plain_set(t) for _, t in rows]
    of = {}
    for (i, _), s in zip(rows, sets):
        of.setdefault(s, []).append(i)
    nodes = [s for s in of if s]
    up = {s: s for s in nodes}

    def find(s):
        while up[s] is not s:
            s = up[s]
        return s
    for a in range(len(nodes)):
        for b in range(a):
            x, y = nodes[a], nodes[b]
            if 100 * len(x & y) >= 80 * len(x | y):
                up[find(x)] = find(y)
    least = {}
    for s in nodes:
        least.setdefault(find(s), []).extend(i for i in of[s] if i is not None)
    return [(i, len(s), (min(least[find(s)], default=None) if s else i), len(of[s]) if s else 1) for (i, _), s in zip(rows, sets)]


def near_copies(r, n, words, changes):
    base = [f"w{r.randint(0, 10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, changes)):
            w[r.randrange(len(w))] = f"z{r.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    texts = []
    for words, n, changes in ((9, 14, 1), (30, 25, 2), (120, 30, 6), (400, 12, 18), (8, 10, 1), (64, 20, 4), (63, 20, 4)):
        texts += near_copies(r, n, words, changes)
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} " + " ".join(f"q{r.randint(0, 10**6)}" for _ in range(r.randint(2, 60))) for _ in range(40)]
    texts += ["", None, " \t ", "one", "One", "a b c d", "a b c d e", "a b c d e f", "A B C D E F g", "x " * 3000, "x " * 3001]
    texts += texts[3:9] + [texts[20].upper(), texts[20].replace(" ", "\n\x0b")]
    out = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    return [*out, out[5], out[5], (None, texts[30]), (None, "nothing like it at all really"), (out[0][0], "an id twice with another text here")]


@pytest.mark.parametrize("how", [{}, {"rare_df": 2, "max_frequent": 60, "bits": 12, "rounds": 1}, {"rare_df": 1, "broadcast_rows": 0, "rounds": 0}])
def test_equals_plain(spark, rows, how):
    df = spark.createDataFrame([(i, t, "n", 5) for i, t in rows], "doc_id long, text string, node string, n int").repartition(3)
    got = sorted((str(r["id"]), r["n_shingles"], str(r["component_id"]), r["n_copies"]) for r in nj.join(spark, df, **how).collect())
    assert got == sorted((str(i), n, str(c), k) for i, n, c, k in plain_join(rows))


def test_one_of_each(spark, rows):
    df = spark.createDataFrame([(i, t, 1.5, "x") for i, t in rows], "doc_id long, text string, _id double, n string")
    out = nj.one_of_each(spark, df)
    assert out.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    labels = {}
    for (i, t), (_, n, c, _) in zip(rows, plain_join(rows)):
        if n:
            labels.setdefault(c, set()).add(i)
    empty = [r for r in rows if not plain_set(r[1])]
    assert len([k for k in kept if not plain_set(k[1])]) == len(empty)
    for c, ids in labels.items():
        if c is not None:
            assert len([k for k in kept if k[0] == c and plain_set(k[1])]) >= 1
    assert not [k for k in kept if k[0] is not None and k[0] not in labels and plain_set(k[1])]
    assert nj.one_of_each(spark, df.limit(0)).count() == 0


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert nj.join(spark, df).collect() == []
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, nj.join(spark, only).collect())) == [(1, 0, 1, 1), (2, 0, 2, 1)]


def test_linked_sets_share_a_signature():
    """For random pairs at the threshold and any choice of frequent tokens."""
    r = np.random.default_rng(3)
    for _ in range(400):
        n = int(r.integers(4, 400))
        x = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        n = len(x)
        drop = int(r.integers(0, nj._allowed(n, 80) + 1))
        y = np.delete(x, r.choice(n, drop, replace=False))
        room = (len(y) * 100) // 80 - n            # more tokens that keep the pair linked
        if room > 0:
            y = np.unique(np.concatenate([y, r.integers(0, 2**63, int(r.integers(0, room + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        share = r.random()
        often = {int(t): k + 1 for k, t in enumerate(r.permutation(np.union1d(x, y))) if r.random() < share}
        alone = set(np.setxor1d(x, y).tolist()) if r.random() < 0.5 else set()
        a, b = (set(nj.signatures(s, np.array([-1 if int(t) in alone else often.get(int(t), 0) for t in s])).tolist()) for s in (x, y))
        assert a & b


def test_sketches_bound_the_difference():
    r = np.random.default_rng(8)
    for _ in range(200):
        x, y = (np.unique(r.integers(0, 400, int(r.integers(0, 300))).astype(np.uint64)) for _ in range(2))
        differ = sum(int(b).bit_count() for b in (nj._sketch(x) ^ nj._sketch(y)).view(np.uint64))
        assert differ <= len(np.setxor1d(x, y))


def test_signatures_stay_linear():
    r = np.random.default_rng(4)
    for n in (10, 100, 1000, 20_000):
        s = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        assert len(nj.signatures(s, np.arange(1, len(s) + 1))) < 3 * n


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 4999), (4999, 5000), (7, 7)]
    df = spark.createDataFrame(links, "x long, y long")
    got = {r["node"]: r["component"] for r in components(spark, df).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1050)}, 4999: 4999, 5000: 4999}
    assert components(spark, df.where(F.lit(False))).count() == 0


def test_packs_round_trip():
    k = np.sort(np.random.default_rng(1).integers(0, 2**48, 1000).astype(np.uint64))
    assert (nj._unpack(nj._pack(k)) == k).all()


@pytest.mark.parametrize("how", [{}, {"block": 300, "broadcast_rows": 0}])
def test_links_equal_plain(spark, rows, how):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = [plain_set(t) for _, t in rows]
    want = [(str(i), len(s), sum(j != k and 100 * len(s & x) >= 80 * len(s | x) for k, x in enumerate(sets)) if s else 0) for j, ((i, _), s) in enumerate(zip(rows, sets))]
    got = sorted((str(r["id"]), r["n_shingles"], r["n_links"]) for r in nj.join(spark, df, links=True, **how).collect())
    assert got == sorted(want)
    assert want[5][2] >= 2                     # the rows repeated above count


def test_one_id_on_two_texts(spark):
    """Only the text that is linked with a smaller id goes; an empty text with the id stays too."""
    x, y = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    rows = [(1, y), (5, x), (5, y + " more"), (5, ""), (9, x + " more")]
    out = nj.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == [(1, y), (5, ""), (5, x)]
