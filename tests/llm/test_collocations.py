"""Collocations against a plain count of all phrases, the tries against plain lookups, and the defined cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfwise.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, least=10, top=2000):
    """{(lang, rank): (phrase, a, l, r, n, score)} from dictionaries of all phrases."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in (1, 2, 3):
                for i in range(len(ws) - k + 1):
                    f[lang][tuple(ws[i: i + k])] += 1
    out = {}
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in cand.items() if len(p) == 3 for q in (p[:2], p[1:]) if q in cand and 100 * a >= 50 * cand[q]}
        scored = []
        for p, a in cand.items():
            if p not in gone:
                cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out[lang, rank] = (phrase.decode(), -a, left, right, n[lang], -score)
    return out


def got(df):
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


def texts(seed=3, n=120):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "DELTA", "é", "über", "x", "-", "(y)", "zeta"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(n):
        ws = rng.choices(words, [12 - min(k, 11) for k in range(len(words))], k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", ";"]) for w in ws)
        if i % 4 == 0:
            text += " new york city. New  York\tCity"
        rows.append((i, text, rng.choice(["en", "de", None, "und"])))
    return rows + [(n, None, "en"), (n + 1, "", "fr"), (n + 2, " \t\n", None), (n + 3, "again and " * 5000, "en"), rows[0], rows[0]]


def test_mine_equals_the_plain_version(spark):
    rows = texts()
    want = plain(rows)
    assert any(" ".join(("new", "york", "city")) == v[0] for v in want.values())
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA + ", rank int, phrase string").repartition(5)
    assert got(co.mine(spark, df)) == want


def test_parts_of_dictionary_and_shards_change_nothing(spark, monkeypatch):
    rows = texts(8)
    for name, value in (("DICTIONARY", 7), ("SHARD", 11), ("GROUP", 2)):
        monkeypatch.setattr(co, name, value)
    assert got(co.mine(spark, spark.createDataFrame(rows, SCHEMA), least=6, top=25)) == plain(rows, 6, 25)


def test_nothing_frequent_and_empty_tables(spark):
    for rows in ([], [(1, None, None)], [(1, "a b c. a b", "en")]):
        assert got(co.mine(spark, spark.createDataFrame(rows, SCHEMA))) == {}


@pytest.mark.parametrize("n,size,length", [(1, 3, 2), (40, 5, 2), (3000, 300, 3), (5000, 70000, 2), (20000, 200, 2)])
def test_double_array_finds_its_phrases_and_no_others(n, size, length):
    rng = np.random.default_rng(n)
    words, _ = co._unique(rng.integers(1, size + 1, (n, length)).astype(np.int32))
    digits = -(-size.bit_length() // 8)
    base, check = co.double_array(words, digits)
    index = {tuple(w): i for i, w in enumerate(words.tolist())}
    ids = rng.integers(0, size + 1, 4000).astype(np.int32)
    ids[100: 100 + length * 20] = words[rng.integers(0, len(words), 20)].ravel()
    want = [(i, index[tuple(ids[i: i + length].tolist())]) for i in range(len(ids) - length + 1) if tuple(ids[i: i + length].tolist()) in index]
    at, found = co.advance(ids, base, check, length, digits)
    assert list(zip(at.tolist(), found.tolist())) == want and len(want) >= 20


def test_scores_beyond_64_bits_are_exact(spark):
    a, left, right = 3 * 10**12 + 7, 4 * 10**12 + 1, 5 * 10**12 + 3
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(co._score("a", "l", "r").alias("s")).first()
    assert row["s"] == 1000000 * a * a // (left * right)


def test_the_text_is_read_as_often_however_many_tries_there_are(spark, monkeypatch):
    names, written = [], co.written
    monkeypatch.setattr(co, "written", lambda s, df, name, *more: names.append(name) or written(s, df, name, *more))
    df = spark.createDataFrame(texts(8), SCHEMA)
    few = got(co.mine(spark, df, least=6, top=25))
    passes = list(names)
    monkeypatch.setattr(co, "SHARD", 11)
    assert got(co.mine(spark, df, least=6, top=25)) == few and names == 2 * passes


def test_pairs_that_share_a_bit_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(co, "BITS", 1)
    rows = texts(5, 60)
    assert got(co.mine(spark, spark.createDataFrame(rows, SCHEMA), least=6, top=25)) == plain(rows, 6, 25)


def test_places_among_hashes():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 700):
        known = np.sort(np.concatenate([rng.integers(-2**63, 2**63 - 1, n), np.arange(n) - 3]))
        h = np.concatenate([rng.integers(-2**63, 2**63 - 1, 500), known, [-2**63, 2**63 - 1, 0]])
        assert (co._place(known, co._begins(known), h) == np.searchsorted(known, h)).all()


def test_counts_of_a_task_are_added_up_by_word(spark, monkeypatch):
    """Also where few are held at a time."""
    rows = texts(4)
    want = Counter((lang or "und", w) for _, text, lang in rows for w in re.findall("[^\x20\x09.,;:!?\x0a-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
    for held in (1, 50, 10**6):
        monkeypatch.setattr(co, "HELD", held)
        out = co._counted(spark.createDataFrame(rows, SCHEMA).repartition(3), 11).groupBy("lang", "word", "h").agg({"c": "sum"}).collect()
        assert Counter({(r["lang"], r["word"]): r["sum(c)"] for r in out}) == want
