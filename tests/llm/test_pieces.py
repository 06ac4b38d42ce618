"""SentencePiece: the streaming search against a plain one over the whole text, and exact round trips."""

import random

import numpy as np
import pytest

from shelfwise.llm import pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def plain(v, text):
    """The best segmentation by a table over the whole text."""
    s = pieces.prepared(text)
    best = [(0.0, [])] + [None] * len(s)
    for e in range(1, len(s) + 1):
        for b in range(max(0, e - v.max_len), e):
            if s[b:e] in v.pieces:
                i, x = v.pieces[s[b:e]]
                new = (best[b][0] + x, best[b][1] + [i])
            elif b == e - 1:
                raw = ("▁" if s[b] == pieces.LITERAL else s[b]).encode()
                new = (best[b][0] + v.byte_score, best[b][1] + [v.byte_ids[c] for c in raw])
            else:
                continue
            if best[e] is None or new[0] > best[e][0]:
                best[e] = new
    return best[-1][1]


def exhaustive(v, s):
    """The score of the best of all segmentations of a short prepared text."""
    if not s:
        return 0.0
    return max((v.pieces[s[:n]][1] if s[:n] in v.pieces else v.byte_score) + exhaustive(v, s[n:])
               for n in range(1, len(s) + 1) if n == 1 or s[:n] in v.pieces)


def texts():
    r = random.Random(5)
    out = ["", "a", " a", "  two  spaces   here ", "héllo wörld▁x", "日本語テスト\n\n\ttab", "▁", "🎉 ok", "a" * 300, "the quick brown fox " * 5, " " * 40, "\x00\x7f\r\n"]
    return out + ["".join(r.choice("abc the  \né▁日🎉") for _ in range(r.randint(0, 200))) for _ in range(60)] + ["thonouth " * 30 + "zzz" * 40]


@pytest.mark.parametrize("together", [1, 1000])
def test_streaming_block_and_plain_agree(vocabulary, together):
    ts = texts()
    raw = [t.encode() for t in ts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    ids, at = pieces.encode_block(vocabulary, pieces.Memo(most=50, together=together), np.frombuffer(b"".join(raw), np.uint8), off)
    back = pieces.Speller.of(vocabulary).texts(ids, at)
    for k, t in enumerate(ts):
        exp = plain(vocabulary, t)
        assert pieces.encode_text(vocabulary, t) == exp
        assert ids[at[k]: at[k + 1]].tolist() == exp
        assert back[k] == t


def test_best_of_all_segmentations(vocabulary):
    spelled = {i: s for i, s in vocabulary.pieces.values()}
    for t in ["the then", "in on an", "xkcd", "日本", "thing"]:
        s = pieces.prepared(t)
        got = pieces.encode_text(vocabulary, t)
        assert sum(spelled.get(i, 0.0) for i in got) + vocabulary.byte_score * sum(c not in vocabulary.pieces for c in s) == pytest.approx(exhaustive(vocabulary, s))


def test_window_stays_short(vocabulary):
    s = pieces.Viterbi(vocabulary)
    n = sum(1 for _ in s.feed(pieces.prepared("the quick brown fox jumps " * 3000)))
    assert n > 10_000 and s.widest < 4 * vocabulary.max_len


def test_without_convergence_points():
    """Pieces with spaces inside: a text is one segment, searched as a stream."""
    v = pieces.Vocabulary({"a": (256, -1.0), "b": (257, -1.0), "▁": (258, -1.0), "a▁b": (259, -0.5), "▁a": (260, -0.7)}, list(range(256)),
                          [bytes([i]) for i in range(256)] + [b"a", b"b", b" ", b"a b", b" a"])
    assert not v.splits
    raw = b"a ba b"
    ids, at = pieces.encode_block(v, pieces.Memo(), np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert ids.tolist() == plain(v, "a ba b")
    assert pieces.Speller.of(v).texts(ids, at) == ["a ba b"]


def test_tables(spark, vocabulary):
    rows = [(i, t, "ids", [1]) for i, t in enumerate(texts())] + [(None, None, "x", []), (1, "again", "x", None), (1, "again", "x", None), (7, "long " * 50_000, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string, n array<int>")
    v = vocabulary
    out = pieces.encode(df, v, check="ok")
    assert out.columns == [*df.columns, "ids", "ok"]
    got = out.collect()
    assert len(got) == len(rows) and all(r["ok"] for r in got)
    assert [r["ids"] for r in got if r["text"] is None] == [None]
    back = pieces.decode(out.drop("text"), v).collect()
    assert sorted(str(r["text"]) for r in back) == sorted(str(r[1]) for r in rows)
    assert pieces.encode(df.limit(0), v).count() == 0 and pieces.decode(out.limit(0), v).count() == 0
