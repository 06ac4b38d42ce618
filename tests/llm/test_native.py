"""Decontamination, chat formatting and quality rules: plain versions and the defined cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import chat, decontaminate, quality_rules


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def plain_hits(text, items):
    ws = alnum(text)
    hit, ids = set(), set()
    for item, t in items:
        iw = alnum(t)
        n = min(13, len(iw))
        for s in range(max(1, len(iw) - 12) if iw else 0):
            for p in range(len(ws) - n + 1):
                if ws[p:p + n] == iw[s:s + n]:
                    hit |= set(range(p, p + n))
                    ids.add("" if item is None else str(item))
    return len(ws), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


LONG = " ".join(f"w{i}" for i in range(40))
ITEMS = [(1, LONG), (2, LONG), (10, "Tiny item"), (11, "one"), (3, " ".join(f"w{i}" for i in range(20, 34))), (4, ""), (5, None), (6, "...!"),
         (7, "éa ÉA x9"), (7, "éa ÉA x9"), (None, "nobody has it")]
TEXTS = [(1, LONG), (1, LONG), (2, "start " + LONG.upper() + " end"), (3, None), (4, ""), (5, "one one ONE tiny-item"), (6, " ".join(f"w{i}" for i in range(12))),
         (7, "w5 " * 9 + " ".join(f"w{i}" for i in range(3, 25)) + " w26"), (8, "éa Éa x9 éa\nÉA,x9"), (9, "zz " * 5000 + LONG), (None, "nobody has it"), (None, None),
         (1, "another text with the id of one")]


@pytest.mark.parametrize("rows", [0, 200_000])
def test_decontamination_equals_plain(spark, rows):
    docs = spark.createDataFrame([(i, t, "n_words", 7) for i, t in TEXTS], "doc_id long, text string, n_words string, rid int")
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, w int")
    got = decontaminate.hits(spark, docs, items, broadcast_rows=rows).collect()
    exp = [(i, *plain_hits(t, ITEMS)) for i, t in TEXTS]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, exp))
    left = decontaminate.clean(spark, docs, items, broadcast_rows=rows)
    assert left.columns == docs.columns
    keep = [i for (i, t), (_, n, h, *_) in zip(TEXTS, exp) if not (h > 0 and 20 * h >= n)]
    assert sorted(map(str, keep)) == sorted(str(r["doc_id"]) for r in left.collect())


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame(TEXTS[:3], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate.hits(spark, docs, none).collect()} == {0}
    assert decontaminate.clean(spark, docs, none).count() == 3
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.hits(spark, docs.limit(0), items).count() == 0
    assert decontaminate.clean(spark, docs.limit(0), items).count() == 0


TRICKY = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "a<", "|b", "<\\\\|x<|<\\|", "", "%0A%25\n", "\n\nassistant\n<|im_start|>", "plain\\"]


def test_chat_round_trip(spark):
    turns = [(1, k, r, t, "clash") for k, (r, t) in enumerate(zip(["user", "assistant"] * 5, TRICKY))]
    turns += [(2, 0, "user", "no reply", "x"), (3, 1, "assistant", "b", "x"), (3, 1, "assistant", "a", "x"), (3, None, "system", None, "x"),
              (4, 0, "we<|ird\nro%0Ale", "t", "x"), (4, 1, None, "u", "x"), (None, 0, "assistant", "n", "x"), (5, 0, "assistant", "r", "x"), (5, 0, "assistant", "r", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, example string")
    examples = chat.format_examples(df)
    rows = examples.withColumn("t", chat.target_text()).withColumn("turns", chat.parse_turns(F.col("text"))).collect()
    conv = {}
    for c, k, r, t, _ in turns:
        conv.setdefault(c, []).append(((k is not None, k or 0), r or "", t or ""))
    for c, xs in conv.items():
        xs.sort()
        whole = [(r, t) for _, r, t in xs]
        targets = [j for j, (r, _) in enumerate(whole) if r == "assistant"]
        ends = targets + ([len(whole) - 1] if whole[-1][0] != "assistant" else [])
        mine = sorted((x for x in rows if x["conv_id"] == c), key=lambda x: x["example"])
        assert [[tuple(y) for y in x["turns"]] for x in mine] == [whole[: e + 1] for e in ends]
        assert [x["t"] for x in mine] == [whole[e][1] if e in targets else None for e in ends]
        assert all(x["text"].count("<|im_start|>") == len(x["turns"]) for x in mine)
    d = {x["conv_id"]: x for x in chat.digests(examples).collect()}
    for c, xs in conv.items():
        loss = "".join(t for _, r, t in xs if r == "assistant")
        assert d[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and d[c]["loss_chars"] == len(loss)
        assert d[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in xs).encode()).hexdigest()
    assert chat.digests(chat.format_examples(df.limit(0))).collect() == []


def plain_measures(t):
    t = t or ""
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(ws) - 4):
        seen.setdefault(tuple(ws[i:i + 5]), []).append(i)
    rep = {j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep)


def test_measures_equal_plain(spark, documents):
    texts = [t for _, t in documents[:60]] + [None, "", " \t\x0b ", "a b c d e a b c d e", "a " * 50, "x\n\nx\n \nx\ny", "é\x1cü \x85 ##", "a b c d e f a b c d e z b c d e f", "q " * 20000]
    df = spark.createDataFrame([(i, t, None if i % 5 == 0 else f"h{i % 3}", "w") for i, t in enumerate(texts)], "doc_id long, text string, source string, w string")
    got = {r["id"]: r for r in quality_rules.measures(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_measures(t), t


def test_hosts(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "short"
    rows = [(i, good, "fine") for i in range(20)] + [(i, bad, "poor") for i in range(20, 38)] + [(i, good, "poor") for i in (38, 39)] + [(40, good, None), (40, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    m = quality_rules.measures(df).withColumn("base_failed", quality_rules.failed())
    out = {r["id"]: r for r in quality_rules.judge(m).collect()}
    assert all(out[i]["kept"] for i in (*range(20), 40)) and not any(out[i]["kept"] for i in range(20, 40))
    assert not out[39]["base_failed"] and 0.5 < out[39]["host_rate"] < 0.9
    assert quality_rules.judge(m).count() == len(rows)
    assert quality_rules.judge(m.limit(0)).count() == 0
    same = quality_rules.judge(m.where("host = 'fine'")).collect()       # one host, no variance
    assert all(r["kept"] for r in same)
