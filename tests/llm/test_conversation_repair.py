"""Conversation repair against plain searches, and its defined cases."""

import hashlib
import itertools
import random
import re
import zlib

from shelfwise.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
SEEN = re.compile(r"[^\x20\x09-\x0D]")


def plain(rows):
    """(cost, audit, lines) by dynamic programming over prefixes, audits compared as whole strings; rows are (role, text, fault)."""
    states = {0: (0, "", ())}

    def inserts(states):
        for _ in range(3):
            for s, (c, a, ls) in list(states.items()):
                own = cr.OWN[s]
                way, to = (c + 5, a + "I", (*ls, cr.ROLE[own] + ":")), cr.NEXT[s][own]
                if to not in states or way[:2] < states[to][:2]:
                    states[to] = way
        return states

    for role, text, fault in rows:
        new = {}
        for s, (c, a, ls) in inserts(states).items():
            ways = [(c + 2, a + "D", ls, s)]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if role[0] in cr.NEXT[s]:
                    ways.append((c + extra, a + "K", (*ls, f"{role}:{text}"), cr.NEXT[s][role[0]]))
                own = cr.OWN[s]
                ways.append((c + 1 + extra, a + "R", (*ls, f"{cr.ROLE[own]}:{text}"), cr.NEXT[s][own]))
            for *w, t in ways:
                if t not in new or tuple(w[:2]) < new[t][:2]:
                    new[t] = tuple(w)
        states = new
    return min(w for s, w in inserts(states).items() if s in (0, 3))


def every(rows):
    """The cheapest (cost, audit) by trying all edits with up to one insertion in each gap."""
    best = None
    kinds = [["D"] if f in ("blank", "duplicate") else ["D", "K", "R"] for _, _, f in rows]
    for gaps in itertools.product([0, 1], repeat=len(rows) + 1):
        for letters in itertools.product(*kinds):
            cost, audit, state = 0, "", 0
            for k in range(len(rows) + 1):
                if gaps[k]:
                    state, cost, audit = cr.NEXT[state][cr.OWN[state]], cost + 5, audit + "I"
                if k == len(rows):
                    break
                role, _, fault = rows[k]
                audit += letters[k]
                if letters[k] == "D":
                    cost += 2
                    continue
                cost += (letters[k] == "R") + (5 if fault == "truncated" else 0)
                state = cr.NEXT[state].get(role[0] if letters[k] == "K" else cr.OWN[state])
                if state is None:
                    break
            if state in (0, 3) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def some_rows(rng, n):
    return [(rng.choice(["user", "assistant", "system", "tool"]), "x", rng.choice([None, None, None, "truncated", "blank"])) for _ in range(n)]


def marks(rows):
    code = {None: cr.FINE, "truncated": cr.TRUNCATED, "blank": cr.FORCED, "duplicate": cr.FORCED}
    return [r[0] for r, _, _ in rows], [code[f] for _, _, f in rows]


def test_search_is_the_best_of_all_edits():
    rng = random.Random(5)
    for _ in range(60):
        rows = some_rows(rng, rng.randint(0, 5))
        assert cr.search(list(zip(*marks(rows))), cr.EMPTY, cr.ENDS) == every(rows)


def test_search_equals_the_plain_one_on_long_conversations():
    rng = random.Random(6)
    for n in (30, 120, 400):
        rows = some_rows(rng, n)
        assert cr.search(list(zip(*marks(rows))), cr.EMPTY, cr.ENDS) == plain(rows)[:2]


def faults(rows):
    """[(role, text, fault)] of one conversation's (turn, role, text), in order."""
    rows = [(t, r or " ", " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, out = set(), []
    for _, role, text in rows:
        last = SEEN.findall(text)[-1:]
        fault = ("blank" if not last else "duplicate" if (role, text) in seen else None if last[0] in ".!?" else "truncated")
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(rows):
    marked = faults(rows)
    cost, audit, lines = plain(marked)
    turns = [t for t, _, _ in rows if t is not None]
    inis = [r[0] for r, _, _ in marked]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(inis, inis[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def collected(df):
    out = {}
    for r in df.collect():
        assert r["conv_id"] not in out
        out[r["conv_id"]] = {k: v for k, v in r.asDict().items() if k != "conv_id"}
    return out


def conversations(seed=9):
    rng = random.Random(seed)
    words = ["Yes.", "no", "Why?", " ", "", "\t\n", "Go on!", "a . b", "é.", "Yes.  \n", None]
    rows = []
    for conv in [*range(30), None]:
        for _ in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 4, 7]), rng.choice(["user", "assistant", "system", "tool", "", None, "é"]), rng.choice(words)))
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", "long " * 20000 + f"{t}.") for t in range(6)]
    rows += [(101, t, rng.choice(["user", "assistant", "system"]), f"Text {t % 50}" + rng.choice([".", "", "?"])) for t in range(300)]
    return rows


def by_conv(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def test_repair_equals_the_plain_version(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", cost string").repartition(7)
    assert collected(cr.repair(spark, df)) == {c: expected(r) for c, r in by_conv(rows).items()}


def test_chunks_of_any_size_give_the_same(spark):
    rows = conversations(4)
    df = spark.createDataFrame(rows, SCHEMA)
    for chunk in (1, 3, 64):
        assert collected(cr.repair(spark, df, chunk)) == {c: expected(r) for c, r in by_conv(rows).items()}


def test_damage(spark):
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate([("user", "A? b."), ("assistant", None), (None, "C!")])] + [(None, None, "user", "D.")]
    got = sorted(spark_rows(cr.damaged(spark.createDataFrame(rows, SCHEMA))))
    want = []
    for c, t, r, x in rows:
        r, x = r or " ", " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want += [(str(c), str(t), "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    assert got == sorted(want)
    assert {zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, _, _ in rows if c is not None} >= {0, 1, 2, 3, 4}


def spark_rows(df):
    return [(str(r["conv_id"]), str(r["turn"]), r["role"], r["text"]) for r in df.collect()]


def test_conversations_without_rows_and_empty_tables(spark):
    all_rows = spark.createDataFrame([(1, 0, "user", "Hi."), (2, 0, "user", "Hi.")], SCHEMA)
    got = collected(cr.repaired_all(spark, all_rows, all_rows.where("conv_id = 1")))
    assert got[2] == {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                      "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    assert got[1]["audit"] == "D" and got[1]["cost"] == 2
    empty = spark.createDataFrame([], SCHEMA)
    assert collected(cr.repaired_all(spark, empty, empty)) == {}


def test_intact_conversations_stay(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (1, 3, "user", "Bye."), (1, 4, "assistant", "Bye!")]
    got = collected(cr.repair(spark, spark.createDataFrame(rows, SCHEMA)))[1]
    assert (got["cost"], got["audit"], got["illegal"], got["gaps"]) == (0, "KKKKK", 0, 0)
    assert got["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in rows).encode()).hexdigest()
