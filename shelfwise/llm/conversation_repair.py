"""Conversation structure repair by depth-first branch and bound.

``faults`` puts a conversation's rows in order (turn with nulls first, then role and text) and names each row's first
fault: blank, duplicate or truncated.  ``repair`` finds the cheapest edits after which the role initials read
``(s?(ua)+)?``: keep a row (0), give it the role that its place asks for (1), delete it (2, forced for blank and
duplicate rows) or insert an empty row (5); a truncated row that stays adds 5.  Of equally cheap edits the ASCII-least
initials win.

The search (``search``) is a depth-first branch and bound with an explicit stack.  Nodes are (row, state of the role
pattern); a suffix bound, the cheapest way to end from a node, cuts prefixes that can't beat the incumbent (cost, audit),
and a dominance table per node cuts prefixes that are no better than one seen there.  Children are taken cheapest bound
first, then in ASCII order.

Two equally cheap prefixes at one node have the same number of row edits, so neither is the beginning of the other, and
the lesser one stays the lesser whatever follows.  Hence a conversation can be cut into chunks: each chunk of ``CHUNK``
rows is searched by its own task, for each state before and after it, and the chunks' answers are put together in
order.  Only one conversation's audit is ever held, never its texts: those stream past, sorted, into the digest.  The
digest is a running hash over the conversation, so its texts pass one task, in batches.

Defined cases: null roles and texts count as one space, and so does an empty role; a null turn sorts first and is left
out of the gaps; rows of a null id form one conversation; repeated rows are duplicates; a conversation without rows has
zeros, an empty audit and the digest of nothing; an empty table gives no row.  Extra columns are ignored; clashing names
don't matter, for only the four columns are taken.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.arrowtext import small_batches
from shelfwise.llm.common import written

CHUNK = 256                      # rows of a conversation that one search takes

#: The costs of the edits and the states of the role pattern.
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 1, 2, 5, 5
EMPTY, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = [{"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U}]
OWN = ["u", "u", "a", "u"]       # the role that an edit can put into each state's next place
ENDS = (EMPTY, AFTER_A)
FINE, FORCED, TRUNCATED = range(3)
ROLE = {"u": "user", "a": "assistant"}
SEEN = r"[^\x20\x09-\x0D]"


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with one row in four damaged, by the checksum of ``conv_id:turn``."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn"))) % 20
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(times).alias("time")).drop("time")


def faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, pos, initial, illegal, fault): the rows in order from 1 with their first fault."""
    role = F.when(F.coalesce("role", F.lit("")) == "", " ").otherwise(F.col("role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("initial", F.substring("role", 1, 1)).withColumns(
        {"pos": F.row_number().over(order), "pair": F.concat(F.lag("initial").over(order), "initial")})
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("pos")) > 1
    seen = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    fault = (F.when(~F.col("text").rlike(SEEN), "blank").when(again, "duplicate")
             .when(~F.substring(seen, -1, 1).isin(".", "!", "?"), "truncated"))
    return rows.select("conv_id", "turn", "role", "text", "pos", "initial",
                       (~F.col("pair").isin("su", "ua", "au")).alias("illegal"), fault.alias("fault"))


def _edits(row: tuple[str, int], state: int):
    """(letter, cost, state after) of what may become of one row, in ASCII order of the letters."""
    initial, fault = row
    yield "D", DELETE, state
    if fault == FORCED:
        return
    stays = STAYS_TRUNCATED if fault == TRUNCATED else 0
    if initial in NEXT[state]:
        yield "K", KEEP + stays, NEXT[state][initial]
    yield "R", REROLE + stays, NEXT[state][OWN[state]]


def bounds(rows: list[tuple[str, int]], ends: tuple[int, ...]) -> list[list[float]]:
    """For each row and state the least cost of the rows from there on that ends in one of ``ends``."""
    def inserted(b):
        for _ in range(2):
            b = [min(b[s], INSERT + b[NEXT[s][OWN[s]]]) for s in range(4)]
        return b

    out = [inserted([0 if s in ends else float("inf") for s in range(4)])]
    for row in reversed(rows):
        out.append(inserted([min(cost + out[-1][to] for _, cost, to in _edits(row, s)) for s in range(4)]))
    return out[::-1]


def search(rows: list[tuple[str, int]], start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """The cheapest (cost, audit) for rows (initial, fault) from state ``start`` to one of ``ends``; None if there is no way."""
    bound = bounds(rows, ends)
    if bound[0][start] == float("inf"):
        return None
    incumbent: tuple[float, str] = (float("inf"), "")
    dominating: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if (cost + bound[i][state], audit) > (incumbent[0], incumbent[1][:len(audit)]):
            continue
        if (i, state) in dominating and dominating[i, state] <= (cost, audit):
            continue
        dominating[i, state] = (cost, audit)
        if i == len(rows) and state in ends:
            incumbent = min(incumbent, (cost, audit))
        children = [(i, NEXT[state][OWN[state]], cost + INSERT, audit + "I")]
        if i < len(rows):
            children += [(i + 1, to, cost + c, audit + letter) for letter, c, to in _edits(rows[i], state)]
        live = [(c[2] + bound[c[0]][c[1]], c[3], c) for c in children if c[2] + bound[c[0]][c[1]] <= incumbent[0]]
        stack += [c for _, _, c in sorted(live, reverse=True)]
    return incumbent


def solve(initials: str, marks: list[int], whole: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of a chunk; of a whole conversation only the one that counts."""
    rows = list(zip(initials, marks))
    if whole:
        return [(EMPTY, EMPTY, *search(rows, EMPTY, ENDS))]
    found = [(s, t, search(rows, s, (t,))) for s in range(4) for t in range(4)]
    return [(s, t, *x) for s, t, x in found if x]


_CHUNKS = "conv_id {0}, chunk long, befores array<int>, afters array<int>, costs array<long>, audits array<string>"


def _searched(rows: DataFrame, size: int) -> DataFrame:
    """The answers for each chunk of ``size`` rows of a conversation."""
    mark = F.when(F.col("fault").isin("blank", "duplicate"), FORCED).when(F.col("fault") == "truncated", TRUNCATED).otherwise(FINE)
    kind = rows.schema["conv_id"].dataType.simpleString()
    chunk = F.floor((F.col("pos") - 1) / size)
    parts = (rows.select("conv_id", chunk.alias("chunk"), F.struct("pos", "initial", mark.alias("mark")).alias("row"))
             .groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list("row")).alias("rows"))
             .select("conv_id", "chunk", F.col("rows.initial").alias("initials"), F.col("rows.mark").alias("marks")))

    def run(batches):
        for b in batches:
            out = []
            for chunk, initials, marks in zip(b["chunk"].to_pylist(), b["initials"].to_pylist(), b["marks"].to_pylist()):
                # A chunk that isn't full and is the first one is a whole conversation.
                found = solve(initials, marks, chunk == 0 and len(marks) < size)
                out.append([list(x) for x in zip(*found)])
            cols = [pa.array([o[k] for o in out], t) for k, t in enumerate(
                (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([b["conv_id"], b["chunk"], *cols], names=["conv_id", "chunk", "befores", "afters", "costs", "audits"])

    return parts.mapInArrow(run, _CHUNKS.format(kind))


class _Fold:
    """One conversation as it streams past: its chunks' answers first, then its rows."""

    def __init__(self, key):
        self.key, self.done, self.best, self.at = key, [], {EMPTY: (0, [])}, None
        self.hash, self.lines = hashlib.sha256(), 0

    def chunk(self, befores, afters, costs, audits):
        new = {}
        for s, t, cost, audit in zip(befores, afters, costs, audits):
            if s in self.best:
                way = (self.best[s][0] + cost, [*self.best[s][1], audit])
                if t not in new or self._less(way, new[t]):
                    new[t] = way
        self.best = new
        ways = [audits for _, audits in new.values()]
        while ways[0] and all(w and w[0] == ways[0][0] for w in ways):      # what all ways begin with is settled
            self.done.append(ways[0][0])
            for w in ways:
                del w[0]

    @staticmethod
    def _less(x, y) -> bool:
        return x[0] < y[0] or x[0] == y[0] and "".join(x[1]) < "".join(y[1])

    def _end(self) -> None:
        ways = [(cost, "".join(audit)) for s, (cost, audit) in self.best.items() if s in ENDS]
        cost, rest = min(ways)
        self.cost, self.audit = cost, "".join([*self.done, rest])
        self.at, self.next = 0, "u"

    def _line(self, role: str, text: str) -> None:
        self.hash.update(((b"\n" if self.lines else b"") + f"{role}:{text}".encode()))
        self.lines += 1

    def _inserts(self) -> None:
        while self.audit[self.at: self.at + 1] == "I":
            self._put(ROLE[self.next], "")
            self.at += 1

    def _put(self, role: str, text: str) -> None:
        self._line(role, text)
        self.next = "u" if role[0] in "sa" else "a"

    def row(self, role: str, text: str) -> None:
        if self.at is None:
            self._end()
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._put(role if edit == "K" else ROLE[self.next], text)

    def result(self) -> tuple:
        if self.at is None:
            self._end()
        self._inserts()
        return self.key, self.cost, self.audit, self.hash.hexdigest()


def _folded(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, repaired_sha256) of conversations whose rows and chunks stream past in order."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    none = [F.lit(None).cast(t).alias(c) for c, t in (("role", "string"), ("text", "string"))]
    first = chunks.select("conv_id", F.lit(0).alias("part"), F.col("chunk").alias("pos"), *none, "befores", "afters", "costs", "audits")
    then = rows.select("conv_id", F.lit(1).alias("part"), F.col("pos").cast("long").alias("pos"), "role", "text",
                       *[F.lit(None).cast(t).alias(c) for c, t in (("befores", "array<int>"), ("afters", "array<int>"), ("costs", "array<long>"), ("audits", "array<string>"))])
    both = first.unionByName(then).repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")

    def run(batches):
        types, schema = None, None
        now = None
        for b in batches:
            types = b.schema.field("conv_id").type
            schema = pa.schema([("conv_id", types), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
            done = []
            for key, part, _, role, text, *answers in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or now.key != key:
                    if now is not None:
                        done.append(now.result())
                    now = _Fold(key)
                if part == 0:
                    now.chunk(*answers)
                else:
                    now.row(role, text)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d)) for d in done], schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, now.result()))], schema)

    return both.mapInArrow(run, f"conv_id {kind}, cost long, audit string, repaired_sha256 string")


def repair(spark: SparkSession, turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation of ``turns``: conv_id, gaps, its faults, cost, audit, repaired_sha256."""
    small_batches(spark)
    rows = written(spark, faults(turns), "turns")
    count = lambda c: F.count(F.when(c, 1))
    stats = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")], count(F.col("illegal")).alias("illegal"))
    found = _folded(rows, _searched(rows, chunk)).withColumnRenamed("conv_id", "id_")
    return stats.join(found, F.col("conv_id").eqNullSafe(F.col("id_"))).drop("id_")


def repaired_all(spark: SparkSession, originals: DataFrame, turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``repair`` of ``turns`` with a row for every conv_id of ``originals``, also for those without rows."""
    ids = originals.select(F.col("conv_id").alias("id_")).distinct()
    out = ids.join(repair(spark, turns, chunk), F.col("id_").eqNullSafe(F.col("conv_id")), "left")
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    cols = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return out.select(F.col("id_").alias("conv_id"), *[F.coalesce(c, none.get(c, F.lit(0).cast("long"))).alias(c) for c in cols])
