"""SentencePiece encoding and decoding by a streaming Viterbi search.

The encoder looks for the segmentation of a text into vocabulary pieces with
the largest sum of scores.  It reads the text character by character and keeps
one backpointer for each position of a window; whenever all paths that can
still be extended go through one boundary, the ids before it are committed and
forgotten, so the window stays near the maximal piece length.

Where no piece of the vocabulary can reach over a boundary (before a run of
spaces, when pieces hold spaces only at their start), all paths converge at
once.  There a text falls into segments that are searched independently, and
the ids of short segments are remembered within a task, up to a bound.

Text form: spaces become U+2581 after one is put before the text.  A character
outside the vocabulary is spelled in byte pieces; so is U+2581 itself, which
makes decoding exact for every text.  Ties go to the longest last piece.

Defined cases: a null text gives null ids and an empty text none; both decode to
themselves.  Extra columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField

from shelfwise.llm.arrowtext import byte_table, free, hash_spans, map_rows, powers, small_batches

MARK = "▁"
LITERAL = "\udfff"              # stands for a mark that the text itself holds; no valid text has a lone surrogate
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Vocabulary:
    """Pieces with ids and scores, the ids of the 256 byte pieces, and what the search needs of them."""
    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    spelled: list[bytes]                 # the bytes that each id decodes to; spaces as spaces
    max_len: int = 0
    byte_score: float = 0.0
    splits: bool = False                 # no piece has a space after another character

    def __post_init__(self):
        self.max_len = max(map(len, self.pieces), default=1)
        self.byte_score = min((s for _, s in self.pieces.values()), default=0.0) - 10.0
        self.splits = not any(MARK in p.lstrip(MARK) for p in self.pieces)


def load(model_file: str = DEFAULT_MODEL) -> Vocabulary:
    """The vocabulary of a SentencePiece model file (its pieces and scores; a file of fixed size)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, byte_ids, spelled = {}, [-1] * 256, []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[1:-1], 16)] = i
            spelled.append(bytes([int(p[1:-1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            spelled.append(b"")
        else:
            pieces[p] = (i, sp.get_score(i))
            spelled.append(p.replace(MARK, " ").encode())
    return Vocabulary(pieces, byte_ids, spelled)


def prepared(text: str) -> str:
    """``text`` as the search reads it: a space in front, spaces as marks, literal marks as a lone surrogate."""
    return (" " + text).replace(MARK, LITERAL).replace(" ", MARK) if text else ""


def _spell(v: Vocabulary, c: str) -> tuple[int, ...]:
    return tuple(v.byte_ids[b] for b in (MARK if c == LITERAL else c).encode())


class Viterbi:
    """A streaming search: ``feed`` prepared characters, ``end`` the text; both give the ids committed.

    ``ends`` holds, for each position of the window, the best score and the
    piece that ends there (its length and ids); ``widest`` is the largest
    window so far.
    """

    def __init__(self, v: Vocabulary):
        self.v = v
        self.tail = ""                                  # the last characters, max_len at most
        self.at = 0                                     # characters read
        self.base = 0                                   # the last committed boundary
        self.ends: dict[int, tuple[float, int, tuple[int, ...]]] = {0: (0.0, 0, ())}
        self.widest = 1

    def feed(self, text: Iterable[str]) -> Iterator[int]:
        get, ends, most = self.v.pieces.get, self.ends, self.v.max_len
        for c in text:
            tail = self.tail = (self.tail + c)[-most:]
            self.at += 1
            best = None
            for n in range(min(len(tail), self.at - self.base), 0, -1):
                if (before := ends.get(self.at - n)) is None:
                    continue
                if (hit := get(tail[-n:])) is not None:
                    if best is None or before[0] + hit[1] > best[0]:
                        best = (before[0] + hit[1], n, (hit[0],))
                elif n == 1 and (best is None or before[0] + self.v.byte_score > best[0]):
                    best = (before[0] + self.v.byte_score, 1, _spell(self.v, c))
            ends[self.at] = best
            self.widest = max(self.widest, len(ends))
            if self.at - self.base >= most:
                yield from self._commit()

    def _commit(self) -> Iterator[int]:
        """Commits up to the last boundary that all surviving paths share.

        The next pieces start at one of the last ``max_len`` positions, so the
        paths to these survive; followed back together, from the far end, they
        meet at that boundary or at the one committed last.
        """
        live = set(range(max(self.at - self.v.max_len + 1, self.base), self.at + 1))
        while len(live) > 1:
            top = max(live)
            live.discard(top)
            live.add(top - self.ends[top][1])
        join = live.pop()
        if join > self.base:
            yield from self._ids(join)
            score = self.ends[join][0]
            for p in [p for p in self.ends if p < join]:
                del self.ends[p]
            # Scores count from the boundary, so they stay small in long texts.
            for p, (s, n, ids) in self.ends.items():
                self.ends[p] = (s - score, n, ids)
            self.base = join

    def _ids(self, upto: int) -> list[int]:
        out: list[tuple[int, ...]] = []
        p = upto
        while p > self.base:
            _, n, ids = self.ends[p]
            out.append(ids)
            p -= n
        return [i for ids in reversed(out) for i in ids]

    def end(self) -> list[int]:
        return self._ids(self.at)


def encode_text(v: Vocabulary, text: str) -> list[int]:
    """The ids of one whole text, by the streaming search."""
    s = Viterbi(v)
    return [*s.feed(prepared(text)), *s.end()]


def _short(v: Vocabulary, seg: str) -> list[int]:
    """The same search over a segment that is its own window: positions in a list, nothing to commit early."""
    get, most = v.pieces.get, v.max_len
    score, back = [0.0], [(0, ())]
    for e in range(1, len(seg) + 1):
        best, at = None, None
        for b in range(max(0, e - most), e):
            hit = get(seg[b:e])
            if hit is not None:
                s = score[b] + hit[1]
                if best is None or s > best:
                    best, at = s, (b, (hit[0],))
            elif b == e - 1 and (best is None or score[b] + v.byte_score > best):
                best, at = score[b] + v.byte_score, (b, _spell(v, seg[b]))
        score.append(best)
        back.append(at)
    out = []
    e = len(seg)
    while e:
        e, ids = back[e]
        out.append(ids)
    return [i for ids in reversed(out) for i in ids]


_SEGMENTS = byte_table(31)


class PieceTable:
    """The pieces by hashes of their bytes (spaces as spaces), for many lookups at once."""

    def __init__(self, v: Vocabulary):
        raw = [p.replace(MARK, " ").encode() for p in v.pieces]
        self.ids = np.array([i for i, _ in v.pieces.values()], np.int32)
        self.scores = np.array([s for _, s in v.pieces.values()])
        self.lengths = sorted({len(x) for x in raw}, reverse=True)
        self.up, self.down = (x[:1024] for x in powers(1024))
        self.hashes = np.array([self._hash(np.frombuffer(x, np.uint8)) for x in raw], np.uint64)
        # A piece stands in the first table, or in the second where that place is taken.
        for self.bits in range(20, 28):
            if self._placed():
                break
        else:
            raise ValueError("pieces with equal hashes")

    def _placed(self) -> bool:
        self.first, self.second = (np.full(1 << self.bits, -1, np.int32) for _ in range(2))
        a, b = self._places(self.hashes)
        self.first[a] = np.arange(len(a))
        rest = np.flatnonzero(self.first[a] != np.arange(len(a)))
        self.second[b[rest]] = rest
        return bool((self.second[b[rest]] == rest).all())

    def _hash(self, x: np.ndarray) -> int:
        return int(np.sum(_SEGMENTS[x] * self.up[: len(x)], dtype=np.uint64))

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        down = np.uint64(64 - self.bits)
        return (h * np.uint64(0x9E3779B97F4A7C15)) >> down, (h * np.uint64(0xD6E8FEB86659FD93)) >> down

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        a, b = self._places(h)
        i = self.first[a]
        miss = self.hashes[i] != h
        miss |= i < 0
        if miss.any():
            j = self.second[b[miss]]
            i[miss] = np.where((j >= 0) & (self.hashes[j] == h[miss]), j, -1)
        return i


def _many(v: Vocabulary, t: PieceTable, raw: list[bytes]) -> list[bytes]:
    """The search of ``_short`` over segments of one byte length, step by step for all of them.

    Positions are bytes; no path gets to a place within a character.
    """
    x = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
    n_seg, n = x.shape
    s = np.zeros((n + 1, n_seg), np.uint64)
    s[1:] = np.cumsum(_SEGMENTS[x] * t.up[:n], axis=1, dtype=np.uint64).T
    lead = x.T
    size = np.where(lead < 0x80, 1, np.where(lead >= 0xF0, 4, np.where(lead >= 0xE0, 3, np.where(lead >= 0xC0, 2, 0))))
    score = np.full((n + 1, n_seg), -np.inf)
    score[0] = 0.0
    start, piece = np.zeros((n + 1, n_seg), np.int16), np.full((n + 1, n_seg), -1, np.int32)
    steps = sorted({*t.lengths, 1, 2, 3, 4}, reverse=True)
    for e in range(1, n + 1):
        best = score[e]
        for k in steps:
            b = e - k
            if b < 0:
                continue
            i = t.find((s[e] - s[b]) * t.down[b])
            hit = i >= 0
            new = np.where(hit, score[b] + t.scores[i], -np.inf)
            if k <= 4:            # a character that is no piece is spelled
                new = np.where(~hit & (size[b] == k), score[b] + v.byte_score, new)
            better = new > best
            if better.any():
                best[better] = new[better]
                start[e][better] = b
                piece[e][better] = i[better]
    # Back from the ends; each step gives a piece or the bytes of a character.
    at = np.full(n_seg, n)
    path, count = [], np.zeros(n_seg, np.int64)
    while True:
        on = np.flatnonzero(at > 0)
        if not len(on):
            break
        e = at[on]
        b, i = start[e, on].astype(np.int64), piece[e, on]
        path.append((on, b, e, i))
        count[on] += np.where(i >= 0, 1, e - b)
        at[on] = b
    ends = np.cumsum(count)
    cursor = ends.copy()
    flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
    spell = np.array(v.byte_ids, np.int32)
    for on, b, e, i in path:
        hit = i >= 0
        cursor[on[hit]] -= 1
        flat[cursor[on[hit]]] = t.ids[i[hit]]
        for k in range(1, 5):
            more = ~hit & (e - b >= k)
            cursor[on[more]] -= 1
            flat[cursor[on[more]]] = spell[x[on[more], e[more] - k]]
    return [flat[a: z].tobytes() for a, z in zip((ends - count).tolist(), ends.tolist())]


@dataclass
class Memo:
    """Ids of short segments by their hash, forgotten all at once when there are ``most``."""
    most: int = 400_000
    short: int = 64
    together: int = 24           # segments of one length that are worth a search together
    ids: dict[int, bytes] = field(default_factory=dict)
    table: PieceTable | None = None

    def segments(self, v: Vocabulary, keys: list[int], raw: list[bytes]) -> list[bytes]:
        """The ids of segments that are all different."""
        got = [self.ids.get(k) for k in keys]
        by_length: dict[int, list[int]] = {}
        for i, x in enumerate(got):
            if x is None:
                by_length.setdefault(len(raw[i]), []).append(i)
        if len(self.ids) >= self.most:
            self.ids.clear()
        for n, which in by_length.items():
            if n > self.short:
                for i in which:
                    s = Viterbi(v)
                    got[i] = np.array([*s.feed(_marked(raw[i])), *s.end()], np.int32).tobytes()
                continue
            if len(which) >= self.together:
                self.table = self.table or PieceTable(v)
                found = _many(v, self.table, [raw[i] for i in which])
            else:
                found = [np.array(_short(v, _marked(raw[i])), np.int32).tobytes() for i in which]
            for i, ids in zip(which, found):
                got[i] = self.ids[keys[i]] = ids
        return got


def _marked(raw: bytes) -> str:
    return raw.decode().replace(MARK, LITERAL).replace(" ", MARK)


def encode_block(v: Vocabulary, memo: Memo, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, row offsets) for a byte buffer of texts."""
    n = np.diff(off)
    rows = np.flatnonzero(n)
    put = np.arange(len(data)) + np.repeat(np.cumsum(n > 0), n)         # a space goes before each text
    buf = np.full(len(data) + len(rows), 32, np.uint8)
    buf[put] = data
    first = off[rows] + np.arange(len(rows))
    starts = np.zeros(len(buf), bool)
    if v.splits:
        space = buf == 32
        starts[1:] = space[1:] & ~space[:-1]
    starts[first] = True
    starts = np.flatnonzero(starts)
    ends = np.append(starts[1:], len(buf))
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
    keys, where, inverse = np.unique(hash_spans(buf, starts, ends, _SEGMENTS), return_index=True, return_inverse=True)
    raw = buf.tobytes()
    found = memo.segments(v, keys.tolist(), [raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())])
    size = np.array([len(x) // 4 for x in found])
    flat = np.frombuffer(b"".join(found), np.int32)
    ids = _gather(flat, np.cumsum(size) - size, size, inverse)
    row = np.searchsorted(first, starts, "right") - 1
    per = np.zeros(len(n), np.int64)
    per[rows] = np.bincount(row, weights=size[inverse], minlength=len(rows)).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(per)])


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The parts ``which`` of ``flat``, one after another."""
    n = size[which]
    at = np.repeat(start[which] - (np.cumsum(n) - n), n)
    at += np.arange(len(at))
    return flat[at]


@dataclass
class Speller:
    """Turns ids into bytes."""
    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, v: Vocabulary) -> Speller:
        size = np.array([len(x) for x in v.spelled])
        return cls(np.frombuffer(b"".join(v.spelled), np.uint8), np.cumsum(size) - size, size)

    def texts(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        """The text of each row of ids; bytes that are no UTF-8 become replacement characters."""
        raw = _gather(self.flat, self.start, self.size, ids).tobytes()
        ends = np.concatenate([[0], np.cumsum(self.size[ids])])[off].tolist()
        return [raw[a + (raw[a:a + 1] == b" " and b > a): b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


_STATE: dict[str, tuple] = {}          # of this Python worker: vocabulary of the last broadcast, speller, memo


def _state(shared) -> tuple[Vocabulary, Speller, Memo]:
    key = str(shared.id if hasattr(shared, "id") else id(shared))
    if key not in _STATE:
        _STATE.clear()
        v = shared.value
        _STATE[key] = (v, Speller.of(v), Memo())
    return _STATE[key]


def encode(docs: DataFrame, v: Vocabulary, text_col: str = "text", ids_col: str = "ids", check: str | None = None,
           keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the ids of each text; ``check`` names a column that tells whether decoding them gave the text.

    Columns of these names stay, and the new ones get underscores until their names are free."""
    kept = docs.columns if keep is None else keep
    ids_col = free(ids_col, kept)
    check = free(check, [*kept, ids_col]) if check else None
    shared = docs.sparkSession.sparkContext.broadcast(v)
    fields = [StructField(ids_col, ArrayType(IntegerType(), False))] + ([StructField(check, BooleanType())] if check else [])

    def fn(rows, data, off):
        v, speller, memo = _state(shared)
        ids, at = encode_block(v, memo, data, off)
        null = rows.column(text_col).is_null()
        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
        out = [pc.if_else(null, pa.scalar(None, lists.type), lists) if null.true_count else lists]
        if check:
            back = pa.array(speller.texts(ids, at), pa.string())
            out.append(pc.fill_null(pc.equal(back, rows.column(text_col).cast(pa.string())), null))
        return out

    return map_rows(docs, fn, fields, text_col, keep)


def decode(df: DataFrame, v: Vocabulary, ids_col: str = "ids", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with the text of each row of ids; null ids give a null text."""
    small_batches(df.sparkSession)
    kept = [c for c in (df.columns if keep is None else keep) if c != text_col]
    shared = df.sparkSession.sparkContext.broadcast(v)
    schema = df.select(*kept).schema.add(text_col, StringType())

    def run(batches):
        _, speller, _ = _state(shared)
        for b in batches:
            col = b.column(ids_col)
            flat = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.int64)
            size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
            texts = speller.texts(flat, np.concatenate([[0], np.cumsum(size)]).astype(np.int64))
            texts = [None if null else t for t, null in zip(texts, col.is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, text_col])

    return df.mapInArrow(run, schema)
