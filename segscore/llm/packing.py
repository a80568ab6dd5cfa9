"""Best-fit packing by exact-complement hashing.

Documents become token pieces of at most ``capacity`` ids. What decides a
packing is only how many pieces there are of each length, at most ``capacity``
numbers, so the plan is made on that histogram: take the longest length left,
look its gap up among the single, pair and triple sums of lengths still
available, and consume the combination that fills the gap exactly as often as
the counts allow; if none exists, place the longest piece that fits (best fit)
and look again with the smaller gap. Pieces are then dealt to the plan's slots
by their rank within their length, a distributed running count; no task holds
a length's pieces and the driver sees the histogram only.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segscore.llm.common import cut_lineage, keep_until_released, running, texts, with_columns

CAPACITY = 2048
#: Chunks between white space whose ids a worker remembers.
REMEMBERED = 200_000


# ------------------------------------------------------------ tokenising
def byte_letters() -> dict[int, str]:
    """The printable letter that a byte-level vocabulary writes for each byte:
    printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)}


#: What is not printable ASCII or a Latin letter, up to the end of its line: such chunks may need
#: Unicode normalisation, or fold one letter to several.
_ODD = re.compile(r"(?:[^\n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]|<\|)[^\n]*")
#: The vocabulary's units in other chunks, in lower case, and the ends of chunks.
_UNITS = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+|[0-9]|[!-/:-`{-~]+")
#: Bytes of text taken at once, and of a chunk that its hash tells apart.
WINDOW = 1 << 20
LONGEST = 64
_BLANKS = re.compile(rb"[\x20\x09-\x0d]")
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
_LETTER = np.where(_BLANK, np.uint64(0), np.random.default_rng(8).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1))
_PLACE = np.random.default_rng(9).integers(1, 1 << 63, LONGEST + 1, np.uint64) * np.uint64(2) + np.uint64(1)
#: Units that go to the vocabulary's model in one string.
TOGETHER = 2000


class Tokens:
    """chunk between white space -> little-endian unsigned 32-bit ids.

    The tokenizer drops white space and never joins across it, so a text's ids
    are its chunks' ids one after another. The units of plain chunks go to the
    tokenizer's model many at once, already split and written in its byte
    letters; a unit ends where a token ends a word. Any other chunk goes
    through the whole tokenizer. Two generations of chunks are remembered:
    what is not seen again is forgotten."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.known: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer.from_file(path)
        self.model.normalizer = normalizers.Sequence([])
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.letters = {b: c for b, c in byte_letters().items() if c != chr(b) and b != 0x20}  # blanks part the units
        self.units: dict[str, bytes] = {}
        self.older_units: dict[str, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def learn(self, chunks: set[bytes]) -> None:
        """Makes every chunk known; all new ones are taken apart at once, a line each."""
        known, older, units = self.known, self.older, self.units
        again = older.keys() & chunks
        known.update(zip(again, map(older.__getitem__, again)))
        new = list(chunks - again)
        if not new:
            return
        text = b"\n".join(new).decode("utf-8", "replace")
        odd = [m.start() for m in _ODD.finditer(text)]
        if odd:
            lines = text.split("\n")
            first = np.cumsum([0, *map(len, lines)]) + np.arange(len(lines) + 1)
            apart = set((np.searchsorted(first, odd, "right") - 1).tolist())
            for i in apart:
                known[new[i]] = np.array(self.tokenizer.encode(lines[i], add_special_tokens=False).ids, "<u4").tobytes()
            new = [c for i, c in enumerate(new) if i not in apart]
            if not new:
                return
            text = "\n".join([x for i, x in enumerate(lines) if i not in apart])
        parts = _UNITS.findall(text.lower())
        needed = set(parts)
        needed.discard("\n")
        if len(units) + len(needed) > REMEMBERED:
            self.older_units, self.units = units, {}
            units = self.units
        needed -= units.keys()
        again = needed & self.older_units.keys()
        units.update(zip(again, map(self.older_units.__getitem__, again)))
        self.encode(list(needed - again), units)
        ids = list(map(units.get, parts))  # None ends a chunk
        ends = [i for i, x in enumerate(ids) if x is None]
        ends.append(len(ids))
        at = 0
        for c, end in zip(new, ends):
            known[c] = ids[at] if end - at == 1 else b"".join(ids[at:end])
            at = end + 1

    def encode(self, new: list[str], units: dict[str, bytes]) -> None:
        """The ids of lower-case units, straight from the vocabulary's model."""
        plain = [u for u in new if u.isascii()]
        new = plain + [u for u in new if not u.isascii()]
        for i in [*range(0, len(plain), TOGETHER), *range(len(plain), len(new), TOGETHER)]:
            some = new[i:min(i + TOGETHER, len(plain) if i < len(plain) else len(new))]
            written = " ".join(some)
            if i >= len(plain):
                written = written.encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.model.encode_batch_fast([written], add_special_tokens=False)[0].ids, "<u4")
            end = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(end) != len(some):
                raise ValueError("the vocabulary does not end every unit with a word end")
            raw = ids.tobytes()
            units.update(zip(some, [raw[x:y] for x, y in zip([0, *end], end)]))

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text. Long texts are taken in windows that end at white space."""
        if sum(map(len, texts)) > 2 * WINDOW:
            return [b"".join(self.window(w)[0].tobytes() for w in windows(t)) for t in texts]
        tokens, first, at = self.window(b" ".join(texts))
        edge = np.cumsum([0, *(len(t) + 1 for t in texts)])
        cut = at[np.searchsorted(first, edge)].tolist()
        return [tokens[x:y].tobytes() for x, y in zip(cut, cut[1:])]

    def window(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of ``raw``, where its chunks begin, and each chunk's first id
        (one more at the end). Chunks are told apart by a 64-bit hash of their
        bytes and length, those of more than ``LONGEST`` bytes by themselves."""
        data = np.frombuffer(raw, np.uint8)
        blank = _BLANK[data]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(data) and not blank[0]:
            edge = np.r_[0, edge]
        if len(edge) % 2:
            edge = np.r_[edge, len(data)]
        first, size = edge[::2], edge[1::2] - edge[::2]
        if not len(first):
            return np.zeros(0, "<u4"), first, np.zeros(1, np.int64)
        inside = np.arange(first[0], len(data)) - np.repeat(first, np.diff(np.r_[first, len(data)]))
        part = _LETTER[data[first[0]:]]
        part *= _PLACE[np.minimum(inside, LONGEST)]
        key = np.add.reduceat(part, first - first[0]) + size.astype(np.uint64) * _PLACE[0]
        long_ = np.flatnonzero(size > LONGEST)
        key[long_] = np.arange(len(long_), dtype=np.uint64)
        _, one, which = np.unique(key, return_index=True, return_inverse=True)
        chunks = [raw[x:x + n] for x, n in zip(first[one].tolist(), size[one].tolist())]
        found = list(map(self.known.get, chunks))
        new = {c for c, x in zip(chunks, found) if x is None}
        if new:
            if len(self.known) + len(new) > REMEMBERED:  # a new generation begins
                self.older, self.known = self.known, {}
            self.learn(new)
            found = [self.known[c] if x is None else x for c, x in zip(chunks, found)]
        ids = np.frombuffer(b"".join(found), "<u4")
        many = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = (np.cumsum(many) - many)[which]
        many = many[which]
        at = np.r_[0, np.cumsum(many)]
        return ids[np.repeat(begin - at[:-1], many) + np.arange(at[-1])], first, at


def windows(text: bytes, size: int | None = None) -> Iterator[bytes]:
    """Pieces of about ``size`` bytes that end at white space; a longer chunk stays whole."""
    size, lo = size or WINDOW, 0
    while len(text) - lo > size:
        m = _BLANKS.search(text, lo + size)
        hi = m.start() if m else len(text)
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


@functools.lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    """One coder a worker process and vocabulary, kept until another operator's task releases it."""
    keep_until_released(tokens.cache_clear)
    return Tokens(path)


def coded(coder: Tokens, documents: list[bytes], together: int = 1 << 19) -> Iterator[bytes]:
    """The ids of each document, documents of about ``together`` bytes at once."""
    held, size = [], 0
    for t in documents:
        held.append(t)
        size += len(t)
        if size >= together:
            yield from coder.ids(held)
            held, size = [], 0
    yield from coder.ids(held)


def pieces(df: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """``(row, doc, piece, start, length, ids_crc32[, ids])`` of every text: its
    ids, then ``end_id``, cut every ``capacity``."""
    schema = "row long, doc long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens(tokenizer)
        for b in batches:
            rows = {"row": [], "doc": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            for row, doc, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), coded(coder, texts(b.column(2)))):
                ids += end
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows["row"].append(row)
                    rows["doc"].append(doc)
                    rows["piece"].append(p)
                    rows["start"].append(at // 4)
                    rows["length"].append(len(part) // 4)
                    rows["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        rows["ids"].append(part)
            if not with_ids:
                del rows["ids"]
            kinds = {"piece": pa.int32(), "ids": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int64())) for c, v in rows.items()], names=list(rows))

    return df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc"),
                     F.col(text_col).alias("text")).mapInArrow(cut, schema)


# ------------------------------------------------------------------ plan
class Sums:
    """Single, pair and triple sums of the lengths that are still available."""

    def __init__(self, count: np.ndarray):
        self.count = count

    def pair(self, gap: int, taken: Counter | None = None) -> tuple[int, int] | None:
        """Two available lengths that add up to ``gap``, the longer as long as possible."""
        if gap < 2:
            return None
        left = self.count if not taken else self.minus(taken)
        a = np.arange(gap - 1, (gap + 1) // 2 - 1, -1)
        b = gap - a
        good = (left[a] > 0) & (left[b] > 0) & ((a != b) | (left[a] > 1))
        i = int(np.argmax(good)) if len(good) else 0
        return (int(a[i]), int(b[i])) if len(good) and good[i] else None

    def minus(self, taken: Counter) -> np.ndarray:
        left = self.count.copy()
        for x, n in taken.items():
            left[x] -= n
        return left

    def fill(self, gap: int, taken: Counter) -> tuple[int, ...] | None:
        """One, two or three lengths that fill ``gap`` exactly, beside ``taken``."""
        left = self.minus(taken)
        if left[gap] > 0:
            return (gap,)
        two = self.pair(gap, taken)
        if two:
            return two
        for a in np.flatnonzero(left[:gap - 1] > 0)[::-1].tolist():
            if 3 * a < gap:
                break
            two = self.pair(gap - a, taken + Counter([a]))
            if two and two[0] <= a:
                return (a, *two)
        return None


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Sequences to build: (lengths of one sequence, how many such). Uses every
    piece of ``histogram`` exactly once."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    sums = Sums(count)
    out = []
    top = capacity
    while True:
        while top and not count[top]:
            top -= 1
        if not top:
            return out
        taken, gap = Counter([top]), capacity - top
        while gap:
            exact = sums.fill(gap, taken)
            if exact:
                taken.update(exact)
                break
            left = sums.minus(taken)[:gap + 1]
            fits = np.flatnonzero(left > 0)
            if not len(fits):
                break
            taken[int(fits[-1])] += 1
            gap -= int(fits[-1])
        times = min(int(count[x]) // n for x, n in taken.items())
        for x, n in taken.items():
            count[x] -= n * times
        out.append((taken, times))


def slots(packing: list[tuple[Counter, int]]) -> np.ndarray:
    """Slot ranges by (length, first rank): columns length, first rank, first
    sequence, pieces of the length in one sequence, offset of the first."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for lengths, times in packing:
        offset = 0
        for x in sorted(lengths, reverse=True):
            n = lengths[x]
            rows.append((x, used[x], sequence, n, offset))
            used[x] += n * times
            offset += n * x
        sequence += times
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


# --------------------------------------------------------------- operator
def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids])``
    of every piece of every row of ``df``; ``ids`` are little-endian unsigned
    32-bit token ids.

    Null and empty texts give one piece that holds ``end_id`` alone. Only texts
    of more than ``capacity`` ids are cut. Ids may be null or repeat: a row is
    packed as often as it occurs. Other columns are ignored. An empty table
    gives no rows."""
    p = cut_lineage(pieces(df, tokenizer, id_col, text_col, capacity, end_id, with_ids))
    histogram = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    where = slots(plan(histogram, capacity))
    ranked = running(p.withColumn("one", F.lit(1)), ["length"], [F.col("row"), F.col("piece")], "one", "rank").drop("one", "row")
    names = ranked.columns
    at = {c: i for i, c in enumerate(names)}
    shared = df.sparkSession.sparkContext.broadcast(where)  # bounded by the lengths, not by the pieces

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        key = table[:, 0] << 44 | table[:, 1]
        for b in batches:
            length = b.column(at["length"]).to_numpy()
            rank = b.column(at["rank"]).to_numpy()
            row = table[np.searchsorted(key, length << 44 | rank, "right") - 1] if len(length) else table[:0]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(row[:, 2] + nth // np.maximum(row[:, 3], 1)),
                 pa.array(row[:, 4] + nth % np.maximum(row[:, 3], 1) * length)], names=[*names, "sequence_id", "offset"])

    placed = ranked.mapInArrow(place, with_columns(ranked, sequence_id="long", offset="long"))
    return placed.select(F.col("doc").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                         *(["ids"] if with_ids else []))
