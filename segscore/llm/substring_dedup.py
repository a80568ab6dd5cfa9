"""Repeated-substring removal over all texts as bytes, by sampled suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier
(smaller id, or the same id and an earlier start). The sorting of every suffix
is induced from a sample of suffixes, as induced sorting does it, but the
sample is taken so that matches of ``LENGTH`` bytes can be read off it alone:

* Sample: in every window of ``LENGTH`` bytes the suffix whose first ``GRAM``
  bytes have the least hash (leftmost on ties) is sampled. Equal windows sample
  the same suffix at the same distance, so each window hangs on one sampled
  suffix and about one suffix in thirty is carried.
* Tuples: a sampled suffix travels as (hash of its first bytes, hash of the
  whole context that its windows span, id, run of windows). Tuples are
  shuffled by hash (spilled by Spark) and sorted there. A hash that a task holds
  in ``HOT`` contexts or more it deals by (hash, context) instead, and marks the
  hash's own group: so one hash brings a group fewer than ``HOT`` tuples a task.
* Induction: suffixes with equal contexts have all their windows in common, so
  every one but the first passes its whole run on as repeated. Where a group
  has several contexts, common prefixes are shorter than the context: only the
  first of each context sends its windows, one by one, into a second round of
  the same sort keyed by the window itself. Where a task dealt a hash by context,
  the first of each context always does, so tuples that did not meet still do there.

Before each shuffle a task keeps the first tuple of each key and settles the
rest itself, so a passage that a third of the texts share sends one tuple a
task. Texts are dealt by id twice, to cut the asked windows and the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segscore.llm.common import cut_lineage, shuffle_partitions, text_slices

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM  # a window's sampled suffix starts 0..SPAN bytes after the window
#: Bytes that are hashed at once; a longer text is cut into overlapping segments.
SLICE = 1 << 20
#: Bytes of text whose tuples a task gathers before it sends them.
GATHERED = 24 << 20
#: Bytes of text for each group of the shuffles.
GROUP = 16 << 20
#: A task deals a hash by context from this many contexts on.
HOT = 16

_U = np.uint64
_POS_BITS = 28
_POS = _U((1 << _POS_BITS) - 1)
_BASE = 0x9E3779B97F4A7C15
_LAST_ID = (1 << 63) - 1


def _powers(b: int, n: int) -> np.ndarray:
    x = np.full(n, b, np.uint64)
    x[0] = 1
    return np.multiply.accumulate(x)


class _Roll:
    """Random byte values and powers of the rolling hash, made once a process."""

    size = SLICE + 4 * LENGTH
    made: tuple | None = None

    @classmethod
    def tables(cls):
        if cls.made is None:
            value = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)
            cls.made = value, _powers(_BASE, cls.size + 1), _powers(pow(_BASE, -1, 1 << 64), cls.size + 1)
        return cls.made


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    value, up, _ = _Roll.tables()
    s = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(value[raw] * up[:len(raw)], out=s[1:])
    return s


def hash_between(s: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return (s[hi] - s[lo]) * _Roll.tables()[2][lo]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    step = 1
    while 2 * step <= w:
        x = np.minimum(x[:len(x) - step], x[step:])
        step *= 2
    return np.minimum(x[:len(x) - (w - step)], x[w - step:]) if w > step else x


def sampled(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """The sampled suffixes of texts that lie one after another: (text number,
    suffix start, first and last window start that hang on it, hash of its
    first bytes, hash of its context); starts count from the text's start."""
    if len(at) == 2 and len(raw) > SLICE:
        return _long(raw)
    n = len(raw)
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    if n < LENGTH:
        return none
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = np.flatnonzero(text[:n - LENGTH + 1] == text[LENGTH - 1:])
    if not len(inside):
        return none
    s = prefix_sums(raw)
    start = np.arange(n - GRAM + 1)
    h = mixed((s[GRAM:] - s[:-GRAM]) * _Roll.tables()[2][:n - GRAM + 1])
    least = sliding_min((h & ~_POS) | start.astype(np.uint64), SPAN + 1)
    a = (least[inside] & _POS).astype(np.int64)
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    lo, hi, a = inside[first], inside[np.r_[first[1:], len(inside)] - 1], a[first]
    t = text[a]
    left, right = np.maximum(a - SPAN, at[t]), np.minimum(a + LENGTH, at[t + 1])
    context = mixed(hash_between(s, left, right) + (a - left).astype(np.uint64) * _U(0xA24BAED4963EE407)
                    + (right - a).astype(np.uint64) * _U(0x9FB21C651E98DF25))
    return t, a - at[t], lo - at[t], hi - at[t], h[a], context


def _long(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """``sampled`` of one long text, segment by segment; a suffix whose windows
    lie in two segments comes out once."""
    parts = []
    for s0 in range(0, len(raw), SLICE // 2):
        s1 = s0 + SLICE // 2
        b0, b1 = max(0, s0 - SPAN), min(len(raw), s1 + 2 * LENGTH)
        t, a, lo, hi, h, c = sampled(raw[b0:b1], np.array([0, b1 - b0]))
        lo, hi = np.maximum(lo + b0, s0), np.minimum(hi + b0, s1 - 1)
        k = lo <= hi
        parts.append((t[k], a[k] + b0, lo[k], hi[k], h[k], c[k]))
    t, a, lo, hi, h, c = (np.concatenate(x) for x in zip(*parts))
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    last = np.r_[first[1:], len(a)] - 1 if len(a) else first
    return t[first], a[first], lo[first], hi[last], h[first], c[first]


# ---------------------------------------------------------------- payloads
def packed(columns: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def unpacked(payloads, kinds: list[str]) -> list[np.ndarray]:
    """Columns of several payloads, joined."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    parts = []
    reader = zstandard.ZstdDecompressor()
    for p in payloads:
        raw = reader.decompress(p)
        n, at, cols = len(raw) // width, 0, []
        for k in kinds:
            cols.append(np.frombuffer(raw, k, n, at))
            at += n * np.dtype(k).itemsize
        parts.append(cols)
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


#: A tuple: key, context (or the rest of the key), id, text check, suffix start, first window, windows - 1.
TUPLE = ["<u8", "<u8", "<i8", "<i4", "<i4", "<i4", "<i4"]
#: A run of window starts: id, text check, first and last.
RUN = ["<i8", "<i4", "<i4", "<i4"]


def runs_joined(doc, check, lo, hi):
    """Adjacent and overlapping runs of a text made one."""
    if not len(doc):
        return doc, check, lo, hi
    o = np.lexsort((lo, check, doc))
    doc, check, lo, hi = doc[o], check[o], lo[o], hi[o]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (check[1:] != check[:-1])]
    text = np.cumsum(new) - 1
    reach = np.maximum.accumulate(hi.astype(np.int64) + text * (1 << 33)) - text * (1 << 33)
    first = new.copy()
    first[1:] |= lo[1:] > reach[:-1] + 1
    at = np.flatnonzero(first)
    return doc[at], check[at], lo[at], np.maximum.reduceat(hi, at)


def dealt(keys: np.ndarray, groups: int, kind: int, columns: list[np.ndarray]) -> tuple[list, list, list]:
    """Rows (group, kind, payload) of columns dealt by key."""
    to = (keys % _U(groups)).astype(np.int64)
    o = np.argsort(to, kind="stable")
    to = to[o]
    first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else []
    last = np.r_[first[1:], len(to)] if len(to) else []
    return ([int(to[i]) for i in first], [kind] * len(first),
            [packed([c[o[i:j]] for c in columns]) for i, j in zip(first, last)])


def doc_key(doc: np.ndarray, check: np.ndarray) -> np.ndarray:
    return mixed(doc.astype(np.int64).view(np.uint64) ^ (check.astype(np.int64).view(np.uint64) << _U(20)))


def text_check(column) -> np.ndarray:
    return column.to_numpy().astype(np.uint32).view(np.int32)


ROWS = pa.schema([("grp", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
ROWS_SQL = "grp long, kind int, payload binary"
#: SPLIT: tuples dealt by (hash, context); MARKED: their hashes, dealt as SEND.
SEND, REPEATED, ASKED, SPLIT, MARKED = 0, 1, 2, 3, 4


def table(*parts: tuple[list, list, list]) -> pa.Table:
    cols = [sum(x, []) for x in zip(*parts)]
    return pa.table({"grp": cols[0], "kind": pa.array(cols[1], pa.int32()), "payload": pa.array(cols[2], pa.binary())}, schema=ROWS)


def ordered(key, rest, doc, start):
    """Order by key, rest, (id, start), and where a (key, rest) begins."""
    o = np.lexsort((start, doc, rest, key))
    key, rest = key[o], rest[o]
    new = np.r_[True, (key[1:] != key[:-1]) | (rest[1:] != rest[:-1])] if len(o) else np.zeros(0, bool)
    return o, new


def later(doc, start, new) -> np.ndarray:
    """Which sorted tuples start after the first of their (key, rest)."""
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, np.int64)
    return (doc != doc[head]) | (start != start[head])


def sent(tuples: list[np.ndarray], groups: int) -> pa.Table:
    """A task's tuples: the first of each (key, rest) goes to the key's group,
    or if the key is hot to that of (key, rest); runs of all later ones are
    known to be repeated."""
    o, new = ordered(*tuples[:3], tuples[4])
    t = [c[o] for c in tuples]
    after = later(t[2], t[4], new)
    one = ~after
    repeat = runs_joined(t[2][after], t[3][after], t[5][after], t[5][after] + t[6][after])
    keep = [c[one] for c in t]
    hashes, which, n = np.unique(keep[0], return_inverse=True, return_counts=True)
    hot = (n >= HOT)[which]
    marked = hashes[n >= HOT]
    back = np.lexsort((keep[4], keep[2]))  # by text: neighbouring ids compress well
    stay, split = ([c[back[k[back]]] for c in keep] for k in (~hot, hot))
    return table(dealt(stay[0] >> _U(8), groups, SEND, stay), dealt(mixed(split[0] ^ mixed(split[1])), groups, SPLIT, split),
                 dealt(marked >> _U(8), groups, MARKED, [marked]), dealt(doc_key(*repeat[:2]), groups, REPEATED, list(repeat)))


def settled(rows: pa.Table, texts: int, windows: bool) -> pa.Table:
    """A group of the sort: runs that are repeated and, in the first round, the
    first suffix of each context where a hash has several or is hot in a task."""
    kind = rows.column("kind").to_numpy()
    payload = rows.column("payload").to_pylist()
    t, split = (unpacked([p for p, k in zip(payload, kind) if k == one], TUPLE) for one in (SEND, SPLIT))
    done = unpacked([p for p, k in zip(payload, kind) if k == REPEATED], RUN)
    marked = unpacked([p for p, k in zip(payload, kind) if k == MARKED], ["<u8"])[0]
    marked = np.unique(np.concatenate([marked, split[0]]))
    t = [np.concatenate(c) for c in zip(t, split)]
    o, new = ordered(*t[:3], t[4])
    t = [c[o] for c in t]
    after = later(t[2], t[4], new)
    run = [np.concatenate([a, b[after]]) for a, b in zip(done, (t[2], t[3], t[5], t[5] + t[6]))]
    out = [runs_joined(*run)]
    parts = [dealt(doc_key(*out[0][:2]), texts, REPEATED, list(out[0]))]
    if not windows:
        key = t[0]
        group = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1 if len(key) else np.zeros(0, np.int64)
        several = np.bincount(group[new], minlength=1)[group] > 1 if len(key) else np.zeros(0, bool)
        ask = (several | np.isin(key, marked)) & ~after
        asked = runs_joined(t[2][ask], t[3][ask], t[5][ask], t[5][ask] + t[6][ask])
        parts.append(dealt(doc_key(*asked[:2]), texts, ASKED, list(asked)))
    return table(*parts)


def window_tuples(raw: np.ndarray, at: np.ndarray, text, lo, hi) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, hash) of every window of the runs ``lo..hi``."""
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    cut = SLICE // 2
    over = np.flatnonzero(hi - lo >= cut)
    if len(over):  # a run longer than a slice is asked for in pieces
        more = [(t, x, min(x + cut - 1, h)) for t, l, h in zip(text[over], lo[over], hi[over]) for x in range(l, h + 1, cut)]
        rest = np.delete(np.arange(len(text)), over)
        text, lo, hi = (np.concatenate([c[rest], np.array(x, np.int64)]) for c, x in zip((text, lo, hi), zip(*more)))
    out = []
    size = hi - lo + LENGTH
    end = np.cumsum(size)
    i = 0
    while i < len(text):
        base = end[i] - size[i]
        j = max(i + 1, int(np.searchsorted(end, base + SLICE, "right")))
        n = size[i:j]
        offset = np.cumsum(n) - n
        run = np.repeat(np.arange(len(n)), n)
        within = np.arange(int(n.sum())) - offset[run]
        piece = raw[at[text[i:j]][run] + lo[i:j][run] + within]
        good = np.flatnonzero(within < (n - LENGTH + 1)[run])
        s = prefix_sums(piece)
        out.append((text[i:j][run[good]], lo[i:j][run[good]] + within[good], mixed(hash_between(s, good, good + LENGTH))))
        i = j
    return tuple(np.concatenate(x) for x in zip(*out))


# ---------------------------------------------------------------- operator
def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, spans, kept)`` for each row: the length of its UTF-8
    text, its removed runs as an array of (start, end) in bytes, end exclusive,
    and the remaining bytes.

    Null texts are empty; texts below ``LENGTH`` bytes lose nothing. A string's
    place is (id, start): rows that repeat an id do not count as earlier than
    each other at equal starts. Null ids count as one id after all others.
    Other columns are ignored; an empty table gives an empty result."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("doc"),
                     F.crc32(text.cast("binary")).alias("chk"),
                     F.col(id_col).isNull().alias("no_id"), text.alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(shuffle_partitions(spark), -(-total // GROUP))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            doc, chk = b.column(0).to_numpy(), text_check(b.column(1))
            for first, _, raw, at in text_slices(b.column(2), limit=SLICE):
                t, a, lo, hi, h, c = sampled(raw, at)
                if len(t):
                    held.append([h, c, doc[first + t], chk[first + t], a.astype("<i4"), lo.astype("<i4"), (hi - lo).astype("<i4")])
                size += len(raw)
                if size >= GATHERED:
                    if held:
                        yield from sent([np.concatenate(x) for x in zip(*held)], groups).to_batches()
                    held, size = [], 0
        if held:
            yield from sent([np.concatenate(x) for x in zip(*held)], groups).to_batches()

    tuples = docs.select("doc", "chk", "text").mapInArrow(find, ROWS_SQL)
    first = cut_lineage(tuples.groupBy("grp").applyInArrow(lambda t: settled(t, groups, False), ROWS_SQL))
    names = [*docs.columns, "grp"]
    dealt_docs = docs.withColumn("grp", F.lit(None).cast("long"))  # the number that payloads for a text are dealt by

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chk = text_check(b.column(1))
            grp = (doc_key(b.column(0).to_numpy(), chk) % _U(groups)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(grp)], names=names)

    dealt_docs = dealt_docs.mapInArrow(number, dealt_docs.schema)

    def lookup(left: pa.Table, right: pa.Table, kinds: set[int]):
        """Texts of the group and, per text number, the runs sent to it."""
        doc = left.column("doc").to_numpy()
        chk = text_check(left.column("chk"))
        sent_to = [p for p, k in zip(right.column("payload").to_pylist(), right.column("kind").to_pylist()) if k in kinds]
        r = runs_joined(*unpacked(sent_to, RUN))
        place = {}
        if len(r[0]):
            new = np.flatnonzero(np.r_[True, (r[0][1:] != r[0][:-1]) | (r[1][1:] != r[1][:-1])])
            for i, j in zip(new.tolist(), np.r_[new[1:], len(r[0])].tolist()):
                place[int(r[0][i]), int(r[1][i])] = (i, j)
        return doc, chk, r, place

    def ask(left, right):
        doc, chk, r, place = lookup(left, right, {ASKED})
        held = []
        seen = set()
        column = left.column("text").combine_chunks() if left.num_rows else pa.array([], pa.string())
        for f, e, raw, at in text_slices(column, limit=SLICE):
            text_no, lo, hi = [], [], []
            for i in range(f, e):
                key = (int(doc[i]), int(chk[i]))
                if key in place and key not in seen:
                    seen.add(key)
                    x, y = place[key]
                    text_no.append(np.full(y - x, i - f))
                    lo.append(r[2][x:y].astype(np.int64))
                    hi.append(r[3][x:y].astype(np.int64))
            if text_no:
                t, p, h = window_tuples(raw, at, np.concatenate(text_no), np.concatenate(lo), np.concatenate(hi))
                zero = np.zeros(len(t), "<i4")
                held.append([h, np.zeros(len(t), "<u8"), doc[f + t], chk[f + t], p.astype("<i4"), p.astype("<i4"), zero])
        return sent([np.concatenate(x) for x in zip(*held)], groups) if held else ROWS.empty_table()

    asked = dealt_docs.groupBy("grp").cogroup(first.filter(F.col("kind") == ASKED).groupBy("grp")).applyInArrow(ask, ROWS_SQL)
    second = cut_lineage(asked.groupBy("grp").applyInArrow(lambda t: settled(t, groups, True), ROWS_SQL))

    def cut(left, right):
        doc, chk, r, place = lookup(left, right, {REPEATED})
        ids, n_bytes, spans, kept = [], [], [], []
        column = left.column("text").combine_chunks() if left.num_rows else pa.array([], pa.string())
        no_id = left.column("no_id").to_pylist()
        for f, e, raw, at in text_slices(column, limit=SLICE):
            for i in range(f, e):
                b = raw[at[i - f]:at[i - f + 1]]
                x, y = place.get((int(doc[i]), int(chk[i])), (0, 0))
                # runs of window starts to runs of bytes; those that touch become one
                starts, ends = r[2][x:y].astype(np.int64), r[3][x:y].astype(np.int64) + LENGTH
                new = np.r_[True, starts[1:] > ends[:-1]][:len(starts)]
                starts, ends = starts[new], (ends[np.r_[np.flatnonzero(new)[1:] - 1, len(ends) - 1]] if len(ends) else ends)
                stay = np.ones(len(b), bool)
                for s, t in zip(starts, ends):
                    stay[s:t] = False
                ids.append(None if no_id[i] else int(doc[i]))
                n_bytes.append(len(b))
                spans.append([{"start": int(s), "end": int(t)} for s, t in zip(starts, ends)])
                kept.append(b[stay].tobytes())
        return pa.table({"id": pa.array(ids, pa.int64()), "n_bytes": pa.array(n_bytes, pa.int64()),
                         "spans": pa.array(spans, SPANS), "kept": pa.array(kept, pa.binary())})

    runs = first.unionByName(second).filter(F.col("kind") == REPEATED)
    out = dealt_docs.groupBy("grp").cogroup(runs.groupBy("grp")).applyInArrow(
        cut, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return out.withColumnRenamed("id", id_col)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
