"""Language-model scores by a hierarchical Pitman-Yor model, sampled on Spark.

Every context of two words is a restaurant whose tables are customers of the
restaurant of its last word; the tables of those are customers of the root,
which all contexts share, and whose base is uniform. Seats are sampled by
Gibbs steps: a customer leaves and sits down again, at a table in proportion
to its customers less the discount, or at a new table in proportion to what
the parent expects.

The corpus is cut into chunks of whole texts. A chunk asks the owners of its
words for their numbers (common words have small ones) and their counts, then
sends its distinct trigrams with their training counts, packed, to shards by
the context's last word; so a context and its parent lie together, and a hot
trigram comes once a chunk. A first round in the shards gives the root's
customers, which the words' owners seat; a second round samples again over the
new root and averages the predictive probabilities. The shards answer every
chunk's trigrams in order, and the chunk adds up its texts. A shard that grew
far beyond the others is split by the word that follows; its parts exchange
their restaurants' totals.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segscore.llm.common import Scratch, texts
from segscore.llm.langid import held_out

#: Bytes of text in a chunk, for which there is one shard, and one owner of words.
CHUNK_BYTES = 10 << 20
SHARD_BYTES = 8 << 20
OWNER_BYTES = 64 << 20
#: Trigrams of a shard beyond which it is split (counted once a chunk).
SHARD_MOST = 3_000_000
#: Customers of one dish that sit in one wing of a restaurant, and customers seated at once.
WING = 256
AT_ONCE = 1 << 21
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = b""  # no word is empty


@dataclass(frozen=True)
class Setting:
    """Discount and strength of the root, of one word, of two words; sweeps
    of the first round, sweeps that only warm up and sweeps that are averaged."""
    discount: tuple[float, float, float] = (0.5, 0.7, 0.8)
    strength: tuple[float, float, float] = (1.0, 1.0, 1.0)
    first: int = 1
    warm: int = 1
    kept: int = 2
    seed: int = 12


# ----------------------------------------------------------------- seating
def seat_some(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator, passes: int) -> np.ndarray:
    """Tables of dishes with ``c`` customers (descending, 2 or more): all sit
    down in turn, then each leaves and sits down again, ``passes`` times. ``a``
    is the weight of a new table. One step moves one customer of every dish."""
    first = np.r_[0, np.cumsum(c)[:-1]]
    label = np.zeros(int(c.sum()), np.int32)  # table of a customer, counted inside its dish
    size = np.zeros(len(label), np.int32)
    free = (np.arange(len(label)) - np.repeat(first, c)).astype(np.int32)  # numbers that no table has, c - t of them
    t = np.zeros(len(c), np.int64)
    active = np.searchsorted(-c, -np.arange(int(c[0])), "left")  # dishes with more than s customers
    for again in range(passes + 1):
        for s in range(int(c[0])):
            m = int(active[s])
            at, others = first[:m], (c[:m] - 1 if again else np.full(m, s))
            if again:
                left = at + label[at + s]
                size[left] -= 1
                gone = np.flatnonzero(size[left] == 0)
                t[gone] -= 1
                free[at[gone] + c[gone] - t[gone] - 1] = label[at[gone] + s]
            fresh = rng.random(m) * (a[:m] + others - d * t[:m]) < a[:m]
            stay = np.flatnonzero(~fresh)
            while len(stay):  # another customer's table, accepted with (size - d) / size
                pick = (rng.random(len(stay)) * others[stay]).astype(np.int64)
                if again:
                    pick += pick >= s
                base = at[stay]
                k = label[base + pick]
                n = size[base + k]
                ok = rng.random(len(stay)) * n < n - d
                ok |= t[stay] == 1  # the only table: nothing to weigh
                label[base[ok] + s] = k[ok]
                size[base[ok] + k[ok]] += 1
                stay = stay[~ok]
            new = np.flatnonzero(fresh)
            slot = free[at[new] + c[new] - t[new] - 1]
            t[new] += 1
            label[at[new] + s] = slot
            size[at[new] + slot] = 1
    return t


def seat(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator, passes: int = 1) -> np.ndarray:
    """Tables by dish. A dish of more than ``WING`` customers sits in several
    wings that share its new-table weight, so work is even and memory bounded."""
    out = np.minimum(c, 1)
    many = np.flatnonzero(c > 1)
    if not len(many):
        return out
    wings = -(-c[many] // WING)
    owner = np.repeat(many, wings)
    nth = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(wings)[:-1]], wings)
    share = np.repeat(wings, wings)
    customers = c[owner] // share + (nth < c[owner] % share)
    weight = np.maximum(a[owner] / share, 1e-300)
    order = np.argsort(-customers, kind="stable")
    owner, customers, weight = owner[order], customers[order], weight[order]
    tables = np.ones(len(owner))
    total = np.cumsum(customers)
    lo = 0
    while lo < len(owner) and customers[lo] > 1:
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + AT_ONCE, "right")))
        hi = min(hi, int(np.searchsorted(-customers, -1, "left")))
        tables[lo:hi] = seat_some(customers[lo:hi], weight[lo:hi], d, rng, passes)
        lo = hi
    out[many] = np.bincount(owner, tables, minlength=len(c))[many].astype(out.dtype)
    return out


# ------------------------------------------------------------------ packing
def packed(*x) -> bytes:
    """Zstandard over a pickle; whole arrays go byte plane by byte plane, so small numbers cost little."""
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps([_planes(v) if isinstance(v, np.ndarray) else v for v in x], 5))


def unpacked(x: bytes) -> list:
    return [_whole(v) if isinstance(v, _Planes) else v for v in pickle.loads(zstandard.ZstdDecompressor().decompress(x))]


@dataclass
class _Planes:
    kind: str
    rows: np.ndarray


def _planes(x: np.ndarray) -> _Planes:
    if x.dtype.kind == "i" and (not x.size or x.min() >= 0):
        kind = x.dtype.str
        x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
    else:
        kind = x.dtype.str
    return _Planes(kind, np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T))


def _whole(p: _Planes) -> np.ndarray:
    flat = np.ascontiguousarray(p.rows.T)
    size = np.dtype(p.kind).itemsize
    own = p.kind if flat.shape[1] == size else f"<u{flat.shape[1]}"
    return flat.view(own).ravel().astype(p.kind)


def grouped(of: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(group, its places in ascending order) of the groups that occur."""
    order = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[order], np.arange(n + 1))
    for g in np.flatnonzero(np.diff(ends)).tolist():
        yield g, order[ends[g]:ends[g + 1]]


def spread(number: np.ndarray, parts: int) -> np.ndarray:
    """A part for each number, evenly."""
    x = number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ x >> np.uint64(29)) % np.uint64(parts)).astype(np.int64)


# ------------------------------------------------------------------- chunks
_ROWS = "kind int, place long, chunk long, n long, data binary"


def rows_of(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["kind", "place", "chunk", "n", "data"])


def chunk_rows(chunk: int, ids: list, held: list, documents: list[bytes], owners: int) -> list[tuple]:
    """What a chunk keeps (kind 0: its tokens under its own numbers, the most
    frequent first) and what it asks the owners of its words (kind 1)."""
    place: dict[bytes, int] = {_END: 0}
    number = place.setdefault
    flat: list[int] = []
    lengths = []
    for t in documents:
        words = t.translate(_FOLD).split()
        flat += [number(w, len(place)) for w in words]
        flat.append(0)
        lengths.append(len(words) + 1)
    seq = np.array(flat, np.int64)
    del flat
    lengths = np.array(lengths)
    many = np.bincount(seq, minlength=len(place))
    order = np.argsort(-many, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    seq = rank[seq]
    key = np.fromiter((xxhash.xxh64_intdigest(w) for w in place), np.uint64, len(place))[order]
    learn = np.bincount(seq[np.repeat(~np.array(held, bool), lengths)], minlength=len(place))
    rows = [(0, chunk, chunk, 0, packed(ids, held, lengths, seq))]
    for owner, at in grouped((key % np.uint64(owners)).astype(np.int64), owners):
        rows.append((1, owner, chunk, len(at), packed(at, key[at], learn[at])))
    return rows


def chunks(docs: DataFrame, owners: int) -> DataFrame:
    size_of_chunk = CHUNK_BYTES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        ids, held, documents, size = [], [], [], 0
        for b in batches:
            for i, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2))):
                ids.append(i)
                held.append(h)
                documents.append(t)
                size += len(t)
                if size >= size_of_chunk:
                    yield from rows_of(chunk_rows(chunk, ids, held, documents, owners)).to_batches()
                    ids, held, documents, size, chunk = [], [], [], 0, chunk + 1
        if ids:
            yield from rows_of(chunk_rows(chunk, ids, held, documents, owners)).to_batches()

    return docs.mapInArrow(cut, _ROWS)


def numbered(owner: int, owners: int, asks: list[bytes], chunks: list[int]) -> list[tuple]:
    """An owner's answers (kind 1): the number and training count of every word
    asked for; and (kind 2) how many words it knows and their tokens. Its words rank by count; numbers of all owners interleave, so
    they are dense and rise as words get rarer. Number 0 marks a text's start."""
    parts = [unpacked(a) for a in asks]
    key, at = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
    count = np.bincount(at, np.concatenate([p[2] for p in parts])).astype(np.int64)
    order = np.argsort(-count, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    ids = 1 + rank * owners + owner
    rows, lo = [(2, int((count > 0).sum()), -1, int(count.sum()), b"")], 0
    for chunk, p in zip(chunks, parts):
        here = at[lo:lo + len(p[1])]
        lo += len(here)
        rows.append((1, chunk, chunk, len(here), packed(p[0], ids[here], count[here])))
    return rows


def trigrams(seq: np.ndarray, lengths: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (word before last, last word, word) of texts in the order
    of (shard of the last word, last word, word before, word); where each shard
    begins; and of every token its place among them."""
    words, small = renumbered(np.r_[seq, 0], shards)
    shard = spread(words, shards)
    start, small, v = small[-1], small[:-1], len(words)
    first = np.r_[0, np.cumsum(lengths)[:-1]]
    last = np.r_[start, small[:-1]]
    last[first] = start
    before = np.r_[start, last[:-1]]
    before[first] = start
    pair, at = np.unique(last * v + before, return_inverse=True)
    tri, at = np.unique(at * v + small, return_inverse=True)
    up = pair[tri // v]
    return words[np.stack((up % v, up // v, tri % v))], np.searchsorted(shard[up // v], np.arange(shards + 1)), at


def counted(chunk: int, own: bytes, answers: list[bytes], shards: int, n_train: int, n_words: int) -> list[tuple]:
    """What a chunk keeps further (kind 0: its tokens under the common numbers,
    base scores) and its trigrams by shard with their training counts (kind 1)."""
    ids, held, lengths, seq = unpacked(own)
    number, count = np.zeros(int(seq.max()) + 1, np.int64), np.zeros(int(seq.max()) + 1, np.int64)
    for a in answers:
        at, n, c = unpacked(a)
        number[at], count[at] = n, c
    first = np.r_[0, np.cumsum(lengths)[:-1]]
    base = np.add.reduceat(np.log10((count + 1) / (n_train + n_words + 1))[seq], first)
    known = np.add.reduceat((count > 0)[seq].astype(np.int64), first)
    seq = number[seq]
    rows = [(0, chunk, chunk, 0, packed(ids, held, lengths, seq, base, known))]
    three, ends, at = trigrams(seq, lengths, shards)
    learn = np.bincount(at[np.repeat(~np.array(held, bool), lengths)], minlength=three.shape[1])
    for s in np.flatnonzero(np.diff(ends)).tolist():
        lo, hi = int(ends[s]), int(ends[s + 1])
        rows.append((1, s, chunk, hi - lo, trigram_part(lo, None, three[:, lo:hi], learn[lo:hi])))
    return rows


def trigram_part(first: int, where: np.ndarray | None, three: np.ndarray, count: np.ndarray) -> bytes:
    """Trigrams whose last words ascend. ``first`` and ``where`` say where they are among the chunk's."""
    last, run = np.unique(three[1], return_inverse=True)
    return packed(first, where, last, np.diff(run, prepend=0), three[0], three[2], count)


def part_trigrams(data: bytes) -> tuple[int, np.ndarray | None, np.ndarray, np.ndarray]:
    first, where, last, step, before, word, count = unpacked(data)
    return first, where, np.stack((before, last[np.cumsum(step)], word)), count


def split_parts(blobs: DataFrame, wings: dict[int, int]) -> DataFrame:
    """Deals the trigrams of the shards in ``wings`` by the word that follows."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, chunk, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                first, _, three, count = part_trigrams(data)
                rows = [(shard, wing, chunk, trigram_part(first, at, three[:, at], count[at]))
                        for wing, at in grouped(spread(three[2] * 31, wings[shard]), wings[shard])]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i < 3 else pa.binary()) for i in range(4)],
                                                 names=["shard", "wing", "chunk", "data"])

    return blobs.select("shard", "chunk", "data").mapInArrow(split, "shard long, wing long, chunk long, data binary")


# -------------------------------------------------------------------- shard
#: Word numbers below this are looked up in a table; the rarer words beyond it are sorted.
COMMON = 1 << 22


def renumbered(x: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of ``x`` in the order of (shard, number), and ``x``
    as places among them. That is the order of ``trigrams``."""
    rare = np.flatnonzero(x >= COMMON)
    far, at = np.unique(x[rare], return_inverse=True)
    seen = np.zeros(int(min(COMMON, x.max(initial=0) + 1)), bool)
    small = x if not len(rare) else np.where(x < COMMON, x, 0)
    seen[small] = True
    if len(rare) and not (x == 0).any():
        seen[0] = False
    near = np.flatnonzero(seen)
    key = np.concatenate([near, far])
    order = np.lexsort((key, spread(key, shards)))
    rank = np.empty(len(key), np.int64)
    rank[order] = np.arange(len(key))
    table = np.zeros(len(seen), np.int64)
    table[near] = rank[:len(near)]
    out = table[small]
    out[rare] = rank[len(near):][at]
    return key[order], out


def merged(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and places, for arrays made of few ascending runs."""
    order = np.argsort(x, kind="stable")
    y = x[order]
    first = np.r_[True, y[1:] != y[:-1]] if len(y) else np.zeros(0, bool)
    at = np.empty(len(x), np.int64)
    at[order] = np.cumsum(first) - 1
    return y[first], at


class Shard:
    """The contexts of a shard (or of one wing of it): trigrams, the bigrams
    above them, and the seats of both levels."""

    def __init__(self, blobs: list[bytes], setting: Setting, seed: tuple, shards: int):
        parts = [part_trigrams(b) for b in blobs]
        self.spans = [(p[0], p[1], len(p[3])) for p in parts]
        three, count = np.concatenate([p[2] for p in parts], axis=1), np.concatenate([p[3] for p in parts])
        del parts
        self.key, flat = renumbered(three.ravel(), shards)
        three = flat.reshape(3, -1)
        v = len(self.key)
        pair, at = merged(three[1] * v + three[0])
        tri, self.at = merged(at * v + three[2])
        del at, three
        self.pair, self.word = tri // v, tri % v
        self.pair_key = _mixed(self.key[pair % v], self.key[pair // v])
        self.c3 = np.bincount(self.at, count).astype(np.int64)
        last, of_pair = merged(pair // v)
        self.last = of_pair[self.pair]
        self.last_key = self.key[last]
        two, self.up = np.unique(self.last * v + self.word, return_inverse=True)
        self.two_last, self.two_word = two // v, two % v
        self.setting, self.rng = setting, np.random.default_rng([setting.seed, *seed])
        zero = np.zeros
        self.other_c3, self.other_t3 = zero(len(pair)), zero(len(pair))
        self.other_c2, self.other_t2 = zero(len(last)), zero(len(last))
        # at first every dish has one table in each restaurant
        self.t3 = np.minimum(self.c3, 1)
        self.c2 = np.bincount(self.up, self.t3, minlength=len(two)).astype(np.int64)
        self.t2 = np.minimum(self.c2, 1)
        self.sums()

    def sums(self) -> None:
        self.C3 = np.bincount(self.pair, self.c3, minlength=len(self.pair_key)) + self.other_c3
        self.T3 = np.bincount(self.pair, self.t3, minlength=len(self.pair_key)) + self.other_t3
        self.C2 = np.bincount(self.two_last, self.c2, minlength=len(self.last_key)) + self.other_c2
        self.T2 = np.bincount(self.two_last, self.t2, minlength=len(self.last_key)) + self.other_t2

    def local_root(self) -> np.ndarray:
        """The root as this shard alone sees it, a start for the first round."""
        k = np.bincount(self.two_word, self.t2, minlength=len(self.key))
        d, s = self.setting.discount[0], self.setting.strength[0]
        known = k > 0
        return (k - d * known + (s + d * known.sum()) / (known.sum() + 1)) / (s + k.sum())

    def bigrams(self, root: np.ndarray) -> np.ndarray:
        d, s = self.setting.discount[1], self.setting.strength[1]
        r = self.two_last
        return (self.c2 - d * self.t2 + (s + d * self.T2[r]) * root[self.two_word]) / (s + self.C2[r])

    def trigrams(self, two: np.ndarray) -> np.ndarray:
        d, s = self.setting.discount[2], self.setting.strength[2]
        r = self.pair
        return (self.c3 - d * self.t3 + (s + d * self.T3[r]) * two[self.up]) / (s + self.C3[r])

    def sweep(self, root: np.ndarray) -> np.ndarray:
        """Seats both levels anew; the bigrams' probabilities after it."""
        (_, d2, d3), (_, s2, s3) = self.setting.discount, self.setting.strength
        two = self.bigrams(root)
        self.t3 = seat(self.c3, (s3 + d3 * self.T3[self.pair]) * two[self.up], d3, self.rng)
        self.c2 = np.bincount(self.up, self.t3, minlength=len(self.c2)).astype(np.int64)
        self.t2 = seat(self.c2, (s2 + d2 * self.T2[self.two_last]) * root[self.two_word], d2, self.rng)
        self.sums()
        return self.bigrams(root)

    def totals(self) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(kind, restaurants, their customers, their tables): what wings exchange."""
        whole = lambda x: x.astype(np.int64)
        return [(2, self.last_key, whole(self.C2), whole(self.T2)), (3, self.pair_key, whole(self.C3), whole(self.T3))]

    def averaged(self, root: np.ndarray) -> np.ndarray:
        """Mean predictive probability of every trigram over the kept sweeps."""
        for _ in range(self.setting.warm):
            self.sweep(root)
        total = np.zeros(len(self.c3))
        for _ in range(self.setting.kept):
            total += self.trigrams(self.sweep(root))
        return total / self.setting.kept


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for two words."""
    return (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64)).view(np.int64) >> 1 & (1 << 62) - 1


# ----------------------------------------------------------------- operator
#: A wing's return address is shard << 20 | wing; an exchange of restaurants lies at shard << 20 | part.
_WING = 20


def first_round(m: Shard, address: int, owners: int, wings: int) -> list[tuple]:
    """The root's customers to the words' owners (kind 1) and, of a split
    shard, the restaurants' totals (kinds 2 and 3)."""
    for _ in range(m.setting.first):
        m.sweep(m.local_root())
    t = np.bincount(m.two_word, m.t2, minlength=len(m.key)).astype(np.int64)
    dish = np.flatnonzero(np.bincount(m.word, minlength=len(m.key)))
    number = m.key[dish] - 1
    rows = [(1, owner, address, len(at), packed(dish[at], number[at] // owners, t[dish[at]])) for owner, at in grouped(number % owners, owners)]
    if wings > 1:
        for kind, key, c, tables in m.totals():
            rows += [(kind, address >> _WING << _WING | part, address, len(at), packed(at, key[at], c[at], tables[at]))
                     for part, at in grouped(spread(key, wings), wings)]
    return rows


def exchanged(kind: int, addresses: list[int], asks: list[bytes], setting: Setting) -> list[tuple]:
    """Answers to a first round. Kind 1: the customers and tables of the words
    at the root, seated here, and (kind 4) their sums. Else: what the other
    wings of a restaurant hold."""
    parts = [unpacked(a) for a in asks]
    key, at = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
    c = np.bincount(at, np.concatenate([p[2] for p in parts])).astype(np.int64)
    rows = []
    if kind == 1:
        d = setting.discount[0]
        # a new table weighs (strength + discount * tables) / (words + 1), about the discount where each word has one
        t = seat(c, np.full(len(c), d), d, np.random.default_rng([setting.seed, 3, len(key), int(c.sum())]))
        rows.append((4, int(c.sum()), -1, int(t.sum()), b""))
    else:
        t = np.bincount(at, np.concatenate([p[3] for p in parts])).astype(np.int64)
    lo = 0
    for address, p in zip(addresses, parts):
        here = at[lo:lo + len(p[1])]
        lo += len(here)
        x, y = (c[here], t[here]) if kind == 1 else (c[here] - p[2], t[here] - p[3])
        rows.append((kind, address, address, len(here), packed(p[0], x, y)))
    return rows


def second_round(m: Shard, kinds: list[int], told: list[bytes], root) -> list[bytes]:
    """The averaged scores of each part's trigrams: -log10, in steps of 2**-16."""
    start = np.full(len(m.key), root(0, 0))
    others = {2: (m.other_c2, m.other_t2), 3: (m.other_c3, m.other_t3)}
    for kind, data in zip(kinds, told):
        at, x, y = unpacked(data)
        if kind == 1:
            start[at] = root(x, y)
        else:
            others[kind][0][at], others[kind][1][at] = x, y
    m.sums()
    logs = np.rint(np.maximum(-np.log10(m.averaged(start)), 0) * 65536).astype(np.int64)[m.at]
    out, lo = [], 0
    for first, where, n in m.spans:
        out.append(packed(first, where, logs[lo:lo + n]))
        lo += n
    return out


def scored(own: bytes, parts: list[bytes], shards: int, n_train: int) -> pa.Table:
    """A chunk's texts with their sums."""
    ids, held, lengths, seq, base, known = unpacked(own)
    three, _, at = trigrams(seq, lengths, shards)
    logs = np.zeros(three.shape[1], np.int64)
    for data in parts:
        first, where, some = unpacked(data)
        logs[slice(first, first + len(some)) if where is None else first + where] = some
    score = np.add.reduceat(logs[at], np.r_[0, np.cumsum(lengths)[:-1]]) / -65536
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_()), "n_tokens": pa.array(lengths),
                     "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(ids), n_train)), "base_score": pa.array(base),
                     "score": pa.array(score), "perplexity": pa.array(10.0 ** np.minimum(-score / lengths, 300))})


def score_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2,
                 setting: Setting = Setting()) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity)`` of every row. Tokens are the words of the text, A-Z in lower
    case, and one end.

    The model learns from rows whose crc32(id as text) mod ``folds`` is not
    ``fold``; rows without an id are held out. ``score`` is the log10 of the
    text's probability under the averaged predictive distribution, a token's
    share rounded to 2**-16; all words that were not learnt are one more word of the base. ``base_score`` is the
    add-one unigram score. Null and empty texts are an end alone; repeated rows
    each count and score alike; other columns are ignored; an empty table gives
    no rows. Words stand for their 64-bit XXH64. A given table and setting give
    the same chunks, draws and scores again while the scan cuts it alike."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("_id"), held_out(id_col, folds, fold).alias("_held"), F.col(text_col).alias("_text"))
    size = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    owners, shards = 1 + size // OWNER_BYTES, 1 + size // SHARD_BYTES
    scratch = Scratch(spark, "pitman-yor")
    col = lambda table, c: table.column(c).to_pylist()

    made = scratch.write(chunks(docs, owners), "chunks")
    named = scratch.write(made.filter("kind = 1").groupBy("place").applyInArrow(
        lambda key, t: rows_of(numbered(key[0].as_py(), owners, col(t, "data"), col(t, "chunk"))), _ROWS), "words")
    n_words, n_train = (int(x or 0) for x in named.filter("kind = 2").agg(F.sum("place"), F.sum("n")).first())

    def count(key, own, answers):
        return rows_of(counted(key[0].as_py(), col(own, "data")[0], col(answers, "data"), shards, n_train, n_words))

    mine = made.filter("kind = 0").groupBy("chunk").cogroup(named.filter("kind = 1").groupBy("chunk"))
    kept = scratch.write(mine.applyInArrow(count, _ROWS), "trigrams", by="kind")
    scratch.drop("chunks", "words")

    blobs = kept.filter("kind = 1").withColumnRenamed("place", "shard")
    large = blobs.groupBy("shard").agg(F.sum("n").alias("n")).filter(F.col("n") > SHARD_MOST)
    wings = {r.shard: -(-r.n // (SHARD_MOST // 2)) for r in large.collect()}  # few: each holds SHARD_MOST or more
    parts = blobs.select("shard", F.lit(0).cast("long").alias("wing"), "chunk", "data")
    if wings:
        hot = F.col("shard").isin(list(wings))
        parts = parts.filter(~hot).unionByName(split_parts(blobs.filter(hot), wings))
    parts = parts.withColumn("address", F.shiftleft("shard", _WING) + F.col("wing"))

    def shard_of(key, table, turn: int) -> Shard:
        return Shard(col(table, "data"), setting, (turn, key[0].as_py()), shards)

    seen = scratch.write(parts.groupBy("address").applyInArrow(
        lambda key, t: rows_of(first_round(shard_of(key, t, 1), key[0].as_py(), owners, wings.get(key[0].as_py() >> _WING, 1))), _ROWS), "restaurants")
    told = scratch.write(seen.groupBy("kind", "place").applyInArrow(
        lambda key, t: rows_of(exchanged(key[0].as_py(), col(t, "chunk"), col(t, "data"), setting)), _ROWS), "root")
    scratch.drop("restaurants")
    customers, tables = (int(x or 0) for x in told.filter("kind = 4").agg(F.sum("place"), F.sum("n")).first())
    d, s = setting.discount[0], setting.strength[0]

    def root(c, t):
        return (c - d * t + (s + d * tables) / (n_words + 1)) / (s + customers)

    def second(key, left, right):
        if not left.num_rows:
            return pa.table({"chunk": pa.array([], pa.int64()), "data": pa.array([], pa.binary())})
        made = second_round(shard_of(key, left, 2), col(right, "kind"), col(right, "data"), root)
        return pa.table({"chunk": left.column("chunk"), "data": pa.array(made, pa.binary())})

    answers = told.filter("kind < 4").withColumnRenamed("chunk", "address").groupBy("address")
    answers = scratch.write(parts.groupBy("address").cogroup(answers).applyInArrow(second, "chunk long, data binary"), "scores")
    scratch.drop("trigrams/kind=1", "root")
    result = kept.filter("kind = 0").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda key, own, t: scored(col(own, "data")[0], col(t, "data"), shards, n_train),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
    result = scratch.write(result, "result")
    scratch.drop("trigrams", "scores")
    return result
