"""SimHash near-dedup with bit-sliced comparison.

Fingerprints (64 bits) come from a majority vote over the XXH64 values of a
text's word shingles. Distinct fingerprints, not documents, are compared, so
copies cost one comparison. Candidates share ``keep`` of ``radius + keep``
bands: two fingerprints within ``radius`` bits differ in at most ``radius``
bands, so some choice of ``keep`` equal bands always exists and none is lost.

Inside a bucket the comparison is bit-sliced: the differing bits of many pairs
lie as vertical bit planes, planes are added two at a time into vertical
counters by carry-save adders, and a block is abandoned as soon as every
counter exceeds the radius. A bucket gives a star (member, smallest member),
never its pairs. A bucket above ``BLOCK`` members is cut into sub-blocks and
each pair of sub-blocks is one group, so no task gets a whole hot bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segscore.llm.common import components, cut_lineage, release, shuffle_partitions, texts, with_columns

BITS = 64
#: Members that one group compares at once; larger buckets are cut into pairs of sub-blocks.
BLOCK = 2048
#: Buckets up to this size are compared pair-aligned, many buckets at once.
SMALL = 24
PLANES_AT_ONCE = 8
ADDED = ["fingerprint", "component_id"]
_LANES = np.uint64(0x0101010101010101)


# ------------------------------------------------------------- fingerprints
def shingle_hashes(text: bytes, shingle: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words, joined by one space, of the
    ASCII-lower-cased text; fewer words give one shingle, none gives none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    return np.fromiter((h(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - k + 1)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit word whose bits are set in over half of ``hashes``."""
    n = len(hashes)
    if n == 0:
        return 0
    padded = np.zeros(-(-n // 255) * 255, np.uint64)
    padded[:n] = hashes
    padded = padded.reshape(-1, 255)  # 255 additions fit in the eight byte lanes of a word
    counts = np.empty((8, 8), np.int64)
    for k in range(8):
        lanes = ((padded >> np.uint64(k)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[:, k] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0)
    bits = counts.reshape(-1) * 2 > n  # byte j, bit k: bit 8j + k
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_col: str, shingle: int, out: str, seed: int = 42) -> DataFrame:
    """``df`` without its text and with ``out``: the fingerprint as a long."""
    rest = [f for f in df.schema.fields if f.name != text_col]
    schema = with_columns(df.drop(text_col), **{out: "long"})
    at = df.columns.index(text_col)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            fp = [majority(shingle_hashes(t, shingle, seed)) for t in texts(b.column(at))]
            fp = pa.array(np.array(fp, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(b.columns) if i != at] + [fp], names=[f.name for f in rest] + [out])

    return df.mapInArrow(vote, schema)


# --------------------------------------------------- bit-sliced comparison
def vertical(words: np.ndarray) -> np.ndarray:
    """Bit planes of 64-bit words: row b holds bit b of every word, packed
    into 64-bit lanes; padding positions have every bit set."""
    n = len(words)
    full = np.full(-(-n // 64) * 64, ~np.uint64(0))
    full[:n] = words
    bits = np.unpackbits(full.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(plane_group: Callable[[int, int], np.ndarray], lanes: int, radius: int) -> np.ndarray:
    """Packed mask of the positions whose planes hold at most ``radius`` set
    bits. ``plane_group(lo, hi)`` gives planes lo..hi-1 of the differences."""
    counters = [np.zeros(lanes, "<u8") for _ in range((radius + 1).bit_length())]
    over = np.zeros(lanes, "<u8")
    everywhere = ~np.uint64(0)
    for lo in range(0, BITS, PLANES_AT_ONCE):
        planes = plane_group(lo, lo + PLANES_AT_ONCE)
        for i in range(0, PLANES_AT_ONCE, 2):
            a, b = planes[i], planes[i + 1]
            either = a ^ b
            carry = (a & b) | (counters[0] & either)  # full adder: ones + a + b
            counters[0] = counters[0] ^ either
            for j in range(1, len(counters)):
                counters[j], carry = counters[j] ^ carry, counters[j] & carry
            over |= carry
        more, equal = np.zeros(lanes, "<u8"), np.full(lanes, everywhere)
        for j in reversed(range(len(counters))):
            if radius >> j & 1:
                equal &= counters[j]
            else:
                more |= equal & counters[j]
                equal &= ~counters[j]
        gone = over | more
        if (gone == everywhere).all():
            break
    return ~gone


def unpack(mask: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(mask.astype("<u8").view(np.uint8), bitorder="little")[:n].astype(bool)


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which aligned pairs of fingerprints differ in at most ``radius`` bits."""
    planes = vertical(a ^ b)
    return unpack(within(lambda lo, hi: planes[lo:hi], planes.shape[1], radius), len(a))


def block_roots(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each distinct fingerprint of a block, the index of the first member
    of its component: a member is scanned once against all planes, and what it
    reaches leaves the pool, so the work is members x block, bit-sliced."""
    n = len(fps)
    planes = vertical(fps)
    root = np.full(n, -1)
    pool = np.ones(n, bool)
    for first in range(n):
        if not pool[first]:
            continue
        pool[first] = False
        stack = [first]
        root[first] = first
        while stack:
            q = stack.pop()
            flip = np.where((int(fps[q]) >> np.arange(BITS, dtype=object)) & 1, ~np.uint64(0), np.uint64(0)).astype("<u8")[:, None]
            near = np.flatnonzero(unpack(within(lambda lo, hi: planes[lo:hi] ^ flip[lo:hi], planes.shape[1], radius), n) & pool)
            pool[near] = False
            root[near] = first
            stack.extend(near.tolist())
    return root


def bucket_links(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars (member, root member) of sorted buckets; ``keys`` are bucket numbers."""
    n = len(fps)
    root = np.arange(n)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[starts, n])
    length = np.repeat(size, size)
    small = (length > 1) & (length <= SMALL)
    linked = []
    for d in range(1, min(SMALL, int(size.max(initial=1)))):
        i = np.flatnonzero(small[:-d] & (keys[:-d] == keys[d:])) if d < n else np.zeros(0, int)
        for part in range(0, len(i), 1 << 16):
            j = i[part:part + (1 << 16)]
            j = j[close_pairs(fps[j], fps[j + d], radius)]
            linked.append((j, j + d))
    if linked:
        a, b = (np.concatenate(x) for x in zip(*linked))
        while len(a):  # smallest reachable position within the bucket
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
            if (root == before).all():
                break
    for s, m in zip(starts[size > SMALL], size[size > SMALL]):
        root[s:s + m] = s + block_roots(fps[s:s + m], radius)
    at = np.flatnonzero(root != np.arange(n))
    return fps[at], fps[root[at]]


def near_links(fps: DataFrame, radius: int, keep: int = 2) -> DataFrame:
    """``(a, b)`` longs: star links whose components are those of all pairs of
    the distinct fingerprints ``fps(fp)`` that differ in at most ``radius``
    bits. ``keep`` equal bands of ``radius + keep`` make a bucket key."""
    spark = fps.sparkSession
    bands = radius + keep
    if bands > BITS:
        raise ValueError("radius + keep must be at most 64")
    edge = [round(i * BITS / bands) for i in range(bands + 1)]
    masks = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(bands)]
    tables = [sum(masks[i] for i in c) for c in combinations(range(bands), keep)]
    signed = [m - (1 << 64) if m >> 63 else m for m in tables]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("t", "key"))
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    # alone in its bucket: nothing to compare; a bucket above BLOCK: pairs of sub-blocks
    keyed = keyed.join(sizes, ["t", "key"])
    cuts = F.ceil(F.col("m") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), cuts).cast("int")
    others = F.filter(F.sequence(F.lit(0), cuts - 1), lambda x: x != mine)
    pair = F.when(cuts == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(others, lambda x: (F.least(x, mine) * 1_000_000 + F.greatest(x, mine)).cast("long")))
    keyed = keyed.select("t", "key", "fp", F.explode(pair).alias("pair"))
    keyed = keyed.repartition(shuffle_partitions(spark), "t", "key", "pair").sortWithinPartitions("t", "key", "pair", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        def out(group: list[np.ndarray]) -> pa.RecordBatch:
            t, key, pair_, fp = group
            new = np.r_[False, (t[1:] != t[:-1]) | (key[1:] != key[:-1]) | (pair_[1:] != pair_[:-1])]
            a, b = bucket_links(np.cumsum(new), fp.view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            t, key, pair_, _ = cols
            if not len(t):
                continue
            last = (t == t[-1]) & (key == key[-1]) & (pair_ == pair_[-1])
            cut = int(np.argmax(last))  # sorted: the last bucket may go on in the next batch
            held = [c[cut:] for c in cols]
            if cut:
                yield out([c[:cut] for c in cols])
        if held is not None:
            yield out(held)

    return keyed.select("t", "key", "pair", "fp").mapInArrow(compare, "a long, b long")


# --------------------------------------------------------------- operator
def simhash_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, keep: int = 2,
) -> DataFrame:
    """The columns of ``df`` but its text, with ``fingerprint`` (16 lowercase
    hex digits), ``component_id`` (smallest id reachable over links of at most
    ``radius`` differing bits, itself included) and ``kept`` (one row per
    component: the one with the component's id; rows that repeat entirely are
    all kept or all dropped).

    Null and blank texts have fingerprint zero and link like any other. Null
    ids count as larger than all; a component of null ids has a null
    ``component_id`` and its first text by hash is kept. Repeated rows share a
    fingerprint. Columns named like the added ones are replaced."""
    df = df.drop(*[c for c in [*ADDED, "kept"] if c not in (id_col, text_col)])
    rest = [c for c in df.columns if c != text_col]
    marked = fingerprints(df.withColumn("_s_text", F.xxhash64(F.col(text_col))), text_col, shingle, "_s_fp")
    marked = cut_lineage(marked)  # one pass over the texts; later passes read 3 small columns
    best = F.min(F.struct(F.col(id_col).isNull().alias("o"), F.col(id_col).alias("i"), F.col("_s_text").alias("t")))
    nodes = marked.groupBy("_s_fp").agg(best.alias("_s_best"))
    nodes = cut_lineage(nodes)
    linked = components(near_links(nodes.select(F.col("_s_fp").alias("fp")), radius, keep))
    nodes = nodes.join(linked, F.col("_s_fp") == F.col("node"), "left").select(
        "_s_fp", "_s_best", F.coalesce("root", "_s_fp").alias("root"))
    winner = nodes.groupBy("root").agg(F.min("_s_best").alias("_s_win"))
    nodes = nodes.join(winner, "root").select(F.col("_s_fp").alias("_s_key"), "_s_win")
    return marked.join(nodes, F.col("_s_fp") == F.col("_s_key")).select(
        *rest,
        F.lpad(F.lower(F.hex("_s_fp")), 16, "0").alias("fingerprint"),
        F.col("_s_win.i").alias("component_id"),
        (F.col(id_col).eqNullSafe(F.col("_s_win.i")) & (F.col("_s_text") == F.col("_s_win.t"))).alias("kept"),
        "_s_text",
    )


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``df``, one of each SimHash component (see ``simhash_dedup``)."""
    kept = simhash_dedup(df.select(id_col, text_col), id_col, text_col, **kw).filter("kept")
    kept = kept.select(F.col(id_col).alias("_k_id"), F.col("_s_text").alias("_k_text")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("_k_id")) & (F.xxhash64(F.col(text_col)) == F.col("_k_text"))
    return df.join(kept, same, "left_semi")
