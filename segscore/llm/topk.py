"""Exact top-k inner-product search with a bit-sliced index.

The vectors of a block lie attribute by attribute as bit slices of their
quantised components. For a query the slices are added with its integer
weights by bitmap arithmetic only: each set bit of a weight puts the
attribute's slices at one shift, and per bit position planes are reduced three
to two by carry-save adders. The top rows are then selected on the sum's
slices from the most significant downward. What quantisation left out bounds
the score from both sides, so every row that could still belong (ties too) is
resolved with exact integer products.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segscore.llm.blocks import as_decimal, as_long, ask, largest, matrix, products, whole
from segscore.llm.common import cut_lineage

#: Rows of a block: the unit of one task's memory.
ROW_BLOCK = 16384
#: Bits kept of each attribute in the index.
SLICE_BITS = 8
#: Rows with a larger component after scaling keep to blocks of their own, where every row is resolved exactly.
LIMIT = 1 << 28
_ALL = ~np.uint64(0)


# ------------------------------------------------------------ bit slices
def slices_of(values: np.ndarray, bits: int) -> np.ndarray:
    """Non-negative integers (rows x attributes) to packed slices
    (attributes x bits x lanes)."""
    n, d = values.shape
    lanes = -(-n // 64)
    out = np.zeros((d, bits, lanes * 8), np.uint8)
    for b in range(bits):
        plane = np.packbits(((values >> b) & 1).astype(np.uint8).T, axis=1, bitorder="little")
        out[:, b, :plane.shape[1]] = plane
    return out.view("<u8")


def add_planes(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Sum of weighted bitmaps: ``columns[p]`` holds the planes (m x lanes) of
    weight 2**p. Full adders turn three planes of a position into one there
    and one above, until one plane a position is left."""
    lanes = columns[0].shape[1]
    out = []
    p = 0
    while p < len(columns):
        x = columns[p]
        while len(x) > 1:
            full = len(x) // 3 * 3
            if full:
                a, b, c = x[0:full:3], x[1:full:3], x[2:full:3]
                either = a ^ b
                total, carry = either ^ c, (a & b) | (c & either)
            else:
                total, carry = (x[0] ^ x[1])[None], (x[0] & x[1])[None]
                full = 2
            if p + 1 == len(columns):
                columns.append(np.zeros((0, lanes), "<u8"))
            columns[p + 1] = np.concatenate([columns[p + 1], carry])
            x = np.concatenate([total, x[full:]])
        out.append(x[0] if len(x) else np.zeros(lanes, "<u8"))
        p += 1
    return out


def count(mask: np.ndarray) -> int:
    return int(np.bitwise_count(mask).sum())


def kth_level(sums: list[np.ndarray], valid: np.ndarray, k: int) -> int:
    """The k-th largest sum among ``valid`` rows, from the most significant
    slice downward; 0 if there are at most k rows."""
    sure, tied, level = np.zeros_like(valid), valid.copy(), 0
    for p in reversed(range(len(sums))):
        high = tied & sums[p]
        if count(sure | high) >= k:
            tied = high
            level |= 1 << p
        else:
            sure |= high
            tied &= ~sums[p]
    return level if count(valid) > k else 0


def at_least(sums: list[np.ndarray], valid: np.ndarray, level: int) -> np.ndarray:
    """Mask of the ``valid`` rows whose sum is ``level`` or more."""
    if level <= 0:
        return valid
    if level >> len(sums):
        return np.zeros_like(valid)
    more, equal = np.zeros_like(valid), valid.copy()
    for p in reversed(range(len(sums))):
        if level >> p & 1:
            equal &= sums[p]
        else:
            more |= equal & sums[p]
            equal &= ~sums[p]
    return more | equal


class Block:
    """A block's index: ids, exact integers, and slices of the quantised integers."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, bits: int = SLICE_BITS):
        self.ids, self.values, self.most = ids, values, largest(values)
        if self.most > LIMIT:  # no slices: all rows are candidates
            values = np.zeros((len(ids), 0), np.int64)
        self.low = values.min(axis=0)
        width = max(1, int((values.max(axis=0) - self.low).max(initial=0)).bit_length())
        self.shift = max(0, width - bits)
        self.bits = min(bits, width)
        self.slices = slices_of((values - self.low) >> self.shift, self.bits)
        lanes = -(-len(ids) // 64)
        self.valid = np.zeros(lanes * 64, np.uint8)
        self.valid[:len(ids)] = 1
        self.valid = np.packbits(self.valid, bitorder="little").view("<u8")

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of every row that can be among the block's k
        best for ``query``, without rows whose id is ``own``; at most k remain."""
        valid = self.valid
        mine = np.flatnonzero(self.ids == own)
        if len(mine):
            valid = valid.copy()
            np.bitwise_and.at(valid, mine // 64, ~(np.uint64(1) << (mine % 64).astype(np.uint64)))
        weight = np.abs(query[:len(self.slices)])
        positions: list[list[np.ndarray]] = [[] for _ in range(self.bits + largest(weight).bit_length())]
        flipped = np.where(query < 0, _ALL, np.uint64(0)).astype("<u8")
        for j in np.flatnonzero(weight):
            planes = self.slices[j] ^ flipped[j]  # a negative weight counts the complement: a constant apart
            for s in range(int(weight[j]).bit_length()):
                if int(weight[j]) >> s & 1:
                    for b in range(self.bits):
                        positions[s + b].append(planes[b])
        lanes = len(valid)
        if any(positions):
            sums = add_planes([np.array(p).reshape(-1, lanes) if p else np.zeros((0, lanes), "<u8") for p in positions])
            slack = int(weight.sum()) if self.shift else 0  # each attribute lost less than one unit of 2**shift
            chosen = at_least(sums, valid, kth_level(sums, valid, k) - slack)
        else:
            chosen = valid
        rows = np.flatnonzero(np.unpackbits(chosen.view(np.uint8), bitorder="little"))
        score = products(self.values[rows], query, self.most)
        best = sorted(zip((-score).tolist(), self.ids[rows].tolist()))[:k]
        return np.array([i for _, i in best], np.int64), np.array([-s for s, _ in best], score.dtype)


# --------------------------------------------------------------- operator
def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(id, v, x)`` with v = floor(scale * x) as longs, or x itself where a
    component is beyond ``LIMIT``; rows whose vector is null, empty or holds
    null or non-finite components go, and rows that repeat entirely count once."""
    x = F.col("x").cast("array<double>")
    fine = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))
    ok = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x")).withColumn("x", x)
    ok = ok.filter(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", fine))
    large = F.exists("x", lambda e: F.abs(e) * scale > LIMIT)
    v = F.when(~large, F.transform("x", lambda e: F.floor(e * scale)).cast("array<long>"))
    return ok.select("id", v.alias("v"), F.when(large, F.col("x")).alias("x")).distinct()


def integers(table: pa.Table, dim: int, scale: int) -> np.ndarray:
    if table.column("v").null_count:
        return whole(matrix(table, "x", dim), scale)
    return matrix(table, "v", dim).astype(np.int64)


def top_k(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, every: int = 100, scale: int = 1024,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each vector whose id is divisible
    by ``every`` its ``k`` highest integer inner products with all other ids'
    vectors of the same length (all, if fewer), ties to the smaller id.

    Null ids and vectors that are null, empty, or hold null or non-finite
    components take no part; rows that repeat entirely count once; of one id
    with several vectors each counts. Scores are exact at any size of component
    and dimension; one beyond 64 bits comes back as the largest long, beyond 38
    digits such scores tie. An empty table gives no rows."""
    v = quantised(df, id_col, vector_col, scale)
    v = v.withColumn("dim", F.when(F.col("v").isNull(), F.size("x")).otherwise(F.size("v")))
    n, n_large = v.agg(F.count(F.lit(1)), F.count_if(F.col("v").isNull())).first()
    blocks = max(1, -(-n // ROW_BLOCK))
    key = F.xxhash64("id", "v", "x")
    place = F.pmod(key, F.lit(blocks)) + F.when(F.col("v").isNull(), F.lit(blocks)).otherwise(F.lit(0))
    rows = v.withColumn("block", place.cast("int"))
    blocks *= 2 if n_large else 1

    def build(key, table):
        dim = key[0].as_py()
        made = Block(table.column("id").to_numpy(), integers(table, dim, scale))
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "data": pa.array([pickle.dumps(made, 5)], pa.binary())})

    # slices are made once a block and stored; packs of queries are sent to them
    index = cut_lineage(rows.groupBy("dim", "block").applyInArrow(build, "dim int, block int, data binary"))
    asks = v.filter(F.col("id") % every == 0).select("dim", F.struct(key.alias("key"), "id", "v", "x").alias("ask"))
    schema = pa.schema([("query_id", pa.int64()), ("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.decimal128(38, 0))])

    def search(block: Block, asks: list[dict]) -> pa.RecordBatch:
        out = []
        for a in asks:
            q = whole(np.array(a["x"], float), scale) if a["v"] is None else np.array(a["v"], np.int64)
            got, score = block.top(q, a["id"], k)
            out += [(a["id"], a["key"], i, as_decimal(s)) for i, s in zip(got.tolist(), score.tolist())]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(schema.types)], schema=schema)

    found = ask(index, cut_lineage(asks), blocks, search, "query_id long, q long, vec_id long, score decimal(38,0)")
    best = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", as_long("score")))
