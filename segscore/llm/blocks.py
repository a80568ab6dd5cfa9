"""Vectors in stored blocks: exact integers, and packs of queries that stream past each block."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Queries of a pack, packs that one copy of a block answers.
PACK = 16
PACKS = 2048
_EXACT = Decimal(10) ** 38 - 1


# ----------------------------------------------------------- exact integers
def whole(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) exactly: 64-bit integers, Python's where they do not fit."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if not y.size or float(np.abs(y).max()) < 2.0 ** 62:
        return y.astype(np.int64)
    exact = [int(f) if np.isfinite(f) else int(v) * int(scale) for f, v in zip(y.ravel().tolist(), x.ravel().tolist())]
    return np.array(exact, object).reshape(x.shape)


def largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def products(rows: np.ndarray, query: np.ndarray, most: int | None = None) -> np.ndarray:
    """Inner products without rounding or overflow: in doubles or 64 bits where
    the bound of the sums (``most``: largest component of ``rows``) allows it."""
    if not rows.shape[1] or not len(rows):
        return np.zeros(len(rows), np.int64)
    bound = (largest(rows) if most is None else most) * largest(query) * rows.shape[1]
    if bound < 1 << 53:
        return (rows.astype(float) @ query.astype(float)).astype(np.int64)
    if bound < 1 << 62:
        return rows.astype(np.int64) @ query.astype(np.int64)
    rows = rows.astype(np.int64) if rows.dtype == float else rows
    return rows.astype(object) @ query.astype(object)


def as_decimal(score) -> Decimal:
    return max(-_EXACT, min(_EXACT, Decimal(int(score))))


# ---------------------------------------------------------------- streaming
def matrix(table: pa.RecordBatch | pa.Table, name: str, dim: int) -> np.ndarray:
    flat = table.column(name)
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def ask(index: DataFrame, anchors: DataFrame, blocks: int, answer, schema: str) -> DataFrame:
    """Sends ``anchors`` (dim, ask: struct) in packs to every block of their
    dimension and streams the packs past the block's index. ``answer(index,
    asks)`` gives the rows. A copy of a block serves ``PACKS`` packs, so its
    task stays bounded however many anchors there are."""
    packs = max(1, -(-anchors.count() // PACK))
    parts = -(-packs // PACKS)
    dump = F.pmod(F.xxhash64("ask.key"), F.lit(packs)).cast("int")

    def wrap(key, table):
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py() % parts], pa.int32()),
                         "data": pa.array([pickle.dumps(table.column("ask").to_pylist(), 5)], pa.binary())})

    sent = anchors.withColumn("pack", dump).groupBy("dim", "pack").applyInArrow(wrap, "dim int, part int, data binary")
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(1))
    held = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("kind", F.lit(0))
    names = ["dim", "block", "part", "kind", "data"]
    stream = (held.select(*names).unionByName(sent.select(*names))
              .repartition("dim", "block", "part").sortWithinPartitions("dim", "block", "part", "kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, found = None, None
        for b in batches:
            for i in range(b.num_rows):
                here = tuple(b.column(c)[i].as_py() for c in range(3))
                if b.column(3)[i].as_py() == 0:
                    where, found = here, pickle.loads(b.column(4)[i].as_py())
                elif here == where:
                    yield answer(found, pickle.loads(b.column(4)[i].as_py()))

    return stream.mapInArrow(run, schema)


def as_long(c: str) -> Column:
    """A decimal score as long, held to the ends of 64 bits."""
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    return F.greatest(F.least(F.col(c), most), -most).cast("long").alias(c)
