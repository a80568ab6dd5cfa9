"""Hard-negative mining with an inverted multi-index.

The rows of a block are coded by two codebooks, one for each half of the
vector; a pair of codes is a cell. For an anchor each code has the largest
half-score a row of that code can reach: the product with the centroid plus
the anchor half's length times the code's radius. A heap walks the cells by
the sum of the two bounds, the best first (the multi-sequence walk), and rows
of the visited cells are scored exactly in integers. The walk stops when the
next bound can no longer enter what is wanted: the best positives, or the
score windows of the negatives. Blocks are stored once; packs of anchors are
sent to them and what the blocks found is merged.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segscore.llm.blocks import as_decimal, as_long, ask, largest, matrix, products, whole
from segscore.llm.common import cut_lineage

#: Rows of a block, codes of a half.
ROW_BLOCK = 8192
CODES = 16
#: Rows scored at once, at first; every further run is twice as long.
RUN = 128


# ------------------------------------------------------------------- index
def codebook(x: np.ndarray, codes: int, rounds: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k-means of half vectors, started from evenly spread rows: centroids, code by row, radius by code."""
    codes = min(codes, len(x))
    centre = x[np.linspace(0, len(x) - 1, codes).astype(int)].copy()
    square = (x * x).sum(1)
    for last in range(rounds + 1):
        away = square[:, None] - 2 * (x @ centre.T) + (centre * centre).sum(1)
        code = np.argmin(away, axis=1)
        if last == rounds:
            break
        many = np.bincount(code, minlength=codes)
        total = np.zeros_like(centre)
        np.add.at(total, code, x)
        centre[many > 0] = total[many > 0] / many[many > 0, None]
    radius = np.zeros(codes)
    np.maximum.at(radius, code, np.sqrt(((x - centre[code]) ** 2).sum(1)))
    return centre, code, radius


class MultiIndex:
    """One block: rows sorted by cell, two codebooks and their radii."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray, codes: int = CODES):
        at = values.shape[1] // 2
        real = values.astype(float)
        self.at = at
        self.scale = max(1.0, float(np.abs(real).max())) if real.size else 1.0
        (self.c1, k1, self.r1), (self.c2, k2, self.r2) = codebook(real[:, :at] / self.scale, codes), codebook(real[:, at:] / self.scale, codes)
        cell = k1 * len(self.c2) + k2
        order = np.lexsort((ids, cell))
        self.ids, self.labels, self.values = ids[order], labels[order], values[order]
        self.most = largest(values)
        if self.most < 1 << 53:
            self.values = self.values.astype(float)  # still whole numbers; products are faster
        self.first = np.searchsorted(cell[order], np.arange(len(self.c1) * len(self.c2) + 1))

    def walk(self, query: np.ndarray) -> Iterator[tuple[float, float, np.ndarray]]:
        """Runs of cells, best bound first: (largest score any later cell can
        reach, smallest of this run, its rows as positions). Bounds are widened by what the arithmetic may have lost."""
        q = query.astype(float)
        size = float(np.abs(q).max()) if q.size else 0.0
        q = q / size if size else q
        unit = self.scale * size
        a, b = q[:self.at], q[self.at:]
        base1, base2 = self.c1 @ a, self.c2 @ b
        reach1, reach2 = np.sqrt(a @ a) * self.r1, np.sqrt(b @ b) * self.r2
        slack = 1e-9 * (1.0 + len(q))
        up1, up2 = base1 + reach1, base2 + reach2
        o1, o2 = np.argsort(-up1, kind="stable"), np.argsort(-up2, kind="stable")
        u1, u2 = up1[o1].tolist(), up2[o2].tolist()
        low1, low2 = (base1 - reach1)[o1].tolist(), (base2 - reach2)[o2].tolist()
        o1, o2 = o1.tolist(), o2.tolist()
        first, width = self.first, len(o2)
        heap = [(-(u1[0] + u2[0]), 0, 0)]
        spans: list[np.ndarray] = []
        rows, low, run = 0, np.inf, RUN
        place = np.arange(len(self.ids))
        while heap:
            _, i, j = heapq.heappop(heap)
            if j + 1 < width:
                heapq.heappush(heap, (-(u1[i] + u2[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(o1):
                heapq.heappush(heap, (-(u1[i + 1] + u2[0]), i + 1, 0))
            cell = o1[i] * width + o2[j]
            lo, hi = int(first[cell]), int(first[cell + 1])
            if hi > lo:
                spans.append(place[lo:hi])
                rows += hi - lo
                low = min(low, low1[i] + low2[j])
            if rows >= run or not heap:
                then = (-heap[0][0] + slack) * unit + 1e-3 if heap else -np.inf
                yield then, (low - slack) * unit - 1e-3, np.concatenate(spans) if spans else place[:0]
                spans, rows, low, run = [], 0, np.inf, 2 * run

    def positives(self, own: int, label: int, query: np.ndarray, k: int) -> list[tuple]:
        """The ``k`` best (score, id) of ``label`` but for ``own``."""
        best: list[tuple] = []
        for then, _, at in self.walk(query):
            at = at[self.labels[at] == label]
            at = at[self.ids[at] != own]
            if len(at):
                score = products(self.values[at], query, self.most)
                if len(best) == k:
                    good = score >= -best[-1][0]
                    at, score = at[good], score[good]
                best = sorted([*best, *zip((-score).tolist(), self.ids[at].tolist())])[:k]
            if len(best) == k and -best[-1][0] > then:
                break
        return [(-s, i) for s, i in best]

    def windows(self, label: int, query: np.ndarray, bounds: list[tuple[int, int]], k: int) -> list[list[tuple]]:
        """For each (low, high) the first ``k`` (score, id) of other labels inside it."""
        best: list[list[tuple]] = [[] for _ in bounds]
        open_ = [i for i, (lo, hi) in enumerate(bounds) if lo <= hi]
        enough = [lo for lo, _ in bounds]  # what a newcomer has to reach
        for then, low, at in self.walk(query):
            if not open_:
                break
            most = max(bounds[i][1] for i in open_)
            if low <= most:  # else every row of the run lies above all windows
                at = at[self.labels[at] != label]
                score = products(self.values[at], query, self.most)
                some = np.flatnonzero((score >= min(enough[i] for i in open_)) & (score <= most))
                at, score = at[some], score[some]
                for i in open_ if len(at) else []:
                    good = (score >= enough[i]) & (score <= bounds[i][1])
                    if good.any():
                        best[i] = sorted([*best[i], *zip((-score[good]).tolist(), self.ids[at[good]].tolist())])[:k]
                        if len(best[i]) == k:
                            enough[i] = -best[i][-1][0]
            open_ = [i for i in open_ if then >= bounds[i][0] and not (len(best[i]) == k and enough[i] > then)]
        return [[(-s, i) for s, i in b] for b in best]


# ---------------------------------------------------------------- operator
def stored_blocks(rows: DataFrame, scale: float) -> DataFrame:
    """(dim, block, data): every block's index, built once."""

    def build(key, table):
        dim = key[0].as_py()
        x = matrix(table, "x", dim) if dim else np.zeros((table.num_rows, 0))
        made = MultiIndex(table.column("id").to_numpy(), table.column("label").to_numpy(), whole(x, scale))
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "data": pa.array([pickle.dumps(made, 5)], pa.binary())})

    return cut_lineage(rows.groupBy("dim", "block").applyInArrow(build, "dim int, block int, data binary"))


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 50,
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are rows whose id is divisible by ``every``; their positives the
    ``positives`` best other rows of the same label by the inner product of
    floor(scale * x), and for each the first ``negatives`` rows of another
    label with low % <= negative / positive score <= high % (in integers).
    Higher scores come first, ties by smaller id.

    Rows with a null id, label or vector, or a null or non-finite component
    take no part; rows that repeat id, label and vector count once; of an id
    with several rows each counts, but none is its own positive. Only vectors of equal length compare. Scores are exact
    at any size of component; a score beyond 64 bits comes back as the largest
    long, beyond 38 digits such scores tie. Other columns are ignored. An empty
    table gives no rows."""
    x = F.col(vector_col).cast("array<double>")
    fine = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), x.alias("x"))
    rows = rows.filter("id is not null and label is not null and x is not null").filter(F.forall("x", fine)).distinct()
    key = F.xxhash64("id", "label", "x")
    rows = rows.withColumn("dim", F.size("x")).withColumn("key", key)
    rows = rows.withColumn("large", F.exists("x", lambda e: F.abs(e) * scale >= 2.0 ** 48))  # slow integers keep to blocks of their own
    n, n_large = rows.agg(F.count(F.lit(1)), F.count_if("large")).first()
    blocks = max(1, -(-n // ROW_BLOCK))
    place = F.pmod("key", F.lit(blocks))
    rows = rows.withColumn("block", (place + F.when(F.col("large"), F.lit(blocks)).otherwise(F.lit(0))).cast("int"))
    blocks *= 2 if n_large else 1
    index = stored_blocks(rows, scale)
    anchors = cut_lineage(rows.filter(F.col("id") % every == 0).select("key", "dim", "id", "label", "x"))

    best_schema = pa.schema([("key", pa.int64()), ("positive_id", pa.int64()), ("score", pa.decimal128(38, 0))])

    def best(index: MultiIndex, asks: list[dict]) -> pa.RecordBatch:
        out = []
        for a in asks:
            q = whole(np.array(a["x"], float), scale)
            out += [(a["key"], i, as_decimal(s)) for s, i in index.positives(a["id"], a["label"], q, positives)]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(best_schema.types)], schema=best_schema)

    asks = anchors.select("dim", F.struct("key", "id", "label", "x").alias("ask"))
    found = ask(index, asks, blocks, best, "key long, positive_id long, score decimal(38,0)")
    first = Window.partitionBy("key").orderBy(F.col("score").desc(), "positive_id")
    found = found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)
    found = found.groupBy("key").agg(F.collect_list(F.struct("place", "positive_id", "score")).alias("found"))  # at most ``positives``
    asks = cut_lineage(anchors.join(found, "key").select("dim", F.struct("key", "id", "label", "x", "found").alias("ask")))

    types = [("key", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()),
             ("negative_id", pa.int64()), ("positive_score", pa.decimal128(38, 0)), ("negative_score", pa.decimal128(38, 0))]
    mined_schema = pa.schema(types)

    def mine(index: MultiIndex, asks: list[dict]) -> pa.RecordBatch:
        out = []
        for a in asks:
            q = whole(np.array(a["x"], float), scale)
            scores = [int(p["score"]) for p in a["found"]]
            bounds = [(-(-low * s // 100), high * s // 100) for s in scores]
            for p, s, got in zip(a["found"], scores, index.windows(a["label"], q, bounds, negatives)):
                out += [(a["key"], a["id"], p["place"], p["positive_id"], i, as_decimal(s), as_decimal(n)) for n, i in got]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(mined_schema.types)], schema=mined_schema)

    mined = ask(index, asks, blocks, mine, "key long, anchor_id long, place int, positive_id long, negative_id long, "
                                           "positive_score decimal(38,0), negative_score decimal(38,0)")
    order = Window.partitionBy("key", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    return (mined.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", as_long("positive_score"), as_long("negative_score")))
