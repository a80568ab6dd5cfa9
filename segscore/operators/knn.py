"""Exact k-nearest neighbours without an all-pairs join.

1. Points are turned to their principal axes and dealt to cells of a k-d tree,
   whose cuts are quantiles of a bounded sample (they only decide who meets
   whom first; the result is exact). A cell with too many points, such as
   copies of one, is split by a hash of the id. A task holds one cell.
2. Every query meets the points of its own cell, which gives its k nearest
   there and a k-th distance ``d_k``.
3. Completion: a neighbour nearer than ``d_k`` lies in a cell whose box of
   values is within ``d_k`` of the query. Only to those cells the query is
   sent, once each; the nearest of all visits are merged.

Inside a cell the same bounds hold for leaves of ``block`` points. What moves
is every point twice, a query once for each cell that its ball touches, and k
neighbours a query: no pair is ever shuffled. The boxes (two rows of numbers a
cell, one cell for some ten thousand points) are collected and broadcast.

A table of at most ``LOCAL_CELLS`` numbers (checked by a count) takes a
shorter way: its points are broadcast and every task searches them whole.

Neighbours are ordered by (distance, neighbour id). A query whose k nearest in
its own cell are exact duplicates of it is sent nowhere: the distances are
exact, the choice among duplicates can differ from a brute-force id order when
they fill more than one cell.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segscore.functions.scalar import nan_to_null, qcol
from segscore.operators.correlation import pair_sums_matrix
from segscore.session import conf_int, cut_lineage

#: Points that a cell is meant to hold, in leaves, and the sample that its cut is taken from.
LEAVES, SAMPLE, SAMPLE_MAX = 512, 64, 200_000
#: Cells at most: beyond, they hold more points.
MAX_CELLS = 65_536


def principal_axes(df: DataFrame, features: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(means, orthonormal axes as columns, of largest variance first)."""
    s = pair_sums_matrix(df, features)
    n = np.diag(s["n"])
    with np.errstate(all="ignore"):
        mu = np.diag(s["sx"]) / n
        cov = s["sxy"] / s["n"] - np.outer(mu, mu)
    if not np.isfinite(cov).all():
        return np.zeros(len(features)), np.eye(len(features))
    return mu, np.linalg.eigh((cov + cov.T) / 2)[1][:, ::-1]


def _node(axis: int = -1, cut: float = 0.0, left: int = -1, cell: int = -1) -> dict:
    return {"axis": axis, "cut": cut, "left": left, "cell": cell}


def _tree(x: np.ndarray, cells: int) -> list[dict]:
    """A k-d tree of ``cells`` leaves over a sample: larger values go right. Points
    that are all equal stay together."""
    nodes, n_cells = [_node()], 0
    todo = [(0, np.arange(len(x)), cells)]
    while todo:
        at, rows, want = todo.pop()
        own = x[rows]
        if want > 1 and len(rows) > 1:
            j = int(np.argmax(own.std(axis=0)))
            v = np.sort(own[:, j])
            cut = v[max(0, len(v) * (want // 2) // want - 1)]
            if cut == v[-1]:
                cut = v[np.searchsorted(v, cut) - 1]  # the next smaller value, if there is one
            if v[0] <= cut < v[-1]:
                nodes[at] = _node(j, float(cut), len(nodes))
                right = own[:, j] > cut
                todo += [(len(nodes), rows[~right], want // 2), (len(nodes) + 1, rows[right], want - want // 2)]
                nodes += [_node(), _node()]
                continue
        nodes[at] = _node(cell=n_cells)
        n_cells += 1
    return nodes


@dataclass
class Cells:
    """Where points go: axes, tree and, by part of a cell, the box of its points."""
    mu: np.ndarray
    axes: np.ndarray
    tree: dict                   # arrays by node
    first: np.ndarray | None = None   # a cell's first part
    parts: np.ndarray | None = None   # and their number
    lo: np.ndarray | None = None      # boxes by part
    hi: np.ndarray | None = None
    slack: float = 0.0           # rounding of the turned coordinates

    def turned(self, x: np.ndarray) -> np.ndarray:
        """Coordinates on the axes, summed in one order whatever the batch."""
        out = np.zeros_like(x)
        for i in range(x.shape[1]):
            out += (x[:, i, None] - self.mu[i]) * self.axes[i]
        return out

    def cell(self, turned: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(turned), np.int64), np.arange(len(turned))
        while True:
            axis = self.tree["axis"][node]
            inner = np.flatnonzero(axis >= 0)
            if not len(inner):
                return self.tree["cell"][node]
            at = node[inner]
            node[inner] = self.tree["left"][at] + (turned[rows[inner], axis[inner]] > self.tree["cut"][at])

    def part(self, cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first[cell] + (h % self.parts[cell].astype(np.uint64)).astype(np.int64)


def _matrix(t, fx: list[str]) -> np.ndarray:
    return np.stack([t.column(c).to_numpy() for c in fx], axis=1) if t.num_rows else np.zeros((0, len(fx)))


def fit_cells(base: DataFrame, fx: list[str], n: int, size: int) -> Cells:
    """The cells of ``n`` points, about ``size`` a cell, and their boxes."""
    spark, p = base.sparkSession, len(fx)
    want = int(min(MAX_CELLS, max(1, -(-n // size))))
    every = max(1, n // min(n, SAMPLE_MAX, SAMPLE * want))
    sample = base.filter(F.pmod(F.xxhash64("pid"), F.lit(every)) == 0).select(*fx).limit(2 * SAMPLE_MAX).toArrow()  # bounded
    cells = Cells(*principal_axes(base, fx), {})
    tree = _tree(cells.turned(_matrix(sample, fx)), want)
    cells.tree = {k: np.array([node[k] for node in tree]) for k in tree[0]}
    told = spark.sparkContext.broadcast(cells)
    lows, highs = [f"lo{i}" for i in range(p)], [f"hi{i}" for i in range(p)]

    def boxes(batches):
        for b in batches:
            if b.num_rows:
                z = told.value.turned(_matrix(b, fx))
                c = told.value.cell(z)
                order = np.argsort(c, kind="stable")
                z, c = z[order], c[order]
                at = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
                lo, hi = np.minimum.reduceat(z, at), np.maximum.reduceat(z, at)
                yield pa.RecordBatch.from_arrays([pa.array(c[at]), pa.array(np.diff(np.r_[at, len(c)])), *map(pa.array, lo.T), *map(pa.array, hi.T)],
                                                 names=["cell", "n", *lows, *highs])

    schema = "cell long, n long, " + ", ".join(f"{c} double" for c in (*lows, *highs))
    got = base.select(*fx).mapInArrow(boxes, schema).groupBy("cell").agg(
        F.sum("n").alias("n"), *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs]).toArrow()  # a row a cell
    many = int(cells.tree["cell"].max()) + 1
    at, count = got.column("cell").to_numpy(), np.zeros(many, np.int64)
    count[at] = got.column("n").to_numpy()
    lo, hi = np.full((many, p), np.inf), np.full((many, p), -np.inf)
    lo[at], hi[at] = _matrix(got, lows), _matrix(got, highs)
    cells.parts = np.maximum(1, -(-count // (2 * max(size, -(-n // want)))))
    cells.first = np.r_[0, np.cumsum(cells.parts)[:-1]]
    cells.lo, cells.hi = np.repeat(lo, cells.parts, axis=0), np.repeat(hi, cells.parts, axis=0)
    edge = np.abs(np.r_[lo[at], hi[at]])
    cells.slack = 1e-9 * float(edge.max(initial=0.0, where=np.isfinite(edge)))
    return cells


def _leaves(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): rows in runs of at most ``size`` that lie close together."""
    order, starts, todo = np.arange(len(x)), [], [(0, len(x))] if len(x) else []
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= size:
            starts.append(lo)
            continue
        own = x[order[lo:hi]]
        mid = (hi - lo) // 2
        order[lo:hi] = order[lo:hi][np.argpartition(own[:, np.argmax(np.ptp(own, axis=0))], mid)]
        todo += [(lo + mid, hi), (lo, lo + mid)]
    return order, np.array(starts, np.int64)


def _bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Distance of every query to every box at least (queries x boxes)."""
    out = np.zeros((len(q), len(lo)))
    with np.errstate(invalid="ignore"):
        for j in range(q.shape[1]):
            d = np.maximum(lo[None, :, j] - q[:, j, None], q[:, j, None] - hi[None, :, j])
            np.maximum(d, 0, out=d)
            out += d * d
    return np.sqrt(out)


def _distances(q: np.ndarray, x: np.ndarray, qid: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squares add up in the order of the columns, as in the SQL form; a row is no neighbour of itself."""
    d = np.zeros((len(q), len(x)))
    for j in range(q.shape[1]):
        step = q[:, j, None] - x[None, :, j]
        step *= step
        d += step
    np.sqrt(d, out=d)
    d[qid[:, None] == ids[None, :]] = np.inf
    return d


def _search(points: tuple, queries: tuple, within: np.ndarray, k: int, block: int, slack: float) -> tuple[np.ndarray, ...]:
    """(row of the query, id, distance) of each query's k nearest points, of
    those at most ``within`` away; by row, distance, id. Points and queries are
    (ids, values, turned values)."""
    ids, x, z = points
    qid, qx, qz = queries
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if not len(ids):
        return out[0]
    order, starts = _leaves(z, block)
    ids, x, z = ids[order], x[order], z[order]
    lo, hi = np.minimum.reduceat(z, starts), np.maximum.reduceat(z, starts)
    ends = np.r_[starts[1:], len(ids)]
    q_order, q_starts = _leaves(qz, block)
    for rows in np.split(q_order, q_starts[1:]) if len(q_order) else []:
        low = _bounds(qz[rows], lo, hi)
        near = np.argsort(low.min(axis=0), kind="stable")
        begin = int(np.searchsorted(np.cumsum(ends[near] - starts[near]), k + 1)) + 1
        limit, found, seen = within[rows], [], []
        for some in (near[:begin], None):
            if some is None:  # all other leaves that may hold a nearer point
                some = near[begin:]
                some = some[~(low[:, some] > limit[:, None] + slack).all(axis=0)]
            if not len(some):
                continue
            at = np.concatenate([np.arange(starts[i], ends[i]) for i in some])
            found.append(_distances(qx[rows], x[at], qid[rows], ids[at]))
            seen.append(at)
            d = np.concatenate(found, axis=1) if len(found) > 1 else found[0]
            if d.shape[1] >= k:
                limit = np.minimum(limit, np.partition(d, k - 1, axis=1)[:, k - 1])
        at = np.concatenate(seen)
        i, j = np.nonzero((d <= limit[:, None]) & np.isfinite(d))
        i, nid, dist = i, ids[at[j]], d[i, j]
        best = np.lexsort((nid, dist, i))
        i, nid, dist = i[best], nid[best], dist[best]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((rows[i[keep]], nid[keep], dist[keep]))
    row, nid, dist = (np.concatenate(c) for c in zip(*out))
    best = np.argsort(row, kind="stable")
    return row[best], nid[best], dist[best]


def _lists(counts: np.ndarray, values: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(values, kind))


def _knn_cells(base: DataFrame, fx: list[str], k: int, n: int, block: int) -> DataFrame:
    sc = base.sparkSession.sparkContext
    told = sc.broadcast(fit_cells(base, fx, n, block * LEAVES))

    def deal(batches):
        for b in batches:
            c = told.value
            part = c.part(c.cell(c.turned(_matrix(b, fx))), b.column("pid").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), *b.columns], names=["part", *b.schema.names])

    points = base.mapInArrow(deal, "part long, pid long, _isq boolean, " + ", ".join(f"{c} double" for c in fx))

    def first(key, t):
        c, home = told.value, key[0].as_py()
        ids, x = t.column("pid").to_numpy(), _matrix(t, fx)
        z = c.turned(x)
        ask = np.flatnonzero(t.column("_isq").to_numpy(zero_copy_only=False))
        row, nid, dist = _search((ids, x, z), (ids[ask], x[ask], z[ask]), np.full(len(ask), np.inf), k, block, c.slack)
        counts = np.bincount(row, minlength=len(ask))
        limit = np.full(len(ask), np.inf)
        whole = counts == k
        limit[whole] = dist[np.cumsum(counts)[whole] - 1]
        visits, many = [np.zeros(0, np.int64)], np.zeros(len(ask), np.int64)
        step = max(1, 4_000_000 // max(1, len(c.lo)))
        for at in range(0, len(ask), step):
            some = slice(at, at + step)
            touch = ~(_bounds(z[ask[some]], c.lo, c.hi) > limit[some, None] + c.slack)
            touch[limit[some] == 0] = False
            touch[:, home] = False
            many[some] = touch.sum(axis=1)
            visits.append(np.nonzero(touch)[1])
        sent = np.flatnonzero(many)
        values = np.zeros(len(ask), np.int64)
        values[sent] = len(fx)
        return pa.table({"qid": pa.array(ids[ask]), "nid": _lists(counts, nid, pa.int64()), "dist": _lists(counts, dist, pa.float64()),
                         "limit": pa.array(limit), "visits": _lists(many, np.concatenate(visits), pa.int64()),
                         "x": _lists(values, x[ask[sent]].ravel(), pa.float64())})

    own = points.groupBy("part").applyInArrow(
        first, "qid long, nid array<long>, dist array<double>, limit double, visits array<long>, x array<double>")
    own = cut_lineage(own)  # read three times
    ask = own.select("qid", "x", "limit", F.explode("visits").alias("part"))
    # a cell that many queries visit is searched in several tasks
    loads = ask.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / F.lit(4 * block * LEAVES)).cast("long").alias("_shares"))
    loads = F.broadcast(cut_lineage(loads))  # a row a cell
    ask = ask.join(loads, "part").withColumn("share", F.pmod(F.xxhash64("qid"), F.col("_shares"))).drop("_shares")
    there = points.join(loads, "part").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_shares") - 1))).drop("_shares")

    def more(t, q):
        c = told.value
        x, qid = _matrix(t, fx), q.column("qid").to_numpy()
        qx = np.asarray(q.column("x").combine_chunks().flatten().to_numpy()).reshape(len(qid), len(fx))
        row, nid, dist = _search((t.column("pid").to_numpy(), x, c.turned(x)), (qid, qx, c.turned(qx)), q.column("limit").to_numpy(), k, block, c.slack)
        return pa.table({"qid": pa.array(qid[row], pa.int64()), "nid": pa.array(nid, pa.int64()), "dist": pa.array(dist, pa.float64())})

    far = there.groupBy("part", "share").cogroup(ask.groupBy("part", "share")).applyInArrow(more, "qid long, nid long, dist double")
    near = own.select("qid", F.explode(F.arrays_zip("nid", "dist")).alias("_n")).select("qid", "_n.nid", "_n.dist")
    w = Window.partitionBy("qid").orderBy("dist", "nid")
    return near.unionByName(far).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("qid", "nid", "rank", "dist")


#: rows × features up to which the points are broadcast (8 bytes each)
LOCAL_CELLS = 400_000


def _knn_local(base: DataFrame, fx: list[str], k: int) -> DataFrame:
    """Each query point against all points, in slices of queries. The squares
    add up in the order of the columns, as in the SQL form."""
    pts = base.select("pid", *fx).toArrow()
    ids = pts.column("pid").to_numpy()
    x = np.stack([pts.column(c).to_numpy() for c in fx], axis=1)
    order = np.argsort(ids, kind="stable")  # equal distances: the smaller id comes first
    bc = base.sparkSession.sparkContext.broadcast((ids[order], x[order]))
    step = max(1, 2_000_000 // max(1, len(ids)))

    def search(batches):
        nid, pts = bc.value
        for b in batches:
            qid = b.column(0).to_numpy()
            q = np.stack([b.column(i + 1).to_numpy() for i in range(len(fx))], axis=1) if b.num_rows else np.zeros((0, len(fx)))
            out = []
            for lo in range(0, len(qid), step):
                some = q[lo:lo + step]
                d = np.zeros((len(some), len(nid)))
                for j in range(len(fx)):
                    d += (some[:, j, None] - pts[None, :, j]) ** 2
                d = np.sqrt(d)
                d[qid[lo:lo + step, None] == nid[None, :]] = np.inf
                kk = min(k, len(nid) - 1)
                edge = np.partition(d, kk - 1, axis=1)[:, kk - 1] if kk > 0 else np.zeros(0)
                for i in range(len(some) if kk > 0 else 0):
                    near = np.flatnonzero(d[i] <= edge[i])
                    near = near[np.isfinite(d[i][near])]
                    near = near[np.argsort(d[i][near], kind="stable")][:k]
                    out.append((np.full(len(near), qid[lo + i]), nid[near], np.arange(1, len(near) + 1), d[i][near]))
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0].astype("i8")), pa.array(cols[1].astype("i8")),
                                              pa.array(cols[2].astype("i4")), pa.array(cols[3].astype("f8"))],
                                             names=["qid", "nid", "rank", "dist"])

    queries = base.filter("_isq").select("pid", *fx).repartition(base.sparkSession.sparkContext.defaultParallelism)
    return cut_lineage(queries.mapInArrow(search, "qid long, nid long, rank int, dist double"))


def knn(df: DataFrame, features: list[str], k: int, id_col: str = "id", query: Column | None = None,
        block: int = 64) -> DataFrame:
    """``(qid, nid, rank, dist)`` — the k nearest other rows of ``df`` for each
    row selected by ``query`` (all rows when None). Rows with a NULL feature
    are neither queries nor neighbours."""
    p = len(features)
    fx = [f"x{i}" for i in range(p)]
    base = df.select(
        qcol(id_col).cast("long").alias("pid"),
        (query if query is not None else F.lit(True)).alias("_isq"),
        *[nan_to_null(qcol(f).cast("double")).alias(c) for f, c in zip(features, fx)],
    ).na.drop(subset=fx)
    # several passes read the projected points: materialise them once
    base = cut_lineage(base)
    n = base.count()
    if n * max(1, p) <= conf_int(df.sparkSession, "segscore.knn.localCells", LOCAL_CELLS):
        return _knn_local(base, fx, k)
    # no pair has a row without an id: equal or not to another is unknown
    base = base.filter("pid is not null").withColumn("_isq", F.coalesce("_isq", F.lit(False)))
    # materialised: callers join it several times, and its plan is long
    return cut_lineage(_knn_cells(base, fx, k, n, block))


def knn_bruteforce_sql(src: str, features: list[str], k: int, query_pred: str = "TRUE", ref_pred: str = "TRUE") -> str:
    """DuckDB twin (the oracle may pair every row; the Spark job never does)."""
    d = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in features)
    return f"""(SELECT qid, nid, rank, dist FROM (
      SELECT a.id AS qid, b.id AS nid, sqrt({d}) AS dist,
             row_number() OVER (PARTITION BY a.id ORDER BY sqrt({d}), b.id) AS rank
      FROM {src} a JOIN {src} b ON a.id <> b.id WHERE ({query_pred.replace('X.', 'a.')}) AND ({ref_pred.replace('X.', 'b.')})
    ) WHERE rank <= {k})"""
