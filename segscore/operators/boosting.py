"""Histogram tree ensembles grown in lockstep.

Features are binned once to bytes by quantile. Any number of models (search
candidates x folds x classes) then grow the same round of trees at once, level
by level: gradients are summed by (model, node, feature, bin), each node takes
the split of the largest second-order gain

    GL^2 / (HL + lam) + GR^2 / (HR + lam) - G^2 / (H + lam)

above ``gamma`` that leaves ``child`` hessian on both sides, and a leaf is
worth ``-G / (H + lam)``. Scores are read at every tree count asked for, so
that axis of a search costs nothing: a shorter ensemble is a prefix.

Gradients are rounded to multiples of 2**-30, so their sums are exact and the
trees do not depend on how rows are partitioned or which of two plans runs:

* binned training tables of at most six times ``segscore.boosting.localCells``
  bytes (checked; a score counts eight) are broadcast, and the models are
  spread over the tasks, where Grow.java grows them as ``run_group`` would;
* larger ones stay partitioned; one Spark job a level sums the histograms of
  all models over the partitions, and the driver sees one split a node.

Rows of a fold, row and column samples and bootstrap weights come from hashes
of (row id, tree, seed), never from a position.
"""

from __future__ import annotations

import pickle
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segscore.functions.scalar import qcol
from segscore.operators import jvm
from segscore.session import conf_int, cut_lineage

OBJECTIVES = ("binary", "softmax", "rank", "forest")
BINS = 32
#: Numbers of a perceptron's table that is broadcast; of a binned one TASK_CELLS times as many,
#: of a byte a feature and a double a class: a few times that is what a task holds of it.
LOCAL_CELLS = 8 << 20
TASK_CELLS = 6
#: (model, row) pairs of one lockstep group on the broadcast plan.
GROUP_PAIRS = 40_000
#: (model and class, row) pairs that go through a level together.
LEVEL_PAIRS = 150_000
#: Numbers of a histogram, of one or more columns, that are searched for splits together.
LEVEL_CELLS = 1 << 16
#: Rows a node from which two columns share one pass of a histogram.
PAIRED_ROWS = 450
#: Rounds between two stored scores on the partitioned plan.
STORE_EVERY = 10
_UNIT = 2.0 ** 30
#: Fold of rows that are scored but never fitted.
NEVER = -9
#: A bootstrap weight is how many of these a row's number reaches: Poisson(1).
POISSON = np.cumsum([np.exp(-1) / f for f in (1, 1, 2, 6, 24, 120, 720)])


@dataclass(frozen=True)
class Params:
    """One model. ``rounds`` holds the tree counts to read scores at; the last
    is the number grown. ``features`` > 0 draws that many features a node."""
    rounds: tuple[int, ...] = (50,)
    depth: int = 3
    eta: float = 0.1
    subsample: float = 1.0
    colsample: float = 1.0
    features: int = 0
    lam: float = 1.0
    gamma: float = 0.0
    child: float = 1.0
    positive: float = 1.0
    bootstrap: bool = False
    fold: int = -1          # rows of this fold are left out of the fit
    seed: int = 42


# ------------------------------------------------------------------ hashing
def mixed(*parts) -> np.ndarray:
    """Uniform numbers in [0, 1) from integers or integer arrays."""
    x = np.uint64(0x243F6A8885A308D3)
    with np.errstate(over="ignore"):
        for p in parts:
            x = (x ^ np.asarray(p).astype(np.int64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            x = x ^ (x >> np.uint64(31))
            x = x * np.uint64(0xBF58476D1CE4E5B9)
            x = x ^ (x >> np.uint64(29))
    return (x >> np.uint64(11)).astype(float) / 2.0 ** 53


def all_columns(params: list[Params], round_: int, n: int) -> np.ndarray:
    """``tree_columns`` of every model; models of one seed and share draw alike."""
    drawn = {(p.seed, p.colsample): p for p in params}
    drawn = {k: tree_columns(p, round_, n) for k, p in drawn.items()}
    return np.stack([drawn[p.seed, p.colsample] for p in params])


def fitted(p: Params, fold: np.ndarray) -> np.ndarray:
    return (fold != p.fold) & (fold != NEVER)


def row_weights(p: Params, round_: int, key: np.ndarray, fold: np.ndarray, draw: np.ndarray | None = None) -> np.ndarray:
    """How often each row counts in a round: 0 outside the fit and the sample."""
    w = fitted(p, fold).astype(float)
    if p.bootstrap:
        u = mixed(key, round_, p.seed, 1) if draw is None else draw
        w *= np.searchsorted(POISSON, u, "right")
    elif p.subsample < 1:
        w *= (mixed(key, round_, p.seed, 1) if draw is None else draw) < p.subsample
    return w


def tree_columns(p: Params, round_: int, n: int) -> np.ndarray:
    """Mask of the columns that a round may use."""
    if p.colsample >= 1:
        return np.ones(n, bool)
    mask = np.zeros(n, bool)
    take = max(1, int(round(p.colsample * n)))
    mask[np.argsort(mixed(np.arange(n), round_, p.seed, 2), kind="stable")[:take]] = True
    return mask


# ----------------------------------------------------------------- objectives
def gradients(objective: str, f: np.ndarray, y: np.ndarray, positive: np.ndarray, sums: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(g, h) of the scores ``f`` (models x classes x rows), rounded to the unit.

    binary: logistic loss, class 1 weighs ``positive``. softmax: one row of
    scores a class. rank: the logarithm of the pairwise exponential loss, whose
    sums over positives and negatives (``sums``, of the fitted rows) factorise. forest: squared error, every tree by itself."""
    if objective == "binary":
        p = 1 / (1 + np.exp(-f))
        w = np.where(y == 1, np.reshape(positive, (-1, 1, 1)), 1.0)
        g, h = w * (p - y), w * p * (1 - p)
    elif objective == "softmax":
        e = np.exp(f - f.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        g = p - (y == np.arange(f.shape[1])[:, None])
        h = 2 * p * (1 - p)
    elif objective == "rank":
        up, down, n = (np.reshape([s[i] for s in sums], (-1, 1, 1)) for i in range(3))
        g = np.where(y == 1, -np.exp(-f) / np.maximum(up, 1e-300), np.exp(f) / np.maximum(down, 1e-300)) * (n / 2)
        h = np.abs(g)
    else:
        g, h = -np.broadcast_to(y.astype(float), f.shape), np.ones(f.shape)
    return np.rint(g * _UNIT) / _UNIT, np.rint(np.maximum(h, 2.0 ** -24) * _UNIT) / _UNIT


def rank_sums(f: np.ndarray, y: np.ndarray, fit: np.ndarray) -> tuple[float, float, float]:
    unit = 2.0 ** 20  # rounded like the gradients: the sums are exact
    a = np.rint(np.exp(-f[:, fit & (y == 1)]) * unit).sum() / unit
    b = np.rint(np.exp(f[:, fit & (y != 1)]) * unit).sum() / unit
    return float(a), float(b), float(fit.sum())


# ---------------------------------------------------------------------- growth
@dataclass
class Level:
    """The open nodes of all models in one level: model and place in its tree."""
    model: np.ndarray
    place: np.ndarray


class Round:
    """Grows one tree a model; where histograms come from is the caller's."""

    def __init__(self, params: list[Params], columns: np.ndarray, round_: int):
        self.params, self.columns, self.round = params, columns, round_
        at = lambda name, kind=float: np.array([getattr(p, name) for p in params], kind)
        self.lam, self.gamma, self.child, self.depth = at("lam"), at("gamma"), at("child"), at("depth", int)
        self.features, self.seed = at("features", int), at("seed", int)
        n = len(params)
        self.level = Level(np.arange(n), np.zeros(n, np.int64))
        self.used = np.ones(n, np.int64)  # nodes of each model's tree so far
        self.nodes: list[tuple] = []      # (model, place, feature, bin, left, value, gain) arrays
        self.at_depth = 0

    def open_nodes(self, total: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Nodes that can still split: above the depth and with hessian for two
        children. Only they need histograms."""
        m = self.level.model
        return np.flatnonzero((self.at_depth < self.depth[m]) & (total[1] >= 2 * self.child[m]))

    def allowed(self, at: np.ndarray) -> np.ndarray:
        """Which columns each of the nodes ``at`` may split on."""
        model, place = self.level.model[at], self.level.place[at]
        ok = self.columns[model]
        wanted = self.features[model]
        if (wanted > 0).any():
            u = mixed(np.arange(ok.shape[1])[None, :], place[:, None], self.round, self.seed[model][:, None], 4)
            rank = np.argsort(np.argsort(u, axis=1, kind="stable"), axis=1)
            ok = ok & ((rank < wanted[:, None]) | (wanted[:, None] == 0))
        return ok

    def best(self, at: np.ndarray, histogram, total: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
        """The best (gain, feature, bin) by node; of the nodes ``at``, whose sums
        by (node, bin) of column j ``histogram(j)`` gives. Equal gains keep the first."""
        n = len(self.level.model)
        gain, feature, cut = np.zeros(n), np.full(n, -1), np.zeros(n, int)
        if not len(at):
            return gain, feature, cut
        m = self.level.model[at]
        G, H = total[0][at], total[1][at]
        lam, child = np.maximum(self.lam[m], 1e-12)[:, None], np.maximum(self.child[m], 1e-9)[:, None]
        root = (G * G / (H + lam[:, 0])).astype(np.float32)
        lam, child = lam.astype(np.float32), child.astype(np.float32)
        ok = self.allowed(at)
        top, col, place = np.zeros(len(at), np.float32), np.full(len(at), -1), np.zeros(len(at), int)
        G, H = G[:, None], H[:, None]
        columns = np.flatnonzero(ok.any(axis=0)).tolist()
        together = max(1, LEVEL_CELLS // (len(at) * BINS))  # columns of one pass
        for lo in range(0, len(columns), together):
            some = columns[lo:lo + together]
            sums = np.stack([histogram(j) for j in some])  # columns x 2 x nodes x bins
            g, h = sums[:, 0], sums[:, 1]
            used = int(np.flatnonzero(h.any(axis=(0, 1)))[-1])  # no cut beyond the last bin in use
            if not used:
                continue
            gl, hl = np.cumsum(g[:, :, :used], axis=2), np.cumsum(h[:, :, :used], axis=2)  # exact
            gr, hr = (G - gl).astype(np.float32), (H - hl).astype(np.float32)
            gl, hl = gl.astype(np.float32), hl.astype(np.float32)
            valid = hl >= child
            valid &= hr >= child
            hl += lam
            hr += lam
            gl *= gl
            gl /= hl
            gr *= gr
            gr /= hr
            gl += gr
            gl *= valid  # what may not be is worth 0, never above the whole node
            k = gl.argmax(axis=2)
            here = np.take_along_axis(gl, k[:, :, None], axis=2)[:, :, 0] - root
            for i, j in enumerate(some):
                better = ok[:, j] & (here[i] > top + 1e-6 * np.abs(top))
                top[better], col[better], place[better] = here[i, better], j, k[i, better]
        gain[at], feature[at], cut[at] = top, col, place
        return gain, feature, cut

    def close(self, gain: np.ndarray, feature: np.ndarray, cut: np.ndarray, total: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
        """Splits what may split, closes the rest. Returns for every open node
        its split column (-1: leaf), bin, value, and its first child among the
        next level's open nodes."""
        lv = self.level
        G, H = total
        m = lv.model
        value = -G / np.maximum(H + self.lam[m], 1e-12)
        split = (feature >= 0) & (gain > np.maximum(self.gamma[m], 1e-6)) & (self.at_depth < self.depth[m])
        feature = np.where(split, feature, -1)
        at = np.flatnonzero(split)
        nth = np.zeros(len(at), np.int64)
        if len(at):  # open nodes are in order of their model
            start = np.flatnonzero(np.r_[True, m[at][1:] != m[at][:-1]])
            nth = np.arange(len(at)) - np.repeat(start, np.diff(np.r_[start, len(at)]))
        left = np.full(len(m), -1)
        left[at] = self.used[m[at]] + 2 * nth
        np.add.at(self.used, m[at], 2)
        self.nodes.append((m, lv.place, feature, cut, left, value, np.where(split, gain, 0.0)))
        child = np.full(len(m), -1)
        child[at] = 2 * np.arange(len(at))
        self.level = Level(np.repeat(m[at], 2), (left[at][:, None] + np.arange(2)).ravel())
        self.at_depth += 1
        return feature, cut, value, child

    def trees(self) -> list[dict]:
        """One tree a model: arrays by place."""
        cols = [np.concatenate(c) for c in zip(*self.nodes)]
        order = np.lexsort((cols[1], cols[0]))
        cols = [c[order] for c in cols]
        ends = np.searchsorted(cols[0], np.arange(len(self.params) + 1))
        names = ("feature", "cut", "left", "value", "gain")
        return [{n: c[lo:hi] for n, c in zip(names, cols[2:])} for lo, hi in zip(ends[:-1], ends[1:])]


class Group:
    """Models that grow in lockstep over rows held in memory (all of them, or
    one partition of them). A model has one row of scores, or one a class."""

    def __init__(self, x: np.ndarray, y: np.ndarray, key: np.ndarray, fold: np.ndarray, params: list[Params], objective: str, classes: int):
        self.x, self.y, self.key, self.fold = x, y, key, fold  # x: columns x rows of bytes
        self.params, self.objective, self.classes = params, objective, classes
        self.f = np.zeros((len(params), classes, len(y)))
        self.codes: dict[int, np.ndarray] = {}
        self.drawn: tuple = (None, None)

    def begin(self, round_: int, sums=None, some: range | None = None) -> None:
        """Gradients of the round's sample, as flat (model and class, row) pairs,
        of the models ``some`` (default: all)."""
        some = some or range(len(self.params))
        if self.objective == "rank" and sums is None:
            sums = [rank_sums(f, self.y, fitted(p, self.fold)) for f, p in zip(self.f, self.params)]
        alike: dict[tuple, list[int]] = {}  # models that count the same rows
        for i in some:
            p = self.params[i]
            alike.setdefault((p.fold, p.subsample, p.bootstrap, p.seed), []).append(i)
        many, n = len(some) * self.classes, len(self.y)
        rows, rest, sums_of = [None] * many, [None] * many, [None] * many
        for at in alike.values():
            p = self.params[at[0]]
            w = row_weights(p, round_, self.key, self.fold, self.draw(round_, p.seed) if p.bootstrap or p.subsample < 1 else None)
            counted, others = np.flatnonzero(w > 0), np.flatnonzero(w == 0)
            g, h = gradients(self.objective, self.f[at][:, :, counted], self.y[counted], np.array([self.params[i].positive for i in at]),
                             None if sums is None else [sums[i] for i in at])
            gh = np.empty(g.shape, complex)
            gh.real, gh.imag = g * w[counted], h * w[counted]
            for a, i in enumerate(at):
                for c in range(self.classes):
                    nth = (i - some[0]) * self.classes + c
                    rows[nth], rest[nth], sums_of[nth] = counted, others, gh[a, c]
        self.row = np.concatenate([*rows, *rest])
        number = np.arange(many)
        self.node = np.concatenate([np.repeat(number, [len(r) for r in each]) for each in (rows, rest)])
        self.pair = (self.node + some[0] * self.classes) * n + self.row
        self.gh = np.concatenate(sums_of)
        self.counted = len(self.gh)

    def draw(self, round_: int, seed: int) -> np.ndarray:
        """Every row's number of the round, drawn once for all models of a seed."""
        if self.drawn[0] != (round_, seed):
            self.drawn = (round_, seed), mixed(self.key, round_, seed, 1)
        return self.drawn[1]

    def enter(self, pairs: np.ndarray, counted: int) -> None:
        """Puts (model and class, row) pairs at the roots; the first ``counted``
        make the histograms, the others are only routed."""
        self.pair, self.counted = pairs, counted
        self.node, self.row = np.divmod(pairs, len(self.y)) if len(pairs) else (pairs, pairs)
        self.gh = np.zeros(counted, complex)

    def totals(self, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        both = np.zeros(nodes, complex)
        np.add.at(both, self.node[:self.counted], self.gh)
        return both.real.copy(), both.imag.copy()

    def histograms(self, nodes: int, at: np.ndarray):
        """Gives, column by column, the sums by (node of ``at``, bin). Where nodes
        hold many rows, one pass sums two columns by both their bins."""
        node, row, gh = self.node[:self.counted], self.row[:self.counted], self.gh
        if len(at) < nodes:
            number = np.full(nodes, -1)
            number[at] = np.arange(len(at))
            node = number.take(node)
            some = np.flatnonzero(node >= 0)
            node, row, gh = node.take(some), row.take(some), gh.take(some)
        n = len(at)
        paired = len(row) >= PAIRED_ROWS * n
        base = node * (BINS * BINS if paired else BINS)
        ready: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def of(j: int) -> tuple[np.ndarray, np.ndarray]:
            if j in ready:
                return ready.pop(j)
            if paired and j ^ 1 < len(self.x):
                both = np.zeros(n * BINS * BINS, complex)
                np.add.at(both, base + self.code(j >> 1).take(row), gh)
                both = both.reshape(n, BINS, BINS)
                for i, axis in ((j & ~1, 2), (j | 1, 1)):
                    one = both.sum(axis=axis)
                    ready[i] = one.real, one.imag
                return ready.pop(j)
            one = np.zeros(n * BINS, complex)
            np.add.at(one, (node * BINS if paired else base) + self.x[j].take(row), gh)
            one = one.reshape(n, BINS)
            return one.real, one.imag

        return of

    def code(self, k: int) -> np.ndarray:
        """The bins of columns 2k and 2k + 1 as one number."""
        if k not in self.codes:
            self.codes[k] = self.x[2 * k].astype(np.uint16) * np.uint16(BINS) + self.x[2 * k + 1]
        return self.codes[k]

    def descend(self, feature: np.ndarray, cut: np.ndarray, value: np.ndarray, child: np.ndarray, flat: np.ndarray) -> None:
        """Rows of closed nodes take the value (into ``flat``), others go to a child."""
        inner = feature >= 0
        if not inner.all():
            stay = inner.take(self.node)
            done = np.flatnonzero(~stay)
            flat[self.pair.take(done)] += value.take(self.node.take(done))
            rest = np.flatnonzero(stay)
            counted = int(np.searchsorted(rest, self.counted))
            self.gh = self.gh.take(rest[:counted])
            self.pair, self.node, self.row, self.counted = self.pair.take(rest), self.node.take(rest), self.row.take(rest), counted
        if not len(self.node):
            return
        cell = (np.where(inner, feature, 0) * self.x.shape[1]).take(self.node)
        cell += self.row
        to = child[:, None] + (np.arange(BINS) > cut[:, None])  # by node and bin
        self.node *= BINS
        self.node += self.x.ravel().take(cell)
        self.node = to.ravel().take(self.node)

    def grow(self, round_: int) -> list[dict]:
        """One round over rows that are all here: a tree a (model, class). Models
        whose pairs stay in a core's cache go together."""
        step, trees = np.zeros(self.f.size), []
        together = max(1, LEVEL_PAIRS // max(1, self.classes * len(self.y)))
        for lo in range(0, len(self.params), together):
            some = range(lo, min(lo + together, len(self.params)))
            self.begin(round_, None, some)
            by_class = [self.params[i] for i in some for _ in range(self.classes)]
            r = Round(by_class, all_columns(by_class, round_, len(self.x)), round_)
            while len(r.level.model):
                nodes = len(r.level.model)
                total = self.totals(nodes)
                at = r.open_nodes(total)
                self.descend(*r.close(*r.best(at, self.histograms(nodes, at), total), total), step)
            trees += r.trees()
        self.add(step)
        return trees

    def add(self, step: np.ndarray) -> None:
        """The round's moves into the scores; a forest's scores are means of trees."""
        eta = np.array([1.0 / p.rounds[-1] if self.objective == "forest" else p.eta for p in self.params])
        self.f += step.reshape(self.f.shape) * eta[:, None, None]


# ----------------------------------------------------------------------- tables
@dataclass
class Binned:
    """A training table in bytes: rows of (key, fold, y, x: one byte a feature)."""
    rows: DataFrame
    features: list[str]
    cuts: list[np.ndarray]
    n: int
    classes: int
    held: object = field(default=None, repr=False)  # (x, y, key, fold) when small

    @property
    def spark(self) -> SparkSession:
        return self.rows.sparkSession


def binned(df: DataFrame, features: list[str], label: str = "label", id_col: str = "id", fold: str | None = None, classes: int = 1) -> Binned:
    """Cuts at quantiles of the values (one aggregate for all features; a row
    goes right of a cut if it is larger) and the table in bytes. Rows with a
    missing label or feature take no part."""
    cols = [qcol(id_col).cast("long").alias("key"), (F.coalesce(qcol(fold), F.lit(-2)) if fold else F.lit(-2)).cast("int").alias("fold"),
            qcol(label).cast("double").alias("y"), *[qcol(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]]
    src = df.select(*cols)
    ok = F.col("y").isNotNull()
    for i in range(len(features)):
        ok = ok & F.col(f"x{i}").isNotNull() & ~F.isnan(f"x{i}")
    src = src.filter(ok)
    share = [i / BINS for i in range(1, BINS)]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(len(features)):
        aggs += [F.percentile_approx(f"x{i}", share, F.lit(10_000)).alias(f"q{i}"), F.min(f"x{i}").alias(f"a{i}"), F.max(f"x{i}").alias(f"b{i}")]
    r = src.agg(*aggs).first()
    cuts = []
    for i in range(len(features)):
        c = np.unique(np.array([r[f"a{i}"], *(r[f"q{i}"] or [])], float)) if r["n"] else np.zeros(0)
        cuts.append(c[c < (r[f"b{i}"] if r["n"] else 0)][:BINS - 1])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([np.searchsorted(c, b.column(3 + i).to_numpy(), "left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8) \
                if b.num_rows else np.zeros((0, len(cuts)), np.uint8)
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(cuts)), b.num_rows, [None, pa.py_buffer(np.ascontiguousarray(x))])
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), raw.cast(pa.binary())], names=["key", "fold", "y", "x"])

    rows = cut_lineage(src.mapInArrow(code, "key long, fold int, y double, x binary"))
    out = Binned(rows, features, cuts, int(r["n"]), classes)
    if out.n * (len(features) + 8 * classes) <= TASK_CELLS * conf_int(out.spark, "segscore.boosting.localCells", LOCAL_CELLS):
        out.held = in_memory(rows.toArrow(), len(features))
    return out


def in_memory(t: pa.Table, width: int) -> tuple[np.ndarray, ...]:
    key = t.column("key").to_numpy()
    order = np.argsort(key, kind="stable")
    x = np.frombuffer(b"".join(t.column("x").to_pylist()), np.uint8).reshape(-1, width)
    return (np.ascontiguousarray(x[order].T), t.column("y").to_numpy()[order], key[order], t.column("fold").to_numpy()[order])


# -------------------------------------------------------------- staged metrics
def average_precision(score: np.ndarray, y: np.ndarray) -> float:
    """Sum of precision times the step in recall over distinct scores; NaN without a positive."""
    order = np.argsort(-score, kind="stable")
    s, tp = score[order], np.cumsum(y[order] == 1)
    if not len(s) or not tp[-1]:
        return float("nan")
    last = np.flatnonzero(np.r_[s[1:] != s[:-1], True])
    tp = tp[last]
    return float(np.sum(np.diff(tp, prepend=0) / tp[-1] * tp / (last + 1)))


def macro_recall(score: np.ndarray, y: np.ndarray) -> float:
    """Mean recall of the classes that occur."""
    hit = np.argmax(score, axis=0) == y
    return float(np.mean([hit[y == c].mean() for c in np.unique(y)])) if len(y) else float("nan")


def staged(f: np.ndarray, y: np.ndarray, objective: str) -> float:
    return macro_recall(f, y) if objective == "softmax" else average_precision(f[0], y)


# ------------------------------------------------------------------------ plans
def family(p: Params) -> Params:
    """Models of one family differ in depth alone. While no tree of the deepest
    has passed a shallower limit they are the same model, and grow as one."""
    return replace(p, depth=0)


def _groups(params: list[Params], pairs: int) -> list[list[int]]:
    """Families of like length share a lockstep group of about ``GROUP_PAIRS``."""
    size = max(1, GROUP_PAIRS // max(1, pairs))
    kin: dict[Params, list[int]] = {}
    for i, p in enumerate(params):
        kin.setdefault(family(p), []).append(i)
    order = sorted(kin.values(), key=lambda at: (-params[at[0]].rounds[-1], -max(params[i].depth for i in at), params[at[0]].fold, params[at[0]].subsample, at))
    return [[i for at in order[lo:lo + size] for i in at] for lo in range(0, len(order), size)]


def depths(tree: dict) -> np.ndarray:
    out = np.zeros(len(tree["feature"]), int)
    for i in np.flatnonzero(tree["feature"] >= 0):  # a child's place is larger than its parent's
        out[tree["left"][i]:tree["left"][i] + 2] = out[i] + 1
    return out


def shallow(tree: dict, depth: int) -> dict:
    """The tree a lower limit would have given: its nodes there are leaves."""
    at = depths(tree)
    keep = at <= depth
    number = np.cumsum(keep) - 1
    inner = (tree["feature"] >= 0) & (at < depth)
    return {"feature": np.where(inner, tree["feature"], -1)[keep], "cut": tree["cut"][keep],
            "left": np.where(inner, number[np.where(inner, tree["left"], 0)], -1)[keep], "value": tree["value"][keep],
            "gain": np.where(inner, tree["gain"], 0.0)[keep]}


def leaf_values(tree: dict, x: np.ndarray) -> np.ndarray:
    """The value every row (of bytes, columns x rows) gets."""
    node, rows = np.zeros(x.shape[1], int), np.arange(x.shape[1])
    while True:
        f = tree["feature"][node]
        inner = np.flatnonzero(f >= 0)
        if not len(inner):
            return tree["value"][node]
        at = node[inner]
        node[inner] = tree["left"][at] + (x[f[inner], rows[inner]] > tree["cut"][at])


@dataclass
class Live:
    """A model that grows, and those of its family that so far are the same."""
    at: int
    same: list[int]


def run_group(data: tuple, params: list[Params], objective: str, classes: int, evaluate: bool, keep: bool) -> tuple[list[list[float]], list[list[dict]], np.ndarray]:
    """Grows the models; the metric of their left-out fold at every stage, their trees, their last scores."""
    x, y, key, fold = data
    kin: dict[Params, list[int]] = {}
    for i, p in enumerate(params):
        kin.setdefault(family(p), []).append(i)
    live = []
    for at in kin.values():
        first, *rest = sorted(at, key=lambda i: -params[i].depth)
        live.append(Live(first, rest))
    group = Group(x, y, key, fold, [params[m.at] for m in live], objective, classes)
    seen: list[list[float]] = [[] for _ in params]
    trees: list[list[dict]] = [[] for _ in params]
    final = np.zeros((len(params), classes, len(y)))
    for t in range(max((p.rounds[-1] for p in params), default=0)):
        before = group.f.copy()
        grown = group.grow(t)
        forked, scores = [], []
        for a, m in enumerate(live):
            mine = grown[a * classes:(a + 1) * classes]
            deepest = max(int(depths(tree).max()) for tree in mine) if m.same else 0
            apart = [i for i in m.same if params[i].depth < deepest]
            if apart:
                m.same = [i for i in m.same if i not in apart]
                for limit in sorted({params[i].depth for i in apart}, reverse=True):
                    first, *rest = [i for i in apart if params[i].depth == limit]
                    lower = [shallow(tree, limit) for tree in mine]
                    eta = 1.0 / params[first].rounds[-1] if objective == "forest" else params[first].eta
                    forked.append(Live(first, rest))
                    scores.append(before[a] + eta * np.stack([leaf_values(tree, x) for tree in lower]))
                    if keep:
                        for i in (first, *rest):
                            trees[i] = [*trees[m.at], *lower]
            if keep:
                for i in (m.at, *m.same):
                    trees[i] = [*trees[i], *mine]
        if forked:
            live += forked
            group.f = np.concatenate([group.f, np.stack(scores)])
        done = []
        for a, m in enumerate(live):
            p = params[m.at]
            if evaluate and t + 1 in p.rounds:
                out = fold == p.fold
                f = group.f[a][:, out] * (p.rounds[-1] / (t + 1) if objective == "forest" else 1.0)
                value = staged(f, y[out], objective)
                for i in (m.at, *m.same):
                    seen[i].append(value)
            if t + 1 == p.rounds[-1]:
                for i in (m.at, *m.same):
                    final[i] = group.f[a]
                done.append(a)
        if done or forked:
            stay = [a for a in range(len(live)) if a not in set(done)]
            group.f, live = group.f[stay], [live[a] for a in stay]
            group.params = [params[m.at] for m in live]
    return seen, trees, final


def _spread(b: Binned, params: list[Params], objective: str, evaluate: bool, keep: bool, scores: bool = False) -> list:
    """The broadcast plan: groups of models over the tasks."""
    sc = b.spark.sparkContext
    groups = _groups(params, b.n * b.classes)
    if len(groups) < sc.defaultParallelism:  # few models: one a task as far as they go
        k = -(-len(params) // min(sc.defaultParallelism, max(1, len(params))))
        order = [i for g in groups for i in g]
        groups = [order[i::-(-len(order) // k)] for i in range(-(-len(order) // k))]
    if b.spark.conf.get("segscore.boosting.jvm", "true") == "true":
        return _in_jvm(b, groups, params, objective, evaluate, keep, scores)
    shared = sc.broadcast(b.held)
    classes = b.classes

    tasks = [(g, [params[j] for j in g]) for g in groups]
    told = sc.broadcast(tasks)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for i in rb.column(0).to_pylist():
                at, ps = told.value[i]
                seen, trees, final = run_group(shared.value, ps, objective, classes, evaluate, keep)
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((at, seen, trees if keep else None, final if scores else None), 5)],
                                                           pa.binary())], names=["data"])

    work = b.spark.range(0, len(groups), 1, len(groups))  # a task a group, no exchange
    out: list = [None] * len(params)
    for r in work.mapInArrow(fit, "data binary").collect():  # trees and metrics, bounded by the models
        at, seen, trees, final = pickle.loads(r["data"])
        for n, i in enumerate(at):
            out[i] = (seen[n], trees[n] if keep else None, final[n] if scores else None)
    shared.unpersist()
    told.unpersist()
    return out


def _in_jvm(b: Binned, groups: list[list[int]], params: list[Params], objective: str, evaluate: bool, keep: bool, scores: bool) -> list:
    """``run_group`` of every group by Grow.java: the same trees in a fraction of the time."""
    x, y, key, fold = b.held
    order = near_rows(x)
    x, y, key, fold = x[:, order], y[order], key[order], fold[order]
    width, many = x.shape
    table = b"".join([struct.pack("<ii", many, width), np.ascontiguousarray(x.T).tobytes(), y.astype("<f8").tobytes(),
                      key.astype("<i8").tobytes(), fold.astype("<i4").tobytes()])
    kin = {f: i for i, f in enumerate(dict.fromkeys(map(family, params)))}
    parts = []
    for g in groups:
        part = [struct.pack("<i", len(g))]
        for i in g:
            p = params[i]
            take = width if p.colsample >= 1 else max(1, int(round(p.colsample * width)))
            part.append(struct.pack(f"<iii{len(p.rounds)}i5iq6d", i, kin[family(p)], len(p.rounds), *p.rounds, p.depth, take, p.features, p.fold, p.bootstrap,
                                    p.seed, p.eta, p.subsample, p.lam, p.gamma, p.child, p.positive))
        parts.append(b"".join(part))
    head = struct.pack("<5i7d", OBJECTIVES.index(objective), b.classes, evaluate, keep, scores, *POISSON)
    start = len(head) + 4 * len(parts) + np.cumsum([0, *map(len, parts)])
    work = b"".join([head, struct.pack(f"<{len(parts)}i", *start[:-1].tolist()), *parts])
    out: list = [None] * len(params)
    with jvm.function(b.spark, "Grow", table, work) as grow:
        rows = b.spark.range(0, len(groups), 1, len(groups)).select(grow("id").alias("data")).collect()  # trees and metrics, bounded by the models
    for r in rows:
        for i, seen, trees, final in _told(r["data"], keep):
            if scores:
                back = np.empty((b.classes, many))
                back[:, order] = final.reshape(b.classes, many)
            out[i] = (seen, trees, back if scores else None)
    return out


def near_rows(x: np.ndarray) -> np.ndarray:
    """An order of the rows in which those of a node mostly lie together: by the
    highest bits of all columns first. Sums are exact, so trees do not depend on it."""
    code, used = np.zeros(x.shape[1], np.uint64), 0
    for bit in range(4, -1, -1):
        for column in x:
            if used < 64:
                code = code << np.uint64(1) | (column.astype(np.uint64) >> np.uint64(bit)) & np.uint64(1)
                used += 1
    return np.argsort(code, kind="stable")


def _told(data: bytes, keep: bool) -> Iterator[tuple]:
    """What Grow.java writes: (number, metrics, trees, scores) of each model."""
    at = 0

    def some(kind, n: int = 1) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out

    node = np.dtype([("feature", ">i4"), ("cut", ">i4"), ("left", ">i4"), ("value", ">f8"), ("gain", ">f8")])
    for _ in range(some(">i4")[0]):
        i = int(some(">i4")[0])
        seen = some(">f8", some(">i4")[0]).tolist()
        trees = []
        for _ in range(some(">i4")[0]):
            t = some(node, some(">i4")[0])
            trees.append({name: t[name].astype(np.int64 if t[name].dtype.kind == "i" else float) for name in node.names})
        yield i, seen, trees if keep else None, some(">f8", some(">i4")[0]).astype(float)


class Partitioned:
    """The plan for large tables: scores live with the rows, in blocks; every
    level is one job that sums histograms, every ``STORE_EVERY`` rounds the
    scores are stored."""

    def __init__(self, b: Binned, params: list[Params], objective: str):
        self.b, self.params, self.objective = b, params, objective
        width, models, classes = len(b.features), len(params), b.classes

        def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rb in batches:
                t = pa.Table.from_batches([rb])
                if t.num_rows:
                    data = in_memory(t, width)
                    f = np.zeros((models, classes, t.num_rows))
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((data, f), 5)], pa.binary())], names=["data"])

        self.blocks = cut_lineage(b.rows.mapInArrow(block, "data binary"))
        self.pending: list[tuple[int, list]] = []  # rounds whose moves the stored scores lack: (round, its levels)

    def _job(self, per_block, schema: str) -> DataFrame:
        """Runs ``per_block(group)`` over all blocks, brought up to the last finished round."""
        spec = self.b.spark.sparkContext.broadcast((self.params, self.objective, self.b.classes, list(self.pending)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            params, objective, classes, pending = spec.value

            def groups():
                for rb in batches:
                    for data in rb.column(0).to_pylist():
                        (x, y, key, fold), f = pickle.loads(data)
                        g = Group(x, y, key, fold, params, objective, classes)
                        g.f = f
                        for _, levels in pending:
                            replay(g, levels)
                        yield g

            yield from per_block(groups())

        return self.blocks.mapInArrow(run, schema)

    def store(self) -> None:
        def keep(groups):
            for g in groups:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(((g.x, g.y, g.key, g.fold), g.f), 5)], pa.binary())], names=["data"])

        self.blocks = cut_lineage(self._job(keep, "data binary"))
        self.pending = []

    def rank_sums(self) -> list | None:
        if self.objective != "rank":
            return None

        def some(groups):
            total = {}
            for g in groups:
                for i, p in enumerate(g.params):
                    total[i] = np.array(rank_sums(g.f[i], g.y, fitted(p, g.fold))) + total.get(i, 0)
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), *(pa.array([v[j] for v in total.values()], pa.float64()) for j in range(3))],
                                             names=["i", "a", "b", "n"])

        rows = self._job(some, "i int, a double, b double, n double").groupBy("i").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("n").alias("n")).collect()
        by = {r["i"]: (r["a"], r["b"], r["n"]) for r in rows}
        return [by[i] for i in range(len(self.params))]

    def grow(self, round_: int) -> list[dict]:
        classes, width = self.b.classes, len(self.b.features)
        by_class = [p for p in self.params for _ in range(classes)]
        r = Round(by_class, all_columns(by_class, round_, width), round_)
        sums = self.rank_sums()
        levels: list[tuple] = []
        while len(r.level.model):
            nodes, so_far = len(r.level.model), list(levels)

            def sum_up(groups):
                total = None
                for g in groups:
                    g.begin(round_, sums)
                    step = np.zeros(g.f.size)
                    for lv in so_far:
                        g.descend(*lv, step)
                    of = g.histograms(nodes, np.arange(nodes))
                    here = np.stack([np.stack(of(j)) for j in range(width)], axis=2)  # 2 x nodes x columns x bins
                    here = np.rint(here * _UNIT).astype(np.int64)
                    total = here if total is None else total + here
                if total is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(nodes, dtype=np.int32)),
                                                      pa.array([total[:, i].tobytes() for i in range(nodes)], pa.binary())], names=["node", "data"])

            def add(key, t):
                total = sum(np.frombuffer(d, np.int64) for d in t.column("data").to_pylist())
                return pa.table({"node": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})

            got = self._job(sum_up, "node int, data binary").groupBy("node").applyInArrow(add, "node int, data binary").collect()
            whole = np.zeros((2, nodes, width, BINS))
            for row in got:
                whole[:, row["node"]] = np.frombuffer(row["data"], np.int64).reshape(2, width, BINS) / _UNIT
            total = whole[0, :, 0].sum(axis=1), whole[1, :, 0].sum(axis=1)
            at = r.open_nodes(total)
            found = r.best(at, lambda j: (whole[0, at, j], whole[1, at, j]), total)
            levels.append(r.close(*found, total))
        self.pending.append((round_, levels))
        if len(self.pending) >= STORE_EVERY:
            self.store()
        return r.trees()

    def left_out(self) -> DataFrame:
        """(model, key, y, score: one a class) of the rows each model was not fitted on."""
        def out(groups):
            for g in groups:
                for i, p in enumerate(g.params):
                    at = np.flatnonzero(g.fold == p.fold)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), i, np.int32)), pa.array(g.key[at]), pa.array(g.y[at]),
                         pa.array([g.f[i][:, a].tolist() for a in at], pa.list_(pa.float64()))], names=["model", "key", "y", "score"])

        return self._job(out, "model int, key long, y double, score array<double>")


def replay(g: Group, levels: list[tuple]) -> None:
    """Moves the scores of a block by a finished round."""
    g.enter(np.arange(len(g.params) * g.classes * len(g.y)), 0)
    step = np.zeros(g.f.size)
    for lv in levels:
        g.descend(*lv, step)
    g.add(step)


def _level_jobs(b: Binned, params: list[Params], objective: str, evaluate: bool) -> list:
    """The partitioned plan: every model of one length in lockstep."""
    from segscore.operators import metrics
    out: list = [None] * len(params)
    for n in sorted({p.rounds[-1] for p in params}):
        at = [i for i, p in enumerate(params) if p.rounds[-1] == n]
        plan = Partitioned(b, [params[i] for i in at], objective)
        trees: list[list[dict]] = [[] for _ in at]
        seen: list[list[float]] = [[] for _ in at]
        for t in range(n):
            grown = plan.grow(t)
            for a in range(len(at)):
                trees[a] += grown[a * b.classes:(a + 1) * b.classes]
            stages = [a for a, i in enumerate(at) if t + 1 in params[i].rounds]
            if evaluate and stages:
                rows = plan.left_out()
                if objective == "softmax":
                    hit = F.array_position("score", F.array_max("score")) - 1 == F.col("y")
                    got = (rows.groupBy("model", "y").agg(F.avg(hit.cast("double")).alias("r")).groupBy("model").agg(F.avg("r").alias("v")))
                else:
                    got = metrics.average_precision(rows.select("model", F.col("score")[0].alias("score"), F.col("y").cast("int").alias("label")), by=["model"])
                    got = got.withColumnRenamed([c for c in got.columns if c != "model"][0], "v")
                by = {r["model"]: r["v"] for r in got.collect()}
                for a in stages:
                    seen[a].append(float("nan") if by.get(a) is None else float(by[a]))
        for a, i in enumerate(at):
            out[i] = (seen[a], trees[a], None)
    return out


def search(b: Binned, params: list[Params], objective: str = "binary") -> list[list[float]]:
    """The metric of each model's left-out fold (average precision, of several
    classes macro recall) at every tree count of its ``rounds``."""
    got = _spread(b, params, objective, True, False) if b.held is not None else _level_jobs(b, params, objective, True)
    return [g[0] for g in got]


def fit(b: Binned, p: Params, objective: str = "binary") -> "Trees":
    """One ensemble fitted on all rows that are not in ``p.fold``."""
    got = _spread(b, [p], objective, False, True) if b.held is not None else _level_jobs(b, [p], objective, False)
    return as_trees(got[0][1], b, p, objective)


def last_scores(b: Binned, params: list[Params], objective: str = "binary") -> list[np.ndarray]:
    """Every model's score of every row of a small table, rows by key."""
    if b.held is None:
        raise ValueError("the table is larger than segscore.boosting.localCells")
    return [1 / (1 + np.exp(-g[2][0])) if objective == "binary" else g[2][0] for g in _spread(b, params, objective, False, False, scores=True)]


def fit_many(b: Binned, params: list[Params], objective: str = "binary") -> list["Trees"]:
    got = _spread(b, params, objective, False, True) if b.held is not None else _level_jobs(b, params, objective, False)
    return [as_trees(g[1], b, p, objective) for g, p in zip(got, params)]


# ------------------------------------------------------------------------ model
@dataclass
class Trees:
    """A fitted ensemble as flat arrays; the node table is what is stored."""
    features: list[str]
    objective: str
    classes: int
    scale: float                 # of a leaf's value
    root: np.ndarray             # first node of each tree; trees of a round follow each other by class
    feature: np.ndarray          # -1: leaf
    cut: np.ndarray
    left: np.ndarray             # the right child follows
    value: np.ndarray
    gain: np.ndarray

    def raw(self, x: np.ndarray, upto: int | None = None) -> np.ndarray:
        """Scores (classes x rows) of a matrix of feature values."""
        out = np.zeros((self.classes, len(x)))
        rows = np.arange(len(x))
        for t, root in enumerate(self.root[:None if upto is None else upto * self.classes]):
            node = np.full(len(x), root)
            while True:
                f = self.feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                node[inner] = self.left[node[inner]] + (x[rows[inner], f[inner]] > self.cut[node[inner]])
            out[t % self.classes] += self.value[node]
        return out * self.scale

    def scores(self, x: np.ndarray) -> np.ndarray:
        """P(class 1), a ranking score, or the classes' probabilities (rows x classes)."""
        f = self.raw(x)
        if self.objective == "binary":
            return 1 / (1 + np.exp(-f[0]))
        if self.objective == "softmax":
            e = np.exp(f - f.max(axis=0))
            return (e / e.sum(axis=0)).T
        return f[0]

    def importances(self) -> np.ndarray:
        """Mean gain of the splits by feature, as shares of the whole."""
        inner = self.feature >= 0
        many = np.bincount(self.feature[inner], minlength=len(self.features))
        total = np.bincount(self.feature[inner], self.gain[inner], len(self.features)) / np.maximum(many, 1)
        return total / total.sum() if total.sum() else total

    def truncated(self, rounds: int, scale: float | None = None) -> "Trees":
        """The ensemble of the first ``rounds`` rounds."""
        n = min(rounds * self.classes, len(self.root))
        end = self.root[n] if n < len(self.root) else len(self.feature)
        return replace(self, scale=self.scale if scale is None else scale, root=self.root[:n], feature=self.feature[:end],
                       cut=self.cut[:end], left=self.left[:end], value=self.value[:end], gain=self.gain[:end])

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Adds ``out``: the score, or of several classes the likeliest. A row
        with a missing feature gets NULL."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        many = self.objective == "softmax"

        def score(cols: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            m = shared.value
            for c in cols:
                x = np.stack([s.to_numpy(float) for s in (c if isinstance(c, tuple) else (c,))], axis=1)
                ok = ~np.isnan(x).any(axis=1)
                y = np.full(len(x), np.nan)
                if ok.any():
                    s = m.scores(x[ok])
                    y[ok] = np.argmax(s, axis=1) if many else s
                yield pd.Series(pd.array(np.where(ok, y, 0).astype("i4"), dtype="Int32")).where(ok) if many else pd.Series(y).astype(object).where(ok, None)

        udf = F.pandas_udf(score, "int" if many else "double")
        return df.withColumn(out, udf(*[qcol(f).cast("double") for f in self.features]))

    # -------------------------------------------------------------- storage
    def table(self, spark: SparkSession) -> DataFrame:
        tree = np.repeat(np.arange(len(self.root)), np.diff(np.r_[self.root, len(self.feature)]))
        pdf = pd.DataFrame({"tree": tree, "node": np.arange(len(tree)), "feature": self.feature, "cut": self.cut, "left": self.left,
                            "value": self.value, "gain": self.gain})
        return spark.createDataFrame(pdf, "tree int, node int, feature int, cut double, left int, value double, gain double")

    def head(self) -> dict:
        return {"features": self.features, "objective": self.objective, "classes": self.classes, "scale": self.scale}

    def save(self, path: str) -> dict:
        self.table(SparkSession.getActiveSession()).coalesce(1).write.mode("overwrite").parquet(path)
        return self.head()

    @staticmethod
    def load(spark: SparkSession, path: str, head: dict) -> "Trees":
        pdf = spark.read.parquet(path).toPandas().sort_values("node")
        root = pdf.groupby("tree")["node"].min().to_numpy(np.int64)
        return Trees(**head, root=root, feature=pdf["feature"].to_numpy(np.int64), cut=pdf["cut"].to_numpy(float),
                     left=pdf["left"].to_numpy(np.int64), value=pdf["value"].to_numpy(float), gain=pdf["gain"].to_numpy(float))


def as_trees(grown: list[dict], b: Binned, p: Params, objective: str) -> Trees:
    size = np.array([len(t["feature"]) for t in grown], np.int64)
    root = np.r_[0, np.cumsum(size)[:-1]] if len(size) else np.zeros(0, np.int64)
    cat = lambda n, kind: np.concatenate([t[n] for t in grown]).astype(kind) if grown else np.zeros(0, kind)
    feature, place = cat("feature", np.int64), cat("cut", np.int64)
    left = cat("left", np.int64) + np.repeat(root, size)
    cut = np.array([b.cuts[f][c] if f >= 0 else np.nan for f, c in zip(feature, place)])
    scale = 1.0 / max(1, len(grown) // b.classes) if objective == "forest" else p.eta
    return Trees(b.features, objective, b.classes, scale, root, feature, cut, np.where(feature >= 0, left, -1),
                 cat("value", float), cat("gain", float))
