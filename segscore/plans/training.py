"""End-to-end fit (E1) and batch scoring.

fit: standardise → drop → correlation reduction → drop → power transform →
min-max → KMeans segments → segment classifier on the top features → one
recipe-driven model per segment → metric log → gate.

score: the same fitted steps replayed as projections; the classifier picks the
segment, each segment's prepared features ride along as one array, one
vectorised pass scores every row with its segment's model (J5), and the
segment's threshold decides. No checkpoint, no branches, no union.
"""

from __future__ import annotations

import itertools
import math
import random
import uuid
import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segscore.functions.scalar import qcol
from segscore.operators import boosting as B
from segscore.operators import learners as L
from segscore.operators import metrics, mlp, power, reduction, resample, scalers, segment, split, stacking
from segscore.operators.columns import drop_lenient, drop_strict
from segscore.plans.recipes import Recipe
from segscore.session import cut_lineage


# ------------------------------------------------------------------ global preprocessing
@dataclass
class GlobalPrep:
    features: list[str]
    scaler: list
    drops: list[str]
    steps: list
    post_drop: list[str]
    power: list
    minmax: list
    out: list[str]


def fit_global(df: DataFrame, features: list[str], drops=(), lo_hi=(0.8, 0.95), post_drop=()) -> GlobalPrep:
    sc = scalers.standard_params_list(df, features)
    z = drop_strict(scalers.apply_standard(df, sc), list(drops))
    feats = [f for f in features if f not in drops]
    steps = reduction.fit_reduction(z, feats, *lo_hi)
    red = drop_lenient(reduction.apply_reduction(z, steps, feats), list(post_drop))
    cols = [c for c in reduction.reduced_columns(steps, feats) if c not in post_drop]
    pw = [tuple(r) for r in power.fit_power(red, cols).orderBy("pos").collect()]
    p2 = power.apply_power(red, pw)
    mm = scalers.minmax_params_list(p2, cols)
    return GlobalPrep(features, sc, list(drops), steps, list(post_drop), pw, mm, cols)


def apply_global(df: DataFrame, g: GlobalPrep, passthrough=("id", "label")) -> DataFrame:
    keep = [c for c in passthrough if c in df.columns]
    z = drop_lenient(scalers.apply_standard(df, g.scaler, passthrough=keep), g.drops)
    feats = [f for f in g.features if f not in g.drops]
    red = drop_lenient(reduction.apply_reduction(z, g.steps, feats, passthrough=keep), g.post_drop)
    return scalers.apply_minmax(power.apply_power(red, g.power, passthrough=keep), g.minmax, passthrough=keep)


# ------------------------------------------------------------------ searches
#: Candidate keys that are parameters of a tree ensemble.
_TREE_KEYS = ("depth", "eta", "subsample", "colsample", "positive", "child", "gamma")


def tree_params(c: dict, **more) -> B.Params:
    own = {k: type(getattr(B.Params, k))(c[k]) for k in _TREE_KEYS if k in c}
    return B.Params(rounds=(int(c.get("rounds", 100)),), **{"eta": 0.3, "depth": 6, **own, **more})


def candidates(space: dict, n_iter: int = 0, seed: int = 42) -> list[dict]:
    """The full product of lists, or ``n_iter`` seeded draws; a value of a draw
    is a list (choice) or an ('int', low, high) or ('uniform', low, width) tuple."""
    if not n_iter:
        return [dict(zip(space, values)) for values in itertools.product(*space.values())]
    rng = random.Random(seed)

    def draw(spec):
        if isinstance(spec, tuple) and spec[0] == "int":
            return rng.randrange(spec[1], spec[2])
        if isinstance(spec, tuple) and spec[0] == "uniform":
            return spec[1] + rng.random() * spec[2]
        return rng.choice(list(spec))

    return [{k: draw(v) for k, v in space.items()} for _ in range(n_iter)]


def cross_validated(table: B.Binned, cands: list[dict], folds: list[int], objective: str = "binary") -> list[float]:
    """Mean metric of every candidate over the left-out ``folds`` (NaN folds
    count as the worst). Candidates that differ in the number of trees alone
    are one model a fold, read at several lengths."""
    merged: dict[B.Params, set[int]] = {}
    for c in cands:
        merged.setdefault(replace(tree_params(c), rounds=()), set()).add(int(c.get("rounds", 100)))
    models = [replace(p, rounds=tuple(sorted(n)), fold=f) for p, n in merged.items() for f in folds]
    got: dict[tuple, list[float]] = {}
    for m, values in zip(models, B.search(table, models, objective)):
        for n, v in zip(m.rounds, values):
            got.setdefault((replace(m, rounds=(), fold=-1), n), []).append(v if math.isfinite(v) else -math.inf)
    means = {k: sum(v) / len(v) for k, v in got.items()}
    return [means[replace(tree_params(c), rounds=()), int(c.get("rounds", 100))] for c in cands]


def best_of(cands: list[dict], values: list[float]) -> dict:
    """The first candidate of the largest value."""
    return cands[max(range(len(cands)), key=values.__getitem__)]


# ------------------------------------------------------------------ segment classifier
@dataclass
class SegmentClassifier:
    features: list[str]
    model: B.Trees
    params: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        return self.model.transform(df, out)


def fit_segment_classifier(df: DataFrame, features: list[str], top_n: int = 28, seed: int = 42,
                           search: tuple | None = None) -> tuple[SegmentClassifier, DataFrame]:
    """Softmax ensembles (M17). The best of the first grid by macro recall over
    five folds of the training part gives the ``top_n`` features of largest
    gain; the best of the second grid on those is the classifier, fitted on the
    training part. Returns it and its 5-fold metrics over all rows (A15)."""
    first, second = search or ({"rounds": [30], "depth": [3], "eta": [0.3]},) * 2
    data = df.select("id", F.col("cluster").alias("label"), *[qcol(f) for f in features])
    classes = int(data.agg(F.max("label")).first()[0] or 0) + 1
    marked = split.stratified_folds(split.stratified_split(data, 0.2, seed), 5, seed)
    marked = cut_lineage(marked.withColumn("_train", F.when(F.col("is_test"), F.lit(B.NEVER)).otherwise(F.col("fold"))))
    folds = list(range(5))

    def choose(columns: list[str], grid: dict) -> tuple[dict, B.Trees]:
        table = B.binned(marked, columns, fold="_train", classes=classes)
        cands = candidates(grid)
        best = cands[0] if len(cands) == 1 else best_of(cands, cross_validated(table, cands, folds, "softmax"))
        return best, B.fit(table, tree_params(best), "softmax")

    _, model = choose(features, first)
    gains = model.importances()
    top = [features[i] for i in sorted(range(len(features)), key=lambda i: (-gains[i], features[i]))[:top_n]]
    best, model = choose(top, second)
    whole = B.binned(marked, top, fold="fold", classes=classes)
    per_fold = B.fit_many(whole, [replace(tree_params(best), fold=f) for f in folds], "softmax")
    return SegmentClassifier(top, model, best), cv_metrics(marked, per_fold)


def cv_metrics(df: DataFrame, models: list[B.Trees]) -> DataFrame:
    """A15 of models that left fold 0, 1, ... out: accuracy and macro precision,
    recall and F1 of each fold, their mean and population sd; one pass over the rows."""
    scored = None
    for f, m in enumerate(models):
        part = m.transform(df.filter(F.col("fold") == f), "_p").select("fold", "label", "_p")
        scored = part if scored is None else scored.unionByName(part)
    counts = scored.filter("_p is not null").groupBy("fold", "label", "_p").agg(F.count(F.lit(1)).alias("n")).collect()  # folds x classes^2
    rows = []
    for f in range(len(models)):
        mine = [(r["label"], r["_p"], r["n"]) for r in counts if r["fold"] == f]
        names = sorted({c for a, p, _ in mine for c in (a, p)})
        if not names:
            continue
        m = np.zeros((len(names),) * 2)
        for a, p, n in mine:
            m[names.index(a), names.index(p)] += n
        hit, real, said = np.diag(m), m.sum(1), m.sum(0)
        precision, recall = hit / np.maximum(said, 1), hit / np.maximum(real, 1)
        f1 = 2 * hit / np.maximum(real + said, 1)
        rows.append((f, float(hit.sum() / m.sum()), float(precision.mean()), float(recall.mean()), float(f1.mean())))
    names = ["accuracy", "precision_macro", "recall_macro", "f1_macro"]
    per = df.sparkSession.createDataFrame(rows, "fold int, " + ", ".join(f"{c} double" for c in names))
    return per.agg(*[a(c).alias(f"{c}_{n}") for c in names for a, n in ((F.avg, "mean"), (F.stddev_pop, "std"))])


# ------------------------------------------------------------------ per-segment models
@dataclass
class SegmentModel:
    recipe: Recipe
    scaler: list
    drops: list[str]
    steps: list
    features: list[str]
    second: list | None      # scaler after the reduction, or none
    model: object            # Trees | Stack | ConstantModel
    threshold: float
    metrics: dict = field(default_factory=dict)
    params: dict = field(default_factory=dict)
    tags: dict = field(default_factory=dict)

    def prepare(self, df: DataFrame, base: list[str], keep: list[str]) -> DataFrame:
        """``keep`` and the model's inputs, from the segment's input columns ``base``."""
        if self.recipe.drop_before_scale:
            x = scalers.apply_standard(drop_lenient(df, self.drops), self.scaler, passthrough=keep)
        else:
            x = drop_lenient(scalers.apply_standard(df, self.scaler, passthrough=keep), self.drops)
        x = reduction.apply_reduction(x, self.steps, [f for f in base if f not in self.drops], passthrough=keep)
        return scalers.apply_standard(x, self.second, passthrough=keep) if self.second else x

    def inputs(self) -> list[str]:
        return self.model.features if self.model.features is not None else self.features


@dataclass
class ConstantModel:
    value: float
    features: list[str] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def resampler_of(name: str | None, feats: list[str]):
    if name is None:
        return None
    fn = {"adasyn": resample.adasyn, "smote_enn": resample.smote_enn, "smote_tomek": resample.smote_tomek,
          "smote": resample.smote}[name]
    return lambda d: fn(d.select("id", "label", *[qcol(f) for f in feats]), feats).drop("synthetic", "src_id", "syn_j")


def flag_top(scored: DataFrame, share: float) -> DataFrame:
    """A20 as a decision: exactly round(share * n) rows of the highest score get
    ``flag`` 1, equal scores by ascending id."""
    ranked = metrics.ranked(scored)
    k = int(round(share * scored.count()))
    return ranked.withColumn("flag", (F.col("rank") <= k).cast("int"))


def decide(rule: str, scored: DataFrame) -> tuple[float, dict]:
    """(threshold, metrics that go with it) of a rule on held-out scores. A share
    is flagged by rank; its threshold is the lowest flagged score, so scoring
    flags ties with it too."""
    kind, _, arg = rule.partition(":")
    if kind == "fixed":
        return float(arg), {"optimal_threshold": float(arg)}
    if kind in ("best_f1", "best_f2"):
        beta = 1.0 if kind == "best_f1" else 2.0
        r = metrics.best_threshold(scored, beta=beta, eps=1e-10 if beta == 1.0 else float(arg or 1e-6)).first()
        if r is None or r["threshold"] is None:
            return 0.5, {}
        at = metrics.pr_curve(scored).filter(F.col("threshold") == r["threshold"]).first()
        p, q = at["precision"], at["recall"]
        f = (1 + beta * beta) * p * q / max(beta * beta * p + q, 1e-12)
        return float(r["threshold"]), {f"f{int(beta)}_score": float(f)}
    if kind == "top_share":
        r = flag_top(scored, float(arg)).agg(
            F.min(F.when(F.col("flag") == 1, F.col("score"))).alias("t"), F.sum("flag").alias("k"),
            F.sum(F.col("flag") * F.col("label")).alias("hit"), F.sum("label").alias("p")).first()
        if r["t"] is None:
            return 0.5, {}
        return float(r["t"]), {"precision_topk": r["hit"] / r["k"] if r["k"] else 0.0, "recall_topk": r["hit"] / r["p"] if r["p"] else 0.0}
    raise ValueError(rule)


def _ap(scored: DataFrame) -> float:
    r = metrics.average_precision(scored).collect()
    return float(r[0][0]) if r and r[0][0] is not None else float("nan")


def scored_by(model, df: DataFrame) -> DataFrame:
    udf = stacking.scorer(df.sparkSession, model)
    return df.select("id", "label", udf(*[qcol(f).cast("double") for f in model.features]).alias("score"))


def select_features(train: DataFrame, feats: list[str], top_n: int, positive: float, seed: int = 42) -> list[str]:
    """The union of the ``top_n`` features of a forest, of boosted trees and
    of a perceptron's permutation importance, in order of name."""
    table = B.binned(train, feats)
    forest = B.fit(table, B.Params(rounds=(200,), depth=10, lam=0.0, features=max(1, int(np.sqrt(len(feats)))), bootstrap=True), "forest")
    trees = B.fit(table, B.Params(rounds=(100,), depth=6, eta=0.3, positive=positive))
    z = cut_lineage(scalers.apply_standard(train, scalers.standard_params_list(train, feats)))
    net = mlp.fit_many(mlp.matrix(z, feats), [mlp.Spec()])[0]
    by_net = L.top_features(mlp.permutation_importance(net, z, feats, 5, seed), top_n)
    by_gain = [[feats[i] for i in sorted(range(len(feats)), key=lambda i: (-g[i], feats[i]))[:top_n]] for g in (forest.importances(), trees.importances())]
    return L.feature_union([*by_gain, by_net])


def fit_segment_model(df: DataFrame, recipe: Recipe, seed: int = 42) -> SegmentModel:
    keep = ["id", "label"]
    base = [c for c in df.columns if c not in ("id", "label", "cluster")]
    drops = list(recipe.drops)
    missing = [d for d in drops if d not in base]
    if missing:
        raise KeyError(f"segment {recipe.segment}: columns to drop not found: {missing}")
    feats0 = [f for f in base if f not in drops]
    if recipe.drop_before_scale:
        sc = scalers.standard_params_list(df, feats0)
        x = scalers.apply_standard(drop_lenient(df, drops), sc, passthrough=keep)
    else:
        sc = scalers.standard_params_list(df, base)
        x = drop_lenient(scalers.apply_standard(df, sc, passthrough=keep), drops)
    steps = reduction.fit_reduction(x, feats0, *recipe.reduce) if recipe.reduce else []
    x = cut_lineage(reduction.apply_reduction(x, steps, feats0))
    feats = reduction.reduced_columns(steps, feats0)
    n_pos, n = x.agg(F.sum("label"), F.count(F.lit(1))).collect()[0]
    n_pos = int(n_pos or 0)
    sm = SegmentModel(recipe, sc, drops, steps, feats, None, ConstantModel(n_pos / max(n, 1)), 0.5,
                      {"rows": float(n), "positives": float(n_pos)}, {}, {"learner": recipe.learner, "segment": str(recipe.segment), **recipe.tags})
    if n_pos < 4 or n_pos > n - 4:
        warnings.warn(f"segment {recipe.segment}: too few rows of one class for a model; prior used")
        sm.tags["learner"] = "prior"
        return sm
    resampled = resampler_of(recipe.resampler, feats)

    def prepared(train: DataFrame, held: DataFrame | None = None) -> tuple[DataFrame, list | None, DataFrame | None]:
        """Second scaler and resampler of one training set; held-out rows are scaled alike."""
        params = None
        if recipe.second_scaler == "before":
            params = scalers.standard_params_list(train, feats)
            train = scalers.apply_standard(train, params)
        if resampled is not None:
            train = resampled(train)
        if recipe.second_scaler == "after":
            params = scalers.standard_params_list(train, feats)
            train = scalers.apply_standard(train, params)
        if held is not None and params is not None:
            held = scalers.apply_standard(held, params)
        cols = ["id", "label", *[qcol(f) for f in feats]]
        return cut_lineage(train.select(*cols)), params, None if held is None else held.select(*cols)

    def per_fold(d: DataFrame, mark: int) -> list[DataFrame]:
        """For each fold: the others prepared (fold -2), and its own rows (``mark``)."""
        def one(f: int) -> DataFrame:
            tr, _, held = prepared(d.filter(F.col("fold") != f).drop("fold"), d.filter(F.col("fold") == f).drop("fold"))
            return cut_lineage(tr.withColumn("fold", F.lit(-2)).unionByName(held.withColumn("fold", F.lit(mark))))
        return L.parallel_map(one, range(recipe.cv_folds), recipe.cv_folds)

    cands = candidates(recipe.search_space, recipe.n_iter) if recipe.search else [dict(recipe.learner_params)]
    if recipe.evaluation == "oof":
        d = cut_lineage(split.stratified_folds(x, recipe.cv_folds, seed))
        best = cands[0]
        parts = per_fold(d, 0)
        models = L.parallel_map(lambda part: B.fit(B.binned(part, feats, fold="fold"), replace(tree_params(best), fold=0)), parts, len(parts))
        oof = None
        for part, m in zip(parts, models):
            one = scored_by(m, part.filter("fold = 0"))
            oof = one if oof is None else oof.unionByName(one)
        oof = cut_lineage(oof)
        tr, sm.second, _ = prepared(x)
        sm.model = B.fit(B.binned(tr, feats), tree_params(best))
        sm.metrics["average_precision_score"] = _ap(oof)
        sm.threshold, more = decide(recipe.threshold, oof)
        sm.metrics.update(more)
        sm.params = best
        return sm

    s = split.stratified_split(x, 0.2, recipe.split_seed)
    train, test = cut_lineage(s.filter(~F.col("is_test")).drop("is_test")), cut_lineage(s.filter(F.col("is_test")).drop("is_test"))
    pos, neg = train.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    weight = (neg or 0) / pos * 1.5 if pos else 1.0  # F12
    if recipe.learner == "stack":
        feats = select_features(train, feats, recipe.select, weight, seed) if recipe.select else feats
        resampled = resampler_of(recipe.resampler, feats)
        best = cands[0]
        if len(cands) > 1:
            d = cut_lineage(split.stratified_folds(train.select("id", "label", *[qcol(f) for f in feats]), recipe.cv_folds, seed))

            def inner(part: DataFrame) -> list[float]:
                fit_rows = split.stratified_folds(part.filter(F.col("fold") == -2).drop("fold"), stacking.FOLDS, seed)
                return stacking.search(fit_rows.unionByName(part.filter(F.col("fold") == B.NEVER).select(*fit_rows.columns)), feats, cands, weight)

            folds = L.parallel_map(inner, per_fold(d, B.NEVER), recipe.cv_folds)
            best = best_of(cands, [sum(v if math.isfinite(v) else 0.0 for v in vs) / len(vs) for vs in zip(*folds)])
        tr, sm.second, held = prepared(train, test)
        sm.model = stacking.fit(split.stratified_folds(tr, stacking.FOLDS, seed), feats, best, weight)
        ranker = B.fit(B.binned(train, feats), B.Params(rounds=(int(recipe.learner_params.get("ranker_rounds", 100)),), depth=5, eta=0.1), "rank")
        sm.metrics["average_precision_score"] = _ap(scored_by(ranker, test))  # the recipe reports the ranker's
    else:
        objective = "rank" if recipe.learner == "ranker" else "binary"
        if recipe.search == "holdout_grid":  # chosen on the held-out part
            tr, sm.second, held = prepared(train, test)
            table = B.binned(tr.withColumn("fold", F.lit(-2)).unionByName(held.withColumn("fold", F.lit(0))), feats, fold="fold")
            best = best_of(cands, cross_validated(table, cands, [0], objective))
        elif recipe.search_on == "resampled":  # folds of the training part after it was resampled
            tr, sm.second, held = prepared(train, test)
            table = B.binned(split.stratified_folds(tr, recipe.cv_folds, seed), feats, fold="fold")
            best = best_of(cands, cross_validated(table, cands, list(range(recipe.cv_folds)), objective))
        else:  # scaled and resampled inside every fold
            d = cut_lineage(split.stratified_folds(train, recipe.cv_folds, seed))
            folds = L.parallel_map(lambda part: cross_validated(B.binned(part, feats, fold="fold"), cands, [0], objective), per_fold(d, 0), recipe.cv_folds)
            best = best_of(cands, [sum(vs) / len(vs) for vs in zip(*folds)])
            tr, sm.second, held = prepared(train, test)
        sm.model = B.fit(B.binned(tr, feats), tree_params(best), objective)
    scored = cut_lineage(scored_by(sm.model, held))  # the test part is scored once
    sm.metrics.setdefault("average_precision_score", _ap(scored))
    sm.threshold, more = decide(recipe.threshold, scored)
    sm.metrics.update(more)
    sm.params = best
    return sm


# ------------------------------------------------------------------ whole flow
@dataclass
class Trained:
    prep: GlobalPrep
    segmenter: segment.Segmenter
    classifier: SegmentClassifier
    models: dict
    metric_log: DataFrame


def fit_segments(df: DataFrame, features: list[str], k: int = 5, kseed: int = 2, drops=(),
                 post_drop=()) -> tuple[GlobalPrep, segment.Segmenter, DataFrame]:
    """The steps before the models: global preparation, segments, and the rows with their segment."""
    # every fitting pass reads the feature table: materialise it once
    df = cut_lineage(df.select("id", "label", *[qcol(f) for f in features]))
    prep = fit_global(df, features, drops, (0.8, 0.95), post_drop)
    mm = cut_lineage(apply_global(df, prep))
    seg = segment.fit_kmeans(mm, prep.out, k=k, seed=kseed)
    return prep, seg, cut_lineage(segment.assign(mm, seg))


def fit_all(df: DataFrame, features: list[str], recipes: dict[int, Recipe], k: int = 5, kseed: int = 2,
            drops=(), post_drop=(), parallelism: int = 6, classifier_search: tuple | None = None) -> Trained:
    spark = df.sparkSession
    prep, seg, clustered = fit_segments(df, features, k, kseed, drops, post_drop)
    # the classifier and the segments are independent: fitted from a small
    # thread pool, so that their jobs interleave on the executors
    work = [lambda: fit_segment_classifier(clustered.filter("cluster is not null"), prep.out, search=classifier_search)]
    work += [lambda c=c: fit_segment_model(clustered.filter(F.col("cluster") == c).drop("cluster"), recipes[c]) for c in range(k)]
    (clf, cvm), *fitted = L.parallel_map(lambda f: f(), work, parallelism)
    models = dict(zip(range(k), fitted))
    run = uuid.uuid4().hex[:12]
    cv = cvm.first().asDict()
    rows = [(run, "classifier", "metric", k2, str(v)) for k2, v in {**cv, "accuracy": cv["accuracy_mean"]}.items()]
    rows += [(run, "classifier", "param", k2, str(v)) for k2, v in clf.params.items()]
    rows += [(run, "classifier", "tag", k2, str(v)) for k2, v in {"stage": "classification", "input_features": len(clf.features)}.items()]
    for c, sm in models.items():
        for kind, entries in (("metric", {**sm.metrics, "threshold": sm.threshold}), ("param", sm.params), ("tag", sm.tags)):
            rows += [(run, f"segment_{c}", kind, key, str(v)) for key, v in entries.items()]
    log = spark.createDataFrame(rows, "run_id string, model string, kind string, key string, value string")
    return Trained(prep, seg, clf, models, log)


def gate(t: Trained, accuracy_min: float, ap_min: float) -> DataFrame:
    """A28 over the metric log: missing metrics fail."""
    m = t.metric_log.filter(F.col("key").isin("accuracy", "average_precision_score")).select(
        "model", F.when(F.col("key") == "accuracy", "accuracy").otherwise("average_precision").alias("metric"),
        F.col("value").cast("double").alias("value"))
    expected = [("classifier", "accuracy")] + [(f"segment_{c}", "average_precision") for c in t.models]
    return metrics.metric_gate(m, {"accuracy": accuracy_min, "average_precision": ap_min}, expected=expected)


def score(df: DataFrame, t: Trained) -> DataFrame:
    """``(id, cluster, score, prediction)`` for every input row. A row with
    a missing feature cannot be placed: its cluster, score and prediction are NULL."""
    g = apply_global(df, t.prep, passthrough=("id",))
    g = t.classifier.transform(g, "_cluster")
    base = t.prep.out
    own = {f: f"_o{i}" for i, f in enumerate(base)}
    x = g.select("id", F.col("_cluster"), *[qcol(f).alias(o) for f, o in own.items()])
    kept = ["id", "_cluster", *own.values()]
    for c, m in t.models.items():  # one more array of prepared features a segment
        y = m.prepare(x.select(*kept, *[F.col(o).alias(f) for f, o in own.items()]), base, kept)
        x = y.select(*kept, F.array(*[qcol(f).cast("double") for f in m.model.features]).cast("array<double>").alias(f"_s{c}"))
        kept = [*kept, f"_s{c}"]
    shared = df.sparkSession.sparkContext.broadcast({c: m.model for c, m in t.models.items()})
    order = list(t.models)

    def by_segment(cols: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for cluster, *arrays in cols:
            out = np.full(len(cluster), np.nan)
            which = cluster.to_numpy(float)
            for c, a in zip(order, arrays):
                rows = np.flatnonzero(which == c)
                if len(rows):
                    wanted = np.stack(a.iloc[rows].to_list()).astype(float) if len(a.iloc[rows[0]]) else np.zeros((len(rows), 0))
                    out[rows] = shared.value[c].scores(wanted)
            yield pd.Series(out).astype(object).where(~np.isnan(out), None)

    udf = F.pandas_udf(by_segment, "double")
    limits = F.create_map(*[F.lit(v) for c, m in t.models.items() for v in (int(c), float(m.threshold))])
    out = x.select("id", F.col("_cluster").alias("cluster"), udf("_cluster", *[f"_s{c}" for c in order]).alias("score"))
    return out.withColumn("prediction", (F.col("score") >= limits[F.col("cluster")]).cast("int"))
