"""Learners, searches and importances on Spark ML.

Folds come from ``split.stratified_folds`` (a column, so ``CrossValidator``
uses ``foldCol`` and every candidate sees the same stratified folds).
Resampling happens only on the fitting side of a fold; scoring never
resamples. Average precision is evaluated exactly (A16/A17), not Spark's
interpolated ``areaUnderPR``.
"""

from __future__ import annotations

import itertools
import random
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segscore.functions.scalar import qcol
from segscore.operators import metrics
from segscore.operators.ranking import global_running
from segscore.session import cut_lineage

VEC = "features"


def safe_names(features: list[str]) -> list[str]:
    return [f"_v{i}" for i in range(len(features))]


def assemble(df: DataFrame, features: list[str], keep: list[str] = ("id", "label")) -> DataFrame:
    """Features (any names) → one vector column; id/label/fold ride along."""
    s = safe_names(features)
    tmp = df.select(*[qcol(c) for c in df.columns if c in keep or c in ("fold", "weight", "is_test")],
                    *[qcol(f).cast("double").alias(n) for f, n in zip(features, s)])
    return VectorAssembler(inputCols=s, outputCol=VEC, handleInvalid="skip").transform(tmp).drop(*s)


def positive_score(pred: DataFrame, prob: str = "probability", out: str = "score") -> DataFrame:
    """P(class 1) from a probability vector (or the regression prediction)."""
    if prob in pred.columns:
        return pred.withColumn(out, vector_to_array(F.col(prob))[1])
    return pred.withColumn(out, F.col("prediction"))


class AveragePrecisionEvaluator(Evaluator):
    """Exact (non-interpolated) AP over distinct scores, larger is better."""

    def __init__(self, labelCol: str = "label", probabilityCol: str = "probability"):
        super().__init__()
        self.labelCol, self.probabilityCol = labelCol, probabilityCol

    def _evaluate(self, dataset: DataFrame) -> float:
        s = positive_score(dataset, self.probabilityCol)
        r = metrics.average_precision(s, "score", self.labelCol).collect()
        return float(r[0][0]) if r and r[0][0] is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True


# ------------------------------------------------------------------ estimators
def boosted_binary(max_iter=50, max_depth=3, step=0.1, subsample=1.0, subset="all", min_instances=1,
                   min_gain=0.0, weight: bool = False, seed=42) -> GBTClassifier:
    g = GBTClassifier(featuresCol=VEC, labelCol="label", maxIter=max_iter, maxDepth=max_depth, stepSize=step,
                      subsamplingRate=subsample, featureSubsetStrategy=subset, minInstancesPerNode=min_instances,
                      minInfoGain=min_gain, seed=seed)
    if weight:
        g.setWeightCol("weight")
    return g


def boosted_multiclass(max_iter=20, max_depth=3, step=0.1, subsample=1.0, seed=42, parallelism=4, subset="all") -> OneVsRest:
    """One binary boosted model per class (K× the work of one)."""
    return OneVsRest(classifier=boosted_binary(max_iter, max_depth, step, subsample, subset, seed=seed),
                     featuresCol=VEC, labelCol="label", parallelism=parallelism)


def random_forest(n_trees=200, max_depth=10, seed=42) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=VEC, labelCol="label", numTrees=n_trees, maxDepth=max_depth, seed=seed)


def mlp(n_features: int, hidden=100, n_classes=2, max_iter=500, step=0.001, seed=42) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(featuresCol=VEC, labelCol="label", layers=[n_features, hidden, n_classes],
                                          maxIter=max_iter, stepSize=step, seed=seed, solver="l-bfgs")


def logistic(max_iter=1000) -> LogisticRegression:
    return LogisticRegression(featuresCol=VEC, labelCol="label", maxIter=max_iter)


def add_class_weight(df: DataFrame, factor: float = 1.5, label: str = "label") -> DataFrame:
    """F12 as a ``weight`` column: positives weigh neg/pos·factor."""
    w = metrics_ratio(df, label) * factor
    return df.withColumn("weight", F.when(qcol(label) == 1, F.lit(w)).otherwise(F.lit(1.0)))


def metrics_ratio(df: DataFrame, label: str = "label") -> float:
    r = df.agg(F.sum((qcol(label) == 0).cast("long")), F.sum((qcol(label) == 1).cast("long"))).collect()[0]
    return float(r[0]) / float(r[1]) if r[1] else 1.0


# ------------------------------------------------------------------ search
def grid(est, space: dict) -> list:
    """M9: full product of ``{param_name: values}``."""
    b = ParamGridBuilder()
    for name, values in space.items():
        b = b.addGrid(est.getParam(name), list(values))
    return b.build()


def random_grid(est, space: dict, n_iter: int, seed: int = 42) -> list:
    """``n_iter`` seeded draws; a value spec is a list (choice), or a
    ('int', lo, hi) / ('uniform', lo, width) tuple."""
    rng = random.Random(seed)
    out = []
    for _ in range(n_iter):
        pm = {}
        for name, spec in space.items():
            if isinstance(spec, tuple) and spec[0] == "int":
                v = rng.randrange(spec[1], spec[2])
            elif isinstance(spec, tuple) and spec[0] == "uniform":
                v = spec[1] + rng.random() * spec[2]
            else:
                v = rng.choice(list(spec))
            pm[est.getParam(name)] = v
        out.append(pm)
    return out


def cross_validator(est, maps: list, evaluator: Evaluator, parallelism: int = 4, seed: int = 42) -> CrossValidator:
    return CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=evaluator, foldCol="fold",
                          parallelism=parallelism, seed=seed)


def best_params(cv_model, maps: list) -> tuple[dict, float]:
    avg = list(cv_model.avgMetrics)
    i = max(range(len(avg)), key=lambda j: avg[j])
    return {p.name: v for p, v in maps[i].items()}, float(avg[i])


def parallel_map(fn, items, parallelism: int = 4) -> list:
    """Run independent Spark jobs (one per item) from a small thread pool;
    the scheduler interleaves their tasks on the executors."""
    from concurrent.futures import ThreadPoolExecutor
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as ex:
        return list(ex.map(fn, items))


def cross_validate(est, data: DataFrame, k: int = 5, parallelism: int = 5) -> DataFrame:
    """M11 + A15: fit per fold, score the held-out fold, then accuracy and
    macro precision/recall/F1 per fold, their mean and population sd.

    The rows are materialised once, in at most a partition a core: fits run
    hundreds of jobs over them, and every task's result goes to the driver."""
    data = cut_lineage(data.coalesce(data.sparkSession.sparkContext.defaultParallelism))

    def one(f):
        model = est.fit(data.filter(F.col("fold") != f))
        pred = model.transform(data.filter(F.col("fold") == f))
        rep = {r["class"]: r for r in metrics.classification_report(pred, "label", "prediction").collect()}
        return (f, rep["accuracy"]["f1"], rep["macro avg"]["precision"], rep["macro avg"]["recall"],
                rep["macro avg"]["f1"])
    rows = parallel_map(one, range(k), parallelism)
    per = data.sparkSession.createDataFrame(rows, "fold int, accuracy double, precision_macro double, "
                                                  "recall_macro double, f1_macro double")
    aggs = []
    for c in ["accuracy", "precision_macro", "recall_macro", "f1_macro"]:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return per.agg(*aggs)


def out_of_fold_scores(est, data: DataFrame, features: list[str], k: int = 5, resampler=None,
                       parallelism: int = 5) -> DataFrame:
    """For each fold, (optionally) resample the other folds, fit, score
    the held-out fold; the union has one score per input row."""
    def one(f):
        train = data.filter(F.col("fold") != f)
        if resampler is not None:
            train = resampler(train)
        model = est.fit(assemble(train, features))
        pred = positive_score(model.transform(assemble(data.filter(F.col("fold") == f), features)))
        return pred.select("id", "label", "score")
    outs = [cut_lineage(o) for o in parallel_map(one, range(k), parallelism)]
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


# ------------------------------------------------------------------ importances
def importances(model, features: list[str]) -> DataFrame:
    """Impurity importances as a table, largest first (ties by name); of
    one-vs-rest models their mean."""
    parts = [m.featureImportances.toArray() for m in getattr(model, "models", [model])]
    imp = sum(parts) / len(parts)
    spark = SparkSession.getActiveSession()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def top_features(imp: DataFrame, n: int) -> list[str]:
    """K2/K3."""
    return [r["feature"] for r in imp.orderBy(F.desc("importance"), "feature").limit(n).collect()]


def permute_column(df: DataFrame, col: str, seed: int, id_col: str = "id") -> DataFrame:
    """Shuffle one column: rank rows by id and by a seeded hash of id, and
    hand each row the value at its hash rank — two range-partitioned ranks
    and an equi-join, no collect."""
    a = global_running(df, [qcol(id_col).asc()], rank_col="_ra")
    h = F.md5(F.concat_ws(":", qcol(id_col).cast("string"), F.lit(str(seed)), F.lit(col)))
    b = global_running(df.select(qcol(id_col).alias("_pid"), qcol(col).alias("_pv"), h.alias("_h")),
                       [F.col("_h").asc(), F.col("_pid").asc()], rank_col="_ra")
    return a.drop(col).join(b.select("_ra", F.col("_pv").alias(col)), "_ra").drop("_ra")


def permutation_importance(model, data: DataFrame, features: list[str], repeats: int = 5, seed: int = 42,
                           scorer=None) -> DataFrame:
    """Mean drop of the score (accuracy by default) when one column is
    permuted; one scoring job per (feature, repeat)."""
    scorer = scorer or (lambda p: MulticlassClassificationEvaluator(metricName="accuracy", labelCol="label").evaluate(p))
    base = scorer(model.transform(assemble(data, features)))
    rows = []
    for j, f in enumerate(features):
        drops = []
        for rep in range(repeats):
            perm = permute_column(data, f, seed + rep)
            drops.append(base - scorer(model.transform(assemble(perm, features))))
        rows.append((f, sum(drops) / len(drops)))
    return data.sparkSession.createDataFrame(rows, "feature string, importance double")


def feature_union(selected: list[list[str]]) -> list[str]:
    """Union of the selected sets, sorted by name (stable order)."""
    return sorted(set(itertools.chain.from_iterable(selected)))


# ------------------------------------------------------------------ stacking (M23) and resampling pipeline
@dataclass
class StackModel:
    bases: list
    meta: object
    features: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        x = assemble(df, self.features)
        out = df.select("id", *[qcol(f) for f in self.features], *[c for c in ("label", "cluster") if c in df.columns])
        for i, m in enumerate(self.bases):
            s = positive_score(m.transform(x)).select("id", F.col("score").alias(f"_base{i}"))
            out = out.join(s, "id")
        z = assemble(out, [f"_base{i}" for i in range(len(self.bases))] + self.features,
                     keep=["id", "label", "cluster"])
        return self.meta.transform(z)


def fit_stack(bases: list, meta, data: DataFrame, features: list[str], k: int = 5) -> StackModel:
    """Out-of-fold P(1) of each base (M12) + passthrough features →
    logistic meta-learner; bases refitted on all rows for scoring."""
    oof = data.select("id", "label", *[qcol(f) for f in features])
    scores = [out_of_fold_scores(b, data, features, k) for b in bases]
    for i, sdf in enumerate(scores):
        oof = oof.join(sdf.select("id", F.col("score").alias(f"_base{i}")), "id")
    meta_model = meta.fit(assemble(oof, [f"_base{i}" for i in range(len(bases))] + features))
    fitted = parallel_map(lambda b: b.fit(assemble(data, features)), bases, len(bases))
    return StackModel(fitted, meta_model, features)


@dataclass
class FittedChain:
    """Apply side of M24: scaler parameters (or none) → model → P(1)."""
    features: list[str]
    scaler: list | None
    model: object

    def transform(self, df: DataFrame) -> DataFrame:
        from segscore.operators.scalers import apply_standard
        x = apply_standard(df, self.scaler, passthrough=list(df.columns)) if self.scaler else df
        keep = [c for c in x.columns if c not in self.features]
        return positive_score(self.model.transform(assemble(x, self.features, keep=keep)))


@dataclass
class ResamplingPipeline:
    """Scale → resample → model (``scale='before'``) or resample →
    scale → model (``scale='after'``); resampling runs on the fit path only."""
    features: list[str]
    estimator: object
    resampler: object = None
    scale: str | None = "before"

    def fit(self, df: DataFrame) -> FittedChain:
        from segscore.operators.scalers import apply_standard, standard_params_list
        cur, params = df, None
        if self.scale == "before":
            params = standard_params_list(cur, self.features)
            cur = apply_standard(cur, params)
        if self.resampler is not None:
            cur = self.resampler(cur)
        if self.scale == "after":
            params = standard_params_list(cur, self.features)
            cur = apply_standard(cur, params, passthrough=list(cur.columns))
        model = self.estimator.fit(assemble(cur, self.features))
        return FittedChain(self.features, params, model)


# ------------------------------------------------------------------ ranker (M19) and regression
@dataclass
class BipartiteRanker:
    """Boosted trees on the exponential pairwise loss, the sum of
    ``exp(f(negative) − f(positive))`` over all positive × negative pairs.

    The sum factorises into ``Σ exp(−f)`` over positives times ``Σ exp(f)``
    over negatives, so its exact gradient needs no pairs: in every round a
    positive weighs ``exp(−f)`` and a negative ``exp(f)``, each class scaled
    to the same total, and a weighted regression tree is grown on ±1. A leaf
    that predicts p moves the score by ``step · ½ ln((1 + p) / (1 − p))``, p
    held to ±``EDGE``. Scores are checkpointed every ``CUT`` rounds. With one
    class only, every score is 0."""
    max_iter: int = 100
    max_depth: int = 5
    step: float = 0.1
    seed: int = 42

    EDGE = 0.999
    CUT = 5

    def _move(self, prediction: str) -> str:
        held = f"greatest(-{self.EDGE}D, least({self.EDGE}D, {prediction}))"
        return f"{self.step}D * 0.5D * ln((1D + {held}) / (1D - {held}))"

    def fit(self, df: DataFrame) -> PipelineModel:
        """``df`` has ``features`` (vector) and a 0/1 ``label``; the model adds ``prediction``."""
        cur = cut_lineage(df.filter("label is not null").select(
            VEC, (F.col("label") * 2.0 - 1.0).alias("_y"), F.lit(0.0).alias("_f")))
        rows = cur.count()
        stages = []
        for i in range(self.max_iter):
            loss = F.exp(-F.col("_y") * F.col("_f"))
            totals = {r["_y"]: r["s"] for r in cur.groupBy("_y").agg(F.sum(loss).alias("s")).collect()}
            if len(totals) < 2:
                break
            share = F.when(F.col("_y") > 0, F.lit(rows / totals[1.0])).otherwise(F.lit(rows / totals[-1.0]))
            tree = DecisionTreeRegressor(featuresCol=VEC, labelCol="_y", weightCol="_w", predictionCol=f"_r{i}",
                                         maxDepth=self.max_depth, seed=self.seed + i)
            model = tree.fit(cur.withColumn("_w", loss * share))
            stages.append(model)
            cur = model.transform(cur).select(VEC, "_y", (F.col("_f") + F.expr(self._move(f"_r{i}"))).alias("_f"))
            if (i + 1) % self.CUT == 0:
                cur = cut_lineage(cur)
        names = [f"_r{i}" for i in range(len(stages))]
        total = " + ".join(self._move(n) for n in names) or "0D"
        stages.append(SQLTransformer(statement=f"SELECT *, {total} AS prediction FROM __THIS__"))
        if names:
            stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(names)}) FROM __THIS__"))
        return PipelineModel(stages)


def pointwise_ranker(max_iter=100, max_depth=5, step=0.1, seed=42) -> GBTRegressor:
    """The cheaper ranker of the fitted flow: a boosted regressor on the 0/1
    label, whose prediction serves as ranking score."""
    return GBTRegressor(featuresCol=VEC, labelCol="label", maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=seed)


def boosted_regressor(target: str, max_iter=50, max_depth=3, seed=42) -> GBTRegressor:
    """M25 re-aim: one feature regressed on another."""
    return GBTRegressor(featuresCol=VEC, labelCol=target, maxIter=max_iter, maxDepth=max_depth, seed=seed)

