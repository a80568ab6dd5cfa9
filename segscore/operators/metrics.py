"""Threshold and ranking metrics.

Curves are built on distinct scores: rows are first reduced to
``(group, score, pos, neg)`` by a grouped aggregate (map-side combined, so a
score shared by a third of all rows is one row per task after the partial
step), then running sums use the range-partitioned global order from
``ranking.global_running`` instead of a single-task window.

Conventions (sklearn's): a curve point per distinct score, thresholds are
real scores only (no appended (1, 0) point); AP = Σ (R_k - R_{k-1}) P_k
without interpolation; argmax ties go to the smallest threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segscore.functions.scalar import qcol
from segscore.operators.ranking import global_running
from segscore.session import conf_int

MAX_BROADCAST_GROUPS = 100_000


def _attach(df: DataFrame, totals: DataFrame, by: list[str]) -> DataFrame:
    """Join per-group totals (a NULL key is a group); with no grouping the
    single row becomes literals."""
    if not by:
        row = totals.collect()[0]
        return df.select("*", *[F.lit(row[c]).alias(c) for c in totals.columns])
    n = totals.count()
    cap = conf_int(df.sparkSession, "segscore.metrics.maxBroadcastGroups", MAX_BROADCAST_GROUPS)
    t = totals.withColumnsRenamed({c: f"_t_{c}" for c in by})
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    return df.join(F.broadcast(t) if n <= cap else t, on).drop(*[f"_t_{c}" for c in by])


def score_counts(df: DataFrame, score: str = "score", label: str = "label", by: list[str] = ()) -> DataFrame:
    by = list(by)
    y = qcol(label).cast("long")
    return df.filter(qcol(score).isNotNull()).groupBy(*by, qcol(score).alias("threshold")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")
    )


def pr_curve(df: DataFrame, score: str = "score", label: str = "label", by: list[str] = ()) -> DataFrame:
    """``(by…, threshold, pos, neg, tp, fp, precision, recall)``."""
    by = list(by)
    c = score_counts(df, score, label, by)
    run = global_running(c, [F.col("threshold").desc()], values=["pos", "neg"], partition_by=by)
    tot = c.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    run = _attach(run, tot, by)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    return run.select(
        *by, "threshold", "pos", "neg", tp.alias("tp"), fp.alias("fp"), "P", "N",
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
        F.when(F.col("P") > 0, tp / F.col("P")).otherwise(F.lit(1.0)).alias("recall"),
    )


def average_precision(df: DataFrame, score: str = "score", label: str = "label", by: list[str] = ()) -> DataFrame:
    """Σ_k (pos_k / P) · precision_k over distinct thresholds; NULL for a
    group without positives."""
    by = list(by)
    c = pr_curve(df, score, label, by)
    return c.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("pos") * F.col("precision")), F.first("P")).alias("average_precision")
    )


def roc_auc(df: DataFrame, score: str = "score", label: str = "label", by: list[str] = ()) -> DataFrame:
    """Tie-aware AUC = Σ_s pos_s·(neg below s + ½ neg_s) / (P·N); NULL for
    a group of one class."""
    by = list(by)
    c = pr_curve(df, score, label, by)
    below = F.col("N") - F.col("fp")
    pairs = F.first("P").cast("double") * F.first("N").cast("double")  # as integers they overflow
    return c.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))), pairs).alias("roc_auc")
    )


def best_threshold(df: DataFrame, beta: float = 1.0, eps: float = 1e-10, score: str = "score",
                   label: str = "label", by: list[str] = ()) -> DataFrame:
    """Threshold maximising F_beta = (1+β²)PR/(β²P+R+eps);
    ties → smallest threshold."""
    by = list(by)
    c = pr_curve(df, score, label, by)
    b2 = beta * beta
    f = ((1 + b2) * F.col("precision") * F.col("recall")
         / (b2 * F.col("precision") + F.col("recall") + F.lit(eps)))
    c = c.withColumn("f", f)
    best = F.max_by(F.struct("threshold", "precision", "recall", "f"), F.struct(F.col("f"), -F.col("threshold")))
    return c.groupBy(*by).agg(best.alias("b")).select(
        *by, F.col("b.threshold").alias("threshold"), F.col("b.precision").alias("precision"),
        F.col("b.recall").alias("recall"), F.col("b.f").alias("f_score"),
    )


def cost_threshold(df: DataFrame, cost_fp: float = 1.0, cost_fn: float = 10.0, score: str = "score",
                   label: str = "label", by: list[str] = ()) -> DataFrame:
    """Threshold minimising cost_fp·FP + cost_fn·FN (flag = score ≥ t);
    ties → largest threshold (fewest flags)."""
    by = list(by)
    c = pr_curve(df, score, label, by)
    fn = F.col("P") - F.col("tp")
    c = c.withColumn("cost", F.lit(cost_fp) * F.col("fp") + F.lit(cost_fn) * fn).withColumn("fn", fn)
    best = F.min_by(F.struct("threshold", "fp", "fn", "cost"), F.struct(F.col("cost"), -F.col("threshold")))
    return c.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def ranked(df: DataFrame, score: str = "score", label: str = "label", id_col: str = "id") -> DataFrame:
    """W1 + W2: global position by score desc (id breaks ties) and the running
    count of positives."""
    base = df.select(qcol(id_col).alias(id_col), qcol(score).alias("score"), qcol(label).cast("long").alias("label"))
    return global_running(base, [F.col("score").desc(), F.col(id_col).asc()], values=["label"], rank_col="rank")


def precision_at_k(df: DataFrame, ks=(5, 10, 20), score: str = "score", label: str = "label", id_col: str = "id") -> DataFrame:
    """Share of positives among the k best-scored rows. Only the top
    max(k) rows are taken (per-task heaps, no global sort)."""
    kmax = max(ks)
    top = df.orderBy(qcol(score).desc(), qcol(id_col).asc()).limit(kmax)
    # ≤ max(k) rows: a global window over them is a single small task
    top = top.select(qcol(label).cast("long").alias("y"),
                     F.row_number().over(Window.orderBy(qcol(score).desc(), qcol(id_col).asc())).alias("r"))
    kk = F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("k")
    return top.select("*", kk).filter(F.col("r") <= F.col("k")).groupBy("k").agg(
        (F.sum("y") / F.col("k")).alias("precision_at_k")
    )


def top_share_flags(df: DataFrame, share: float = 0.2, score: str = "score", label: str = "label", id_col: str = "id") -> DataFrame:
    """The round(share·n) best rows (half to even, like Python) are
    flagged; precision and recall of that flag (NULL if no row is flagged, or
    none is positive)."""
    r = ranked(df, score, label, id_col)
    n = df.count()
    top_n = int(round(share * n))
    flag = (F.col("rank") <= F.lit(top_n)).cast("long")
    return r.agg(
        F.lit(top_n).cast("long").alias("top_n"),
        F.try_divide(F.sum(flag * F.col("label")), F.lit(top_n)).alias("precision_topk"),
        F.try_divide(F.sum(flag * F.col("label")), F.sum("label")).alias("recall_topk"),
    )


def gain_curve(df: DataFrame, score: str = "score", label: str = "label", id_col: str = "id") -> DataFrame:
    """Positives captured within the top k, for every k."""
    r = ranked(df, score, label, id_col)
    P = df.agg(F.sum(qcol(label).cast("long"))).collect()[0][0] or 0
    return r.select(
        F.col("rank"), F.col("cum_label").alias("gain"),
        (F.col("cum_label") / F.lit(float(P) if P else float("nan"))).alias("gain_share"),
    )


def ndcg_map(df: DataFrame, score: str = "score", label: str = "label", id_col: str = "id") -> DataFrame:
    """A24 over one group: binary-relevance NDCG and MAP of the ranking."""
    r = ranked(df, score, label, id_col)
    P = df.agg(F.sum(qcol(label).cast("long"))).collect()[0][0] or 0
    disc = F.lit(1.0) / F.log2(F.col("rank") + 1.0)
    return r.agg(
        (F.sum(F.col("label") * disc) / F.sum(F.when(F.col("rank") <= F.lit(P), disc))).alias("ndcg"),
        (F.sum(F.when(F.col("label") == 1, F.col("cum_label") / F.col("rank"))) / F.lit(P or None).cast("long")).alias("map"),
    )


def log_loss(df: DataFrame, prob: str = "p", label: str = "label", eps: float = 1e-15) -> DataFrame:
    """A25 (binary)."""
    p = F.least(F.greatest(qcol(prob), F.lit(eps)), F.lit(1 - eps))
    y = qcol(label).cast("double")
    return df.agg((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def multiclass_log_loss(df: DataFrame, prob_col: str = "probability", label: str = "label", eps: float = 1e-15) -> DataFrame:
    """A25 (multi-class): probability column is an array/vector of class
    probabilities, renormalised after clipping like sklearn."""
    from pyspark.ml.functions import vector_to_array
    pr = df.select(qcol(label).cast("int").alias("y"), vector_to_array(qcol(prob_col)).alias("pv"))
    clipped = F.transform("pv", lambda v: F.least(F.greatest(v, F.lit(eps)), F.lit(1 - eps)))
    pr = pr.select("y", clipped.alias("pc"))
    tot = F.aggregate("pc", F.lit(0.0), lambda a, v: a + v)
    return pr.agg((-F.avg(F.log(F.element_at("pc", F.col("y") + 1) / tot))).alias("log_loss"))


def confusion(df: DataFrame, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    """Counts per (actual, predicted)."""
    return df.groupBy(qcol(actual).alias("actual"), qcol(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    """Per-class precision/recall/F1/support, macro and weighted
    averages, accuracy — all from the confusion counts (one small table)."""
    cm = confusion(df, actual, predicted)
    # each confusion cell counts once for its actual class and once for its
    # predicted class: an unpivot, then one grouped sum (no join)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    roles = F.explode(F.array(
        F.struct(F.col("actual").alias("c"), hit.alias("tp"), F.lit(0).cast("long").alias("pred"), F.col("n").alias("support")),
        F.struct(F.col("predicted").alias("c"), F.lit(0).cast("long").alias("tp"), F.col("n").alias("pred"),
                 F.lit(0).cast("long").alias("support")),
    )).alias("x")
    per = cm.select(roles).select("x.*").groupBy("c").agg(
        F.sum("tp").alias("tp"), F.sum("pred").alias("pred"), F.sum("support").alias("support"))
    prec = F.when(F.col("pred") > 0, F.col("tp") / F.col("pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.select(F.col("c").cast("string").alias("class"), prec.alias("precision"), rec.alias("recall"),
                     "support", "tp")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(F.lit(0.0)))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("k"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                    F.sum("support").alias("support"), F.avg("f1").alias("f1"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                       F.sum("support").alias("support"),
                       (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))
    acc = tot.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), F.col("n").alias("support"),
                     (F.col("tp") / F.col("n")).alias("f1"))
    cols = ["class", "precision", "recall", "f1", "support"]
    return per.select(*cols).unionByName(macro.select(*cols)).unionByName(weighted.select(*cols)).unionByName(acc.select(*cols))


def metric_gate(metrics: DataFrame, gates: dict[str, float], missing: float | None = None,
                expected: list[tuple[str, str]] | None = None) -> DataFrame:
    """``metrics(model, metric, value)`` checked against per-metric
    minimums. It fails closed: a NULL or NaN value, an ``expected`` (model,
    metric) without a row, and a gate that no model has a value for (its row
    has a NULL model) all fail unless ``missing`` supplies a default; with no
    rows at all ``ALL`` fails. One row per model/metric plus an ``ALL`` row."""
    spark = metrics.sparkSession
    g = spark.createDataFrame([(m, float(v)) for m, v in gates.items()], "metric string, gate double")
    if expected is None:
        rows = F.broadcast(g).join(metrics, "metric", "left")  # gates: a handful of rows
    else:
        want = spark.createDataFrame([e for e in expected if e[1] in gates], "model string, metric string").join(F.broadcast(g), "metric")
        rows = want.join(metrics, ["model", "metric"], "left")
    value = F.nanvl(F.col("value").cast("double"), F.lit(None).cast("double"))
    checked = F.coalesce(value, F.lit(missing).cast("double")) if missing is not None else value
    rows = rows.select("model", "metric", checked.alias("value"), "gate",
                       F.coalesce(checked >= F.col("gate"), F.lit(False)).alias("passed"))
    allrow = rows.agg(F.lit("ALL").alias("model"), F.lit("all").alias("metric"),
                      F.lit(None).cast("double").alias("value"), F.lit(None).cast("double").alias("gate"),
                      F.coalesce(F.bool_and("passed"), F.lit(False)).alias("passed"))
    return rows.unionByName(allrow)
