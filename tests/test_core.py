import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from segscore.functions import validation
from segscore.operators import knn, metrics, power, ranking, reduction, resample, scalers, split, stats


def _df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_standard_and_minmax_edge_cases(spark):
    d = _df(spark, [(1, 0, 1.0, 5.0, None), (2, 1, 2.0, 5.0, 3.0), (3, 0, 3.0, 5.0, float("nan"))],
            "id long, label int, a double, c double, n double")
    p = {r["feature"]: r for r in scalers.fit_standard(d, ["a", "c", "n"]).collect()}
    assert p["a"]["std"] == pytest.approx(math.sqrt(2 / 3))  # population sd
    out = {r["id"]: r for r in scalers.apply_standard(d, scalers.fit_standard(d, ["a", "c", "n"])).collect()}
    assert out[1]["c"] == 0.0  # constant → 0
    assert out[1]["n"] is None and out[3]["n"] is None  # NaN is missing
    mm = {r["id"]: r for r in scalers.apply_minmax(d, scalers.fit_minmax(d, ["a", "c"])).collect()}
    assert mm[3]["a"] == 1.0 and mm[2]["c"] == 0.0  # constant → 0, not 0.5


def test_global_running_matches_window(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), int(g) or None, float(rng.integers(0, 5)), int(rng.integers(0, 2))) for i, g in
            zip(range(400), rng.integers(0, 4, 400))]  # NULL is a group of its own
    d = _df(spark, rows, "id long, g int, s double, y long").repartition(6)
    r = ranking.global_running(d, [F.col("s").desc(), F.col("id").asc()], values=["y"], partition_by=["g"],
                               rank_col="rk").toPandas()
    assert len(r) == 400 and r["g"].isna().any()
    for g, part in r.groupby("g", dropna=False):
        part = part.sort_values(["s", "id"], ascending=[False, True])
        assert list(part["rk"]) == list(range(1, len(part) + 1))
        assert list(part["cum_y"]) == list(np.cumsum(part["y"]))


def test_reduction_drop_fuse_and_signs(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=300)
    rows = [(i, 0, float(x[i]), float(x[i]), float(-x[i] + rng.normal() * 0.45), float(rng.normal()), 1.0)
            for i in range(300)]
    d = _df(spark, rows, "id long, label int, a double, b double, c double, e double, k double")
    steps = reduction.fit_reduction(d, ["a", "b", "c", "e", "k"], 0.8, 0.95)
    kinds = [(s.kind, s.feature_1, s.feature_2) for s in steps]
    assert ("drop", "a", "b") in kinds  # r = 1 → second member dropped
    fused = [s for s in steps if s.kind == "pca"]
    assert len(fused) == 1 and {fused[0].feature_1, fused[0].feature_2} == {"a", "c"}
    assert fused[0].w1 * fused[0].w2 < 0  # negative correlation → opposite signs
    cols = reduction.reduced_columns(steps, ["a", "b", "c", "e", "k"])
    assert cols == ["e", "k", "PCA_a_c"]  # constant column never paired
    out = reduction.apply_reduction(d, steps, ["a", "b", "c", "e", "k"]).toPandas()
    assert abs(out["PCA_a_c"].mean()) < 1e-9


def test_reduction_matches_fixture_sf0001(spark):
    from segscore.sources import fixtures as fx
    from tests.conftest import SF
    df = fx.customer_features(spark, SF)
    z = scalers.apply_standard(df, scalers.fit_standard(df, fx.CUSTOMER_FEATURES))
    st = reduction.fit_reduction(z, fx.CUSTOMER_FEATURES, 0.8, 0.95)
    assert [(s.kind, s.feature_1, s.feature_2) for s in st] == [
        ("drop", "gross", "net"), ("drop", "n_lines", "qty"), ("drop", "n_lines", "gross"),
        ("pca", "n_lines", "n_orders")]
    assert st[-1].w1 == pytest.approx(0.7071, abs=1e-3)


def _llf_bc(x, lam):
    y = np.log(x) if abs(lam) < 1e-12 else (x ** lam - 1) / lam
    return -len(x) / 2 * np.log(y.var()) + (lam - 1) * np.log(x).sum()


def test_power_transform_grid_optimum(spark):
    rng = np.random.default_rng(5)
    x = np.exp(rng.normal(size=500) * 0.8)
    d = _df(spark, [(i, 0, float(v), float(v) - 1.5) for i, v in enumerate(x)], "id long, label int, p double, q double")
    pr = {r["feature"]: r for r in power.fit_power(d, ["p", "q"]).collect()}
    assert pr["p"]["kind"] == "box-cox" and pr["q"]["kind"] == "yeo-johnson"
    grid = np.linspace(-2, 2, 40001)
    best = grid[np.argmax([_llf_bc(x, g) for g in grid])]
    assert pr["p"]["lambda"] == pytest.approx(best, abs=5e-4)
    out = power.apply_power(d, power.fit_power(d, ["p"])).toPandas()
    assert out["p"].mean() == pytest.approx(0, abs=1e-9) and out["p"].std(ddof=0) == pytest.approx(1, abs=1e-9)


def test_power_identity_for_symmetric_and_constant(spark):
    d = _df(spark, [(i, 0, float(i % 7), 2.0) for i in range(70)], "id long, label int, s double, c double")
    pr = {r["feature"]: r["kind"] for r in power.fit_power(d, ["s", "c"]).collect()}
    assert pr == {"s": "identity", "c": "identity"}


def test_knn_over_cells_is_brute_force(spark):
    """Many cells, sharp clusters, a far point, and copies that fill more than three leaves: distances and order of ids."""
    rng = np.random.default_rng(3)
    X = np.concatenate([rng.normal(size=(1500, 3)) * [100, 1, 0.01], rng.normal(size=(1000, 3)) + 50, np.full((60, 3), 7.0), [[1e6, 0, 0]]])
    rng.shuffle(X)
    spark.conf.set("segscore.knn.localCells", "0")
    try:
        d = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], "id long, a double, b double, c double").repartition(5)
        cells = knn.fit_cells(d.selectExpr("id as pid", "a as x0", "b as x1", "c as x2"), ["x0", "x1", "x2"], len(X), 512)
        got = knn.knn(d, ["a", "b", "c"], 4, query=F.col("id") % 3 == 0, block=1).collect()
    finally:
        spark.conf.unset("segscore.knn.localCells")
    assert len(cells.lo) > 3
    found = {}
    for r in sorted(got, key=lambda r: (r["qid"], r["rank"])):
        found.setdefault(r["qid"], []).append((r["dist"], r["nid"]))
    D = np.zeros((len(X),) * 2)
    for j in range(3):
        D += (X[:, None, j] - X[None, :, j]) ** 2
    D = np.sqrt(D)
    np.fill_diagonal(D, np.inf)
    assert sorted(found) == list(range(0, len(X), 3))
    for q, mine in found.items():
        best = np.argsort(D[q], kind="stable")[:4]
        assert mine == [(D[q, i], i) for i in best]


def test_knn_splits_a_cell_of_copies(spark):
    spark.conf.set("segscore.knn.localCells", "0")
    try:
        d = spark.range(3000).selectExpr("id", "1.0D as a", "2.0D as b")
        cells = knn.fit_cells(d.selectExpr("id as pid", "a as x0", "b as x1"), ["x0", "x1"], 3000, 512)
        got = knn.knn(d, ["a", "b"], 2, block=1).agg(F.count("qid"), F.countDistinct("qid"), F.max("dist"), F.min(F.abs(F.col("qid") - F.col("nid")))).first()
    finally:
        spark.conf.unset("segscore.knn.localCells")
    assert len(cells.lo) == cells.parts.sum() > 1
    assert (got[0], got[1], got[2]) == (6000, 3000, 0.0) and got[3] > 0


def test_cross_validation_fits_on_a_partition_a_core(spark):
    """However many partitions the rows come in, a fit's jobs have as many tasks as there are cores."""
    from segscore.operators import learners as L
    seen = []

    class Copies:
        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.count()))
            return self

        def transform(self, df):
            return df.withColumn("prediction", F.col("label"))

    cores = spark.sparkContext.defaultParallelism
    d = spark.range(0, 600, 1, 5 * cores).selectExpr("id", "cast(id % 2 as int) as label", "cast(id div 2 % 3 as int) as fold")
    r = L.cross_validate(Copies(), d, k=3).first()
    assert r["accuracy_mean"] == 1.0 and r["f1_macro_std"] == 0.0
    assert [n for _, n in seen] == [400] * 3 and all(p <= cores for p, _ in seen)


def _ap_bruteforce(y, s):
    order = np.argsort(-s, kind="stable")
    ys, ss = y[order], s[order]
    P = y.sum()
    ap, prev_r, i = 0.0, 0.0, 0
    while i < len(ss):
        j = i
        while j < len(ss) and ss[j] == ss[i]:
            j += 1
        tp = ys[:j].sum()
        r, p = tp / P, tp / j
        ap += (r - prev_r) * p
        prev_r, i = r, j
    return ap


def test_ap_and_auc_with_ties(spark):
    rng = np.random.default_rng(7)
    s = rng.integers(0, 8, 300).astype(float)
    y = (rng.random(300) < 0.1 + s / 20).astype(int)
    d = _df(spark, [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))], "id long, label int, score double")
    ap = metrics.average_precision(d).collect()[0][0]
    assert ap == pytest.approx(_ap_bruteforce(y, s), abs=1e-12)
    pos, neg = s[y == 1], s[y == 0]
    mw = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert metrics.roc_auc(d).collect()[0][0] == pytest.approx(mw, abs=1e-12)


def test_auc_of_more_pairs_than_an_int_holds(spark):
    # 60,000 positives x 60,000 negatives, three scores
    d = spark.range(120_000).select("id", (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 3).cast("double").alias("score"))
    assert metrics.roc_auc(d).collect()[0][0] == pytest.approx(0.5, abs=1e-12)


@pytest.mark.parametrize("block,bcast", [(4, True), (4, False), (256, True)])
def test_knn_exact_with_duplicates(spark, block, bcast):
    spark.conf.set("segscore.knn.maxBroadcastBlocks", "200000" if bcast else "0")
    spark.conf.set("segscore.knn.localCells", "0" if block < 256 else "400000")
    rng = np.random.default_rng(11)
    X = rng.normal(size=(120, 3))
    X[10:14] = X[9]  # exact duplicates
    d = _df(spark, [(i, 0, *map(float, X[i])) for i in range(120)], "id long, label int, a double, b double, c double")
    got = knn.knn(d, ["a", "b", "c"], 3, block=block).toPandas()
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    for q, g in got.groupby("qid"):
        exp = np.sort(D[q])[:3]
        assert np.allclose(np.sort(g["dist"].to_numpy()), exp)
    spark.conf.unset("segscore.knn.localCells")


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(13)
    rows = [(i, int(i < 12), float(rng.normal() + 3 * (i < 12)), float(rng.normal())) for i in range(80)]
    d = _df(spark, rows, "id long, label int, a double, b double")
    out = resample.smote(d, ["a", "b"], k=5, seed=42).toPandas()
    c = out.groupby("label").size()
    assert c[0] == c[1] == 68
    syn = out[out["synthetic"]]
    mn = out[(~out["synthetic"]) & (out["label"] == 1)]
    assert syn["a"].between(mn["a"].min() - 1e-9, mn["a"].max() + 1e-9).all()
    one = _df(spark, [(0, 1, 0.0, 0.0)] + [(i, 0, float(i), 1.0) for i in range(1, 9)], "id long, label int, a double, b double")
    with pytest.warns(UserWarning):
        assert resample.smote(one, ["a", "b"]).count() == 9


def test_validation_and_conform(spark):
    d = _df(spark, [(1, 1.0, 2e10, None), (2, float("inf"), 0.5, 1.0), (3, 0.1, 0.2, 0.3)],
            "id long, `Cash/Total Assets` double, `Tax rate (A)` double, `x'¥%?` double")
    f = ["Cash/Total Assets", "Tax rate (A)", "x'¥%?"]
    v = {r["id"]: r for r in validation.validate(d, f).collect()}
    assert v[1]["failed"] == "Tax rate (A),x'¥%?" and not v[1]["valid"]
    assert v[2]["failed"] == "Cash/Total Assets" and v[3]["valid"]
    c = validation.conform(d, f + ["missing one"]).collect()[0]
    assert c["missing one"] == 0.0
    with pytest.raises(ValueError):
        validation.conform(d, f + ["missing one"], missing="error")
    assert validation.snake("ROA(A) before interest and % after tax") == "roa_a_before_interest_and_after_tax"


def test_folds_disjoint_and_stratified(spark):
    d = _df(spark, [(i, int(i % 9 == 0)) for i in range(500)], "id long, label int")
    k = split.stratified_folds(d, 5, 42).toPandas()
    assert k["id"].is_unique
    per = k.groupby(["label", "fold"]).size().unstack()
    assert (per.max(axis=1) - per.min(axis=1)).max() <= 1
    s = split.stratified_split(d, 0.2, 42).toPandas()
    assert s.groupby("label")["is_test"].sum().to_dict() == {0: round(0.2 * 444), 1: round(0.2 * 56)}


def test_exact_quantiles_interpolate(spark):
    d = _df(spark, [(i, 0, float(v)) for i, v in enumerate([1, 2, 4, 9, 9, 30])], "id long, label int, x double")
    q = {r["q"]: r["value"] for r in stats.exact_quantiles(d, ["x"], [0.25, 0.5, 0.9]).collect()}
    assert q == pytest.approx({0.25: np.quantile([1, 2, 4, 9, 9, 30], 0.25),
                               0.5: 6.5, 0.9: np.quantile([1, 2, 4, 9, 9, 30], 0.9)})


def test_ap_evaluator_and_permutation(spark):
    from pyspark.ml.linalg import Vectors
    from segscore.operators import learners as L
    rows = [(i, int(i % 3 == 0), Vectors.dense([1 - (i % 7) / 7.0, (i % 7) / 7.0])) for i in range(60)]
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.IntegerType()),
                           T.StructField("probability", VectorUDT())])
    d = spark.createDataFrame(rows, schema)
    ev = L.AveragePrecisionEvaluator().evaluate(d)
    ref = metrics.average_precision(L.positive_score(d)).collect()[0][0]
    assert ev == pytest.approx(ref)
    t = _df(spark, [(i, 0, float(i)) for i in range(50)], "id long, label int, x double")
    p = L.permute_column(t, "x", seed=3).toPandas()
    assert sorted(p["x"]) == [float(i) for i in range(50)] and (p.sort_values("id")["x"].to_numpy() != np.arange(50)).any()


def test_ranking_without_groups(spark):
    d = _df(spark, [(i, float(i % 5)) for i in range(50)], "id long, s double")
    r = ranking.global_running(d, [F.col("s").asc(), F.col("id").asc()], rank_col="rk").toPandas()
    r = r.sort_values(["s", "id"])
    assert list(r["rk"]) == list(range(1, 51))


def test_rename_snake_fields_to_labels(spark):
    from segscore.plans.recipes import FEATURE_LABELS
    snakes = [validation.snake(n) for n in FEATURE_LABELS]
    assert len(set(snakes)) == len(FEATURE_LABELS) == 95
    d = spark.createDataFrame([tuple([1] + [0.5] * 95)], ", ".join(["id long"] + [f"{s} double" for s in snakes]))
    out = validation.rename_to_labels(d, FEATURE_LABELS)
    assert out.columns == ["id"] + FEATURE_LABELS
    assert validation.validate(out, FEATURE_LABELS).collect()[0]["valid"]


def test_metric_gate_fails_closed(spark):
    from segscore.operators import metrics
    schema = "model string, metric string, value double"
    gates = {"accuracy": 0.5, "average_precision": 0.1}

    def passed(rows, **kw):
        out = metrics.metric_gate(_df(spark, rows, schema), gates, **kw).collect()
        return {(r["model"], r["metric"]): r["passed"] for r in out}

    good = [("c", "accuracy", 0.9), ("s", "average_precision", 0.2)]
    assert passed(good)["ALL", "all"]
    assert not passed([])["ALL", "all"]
    assert not passed(good[:1])["ALL", "all"] and not passed(good[1:])["ALL", "all"]
    assert not passed([good[0], ("s", "average_precision", float("nan"))])["s", "average_precision"]
    assert not passed([good[0], ("s", "average_precision", None)])["ALL", "all"]
    assert not passed(good, expected=[("c", "accuracy"), ("s", "average_precision"), ("t", "average_precision")])["t", "average_precision"]
    assert passed(good, expected=[("c", "accuracy"), ("s", "average_precision")])["ALL", "all"]


def test_one_class_groups_give_null(spark):
    from segscore.operators import metrics
    d = _df(spark, [(i, "a" if i < 4 else "b", float(i % 3), int(i < 2)) for i in range(8)], "id long, g string, score double, label int")
    ap = {r["g"]: r["average_precision"] for r in metrics.average_precision(d, by=["g"]).collect()}
    auc = {r["g"]: r["roc_auc"] for r in metrics.roc_auc(d, by=["g"]).collect()}
    assert ap["b"] is None and auc["b"] is None and ap["a"] > 0 and auc["a"] is not None
    none = metrics.top_share_flags(d.limit(1), 0.2).first()
    assert none["top_n"] == 0 and none["precision_topk"] is None


def test_correlation_with_large_means(spark):
    from segscore.operators import correlation
    rng = np.random.default_rng(4)
    x = rng.normal(size=400)
    y = 0.8 * x + 0.5 * rng.normal(size=400)
    x, y = x + 1e9, y * 3 - 2e9
    d = _df(spark, [(float(a), float(b) if i % 7 else None) for i, (a, b) in enumerate(zip(x, y))], "a double, b double").repartition(3)
    keep = np.arange(400) % 7 != 0
    r = correlation.corr_long(d, ["a", "b"]).first()["corr"]
    assert r == pytest.approx(np.corrcoef(x[keep], y[keep])[0, 1], abs=1e-6)


def test_smote_is_complete_with_missing_features(spark):
    from segscore.operators import resample
    rng = np.random.default_rng(6)
    rows = [(i, int(i < 8), None if i in (0, 3) else float(rng.normal()), float("nan") if i == 5 else float(rng.normal())) for i in range(40)]
    d = _df(spark, rows, "id long, label int, a double, b double")
    out = {r["label"]: r["count"] for r in resample.smote(d, ["a", "b"], k=3).groupBy("label").count().collect()}
    assert out == {0: 32, 1: 32}
    even = _df(spark, [(i, i % 2, float(i), 0.0) for i in range(6)], "id long, label int, a double, b double")
    assert resample.smote_synthetic(even, ["a", "b"]).count() == 0


def test_bipartite_ranker_orders_ties_and_one_class(spark):
    from segscore.operators import learners as L
    rows = [(i, float(i % 7), float(i % 5), int((i % 7) + 2 * (i % 5) >= 9)) for i in range(210)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int")
    x = L.assemble(df, ["a", "b"])
    p = L.BipartiteRanker(max_iter=4, max_depth=2, step=1.0).fit(x).transform(x).select("label", "prediction").toPandas()
    pos, neg = p[p.label == 1].prediction.to_numpy(), p[p.label == 0].prediction.to_numpy()
    diff = pos[:, None] - neg[None, :]
    assert ((diff > 0) + 0.5 * (diff == 0)).mean() > 0.95
    one = x.filter("label = 0")
    assert L.BipartiteRanker(max_iter=2).fit(one).transform(one).select("prediction").distinct().collect()[0][0] == 0


def test_adasyn_shares_among_complete_minority_rows(spark):
    """12 minority rows, 3 without NULLs: the 3 get all synthetic rows that are due."""
    rng = np.random.default_rng(2)
    rows = [(i, int(i < 12), None if 3 <= i < 12 else float(rng.normal()), float(rng.normal())) for i in range(80)]
    d = _df(spark, rows, "id long, label int, a double, b double")
    s = resample.adasyn(d, ["a", "b"])
    made = s.filter("synthetic").collect()
    assert abs(len(made) - 56) <= 2 and {r["src_id"] for r in made} <= {0, 1, 2}
    assert all(r["id"] < resample.SYNTHETIC_BELOW + 1 and r["a"] is not None for r in made)
    one = d.filter("label = 0 or id in (0, 5, 6)")
    assert resample.adasyn(one, ["a", "b"]).filter("synthetic").count() == 0


def test_permutations_are_permutations(spark):
    from segscore.operators import mlp
    for n in (1, 2, 7, 12, 100):
        for t in range(4):
            a, b = mlp.affine(n, 5, t)
            assert sorted((a * r + b) % n for r in range(n)) == list(range(n))
    d = _df(spark, [(i, 0, float(i), float(-i)) for i in range(50)], "id long, label int, a double, b double")
    rows = mlp.permuted(d, ["a", "b"], repeats=2, seed=3).collect()
    place = {r["_r"]: r for r in rows}
    for t in range(2):
        a, b = mlp.affine(50, 3, t)
        for r in rows:  # row r takes the values of the row whose place is a * r + b
            src = place[(a * r["_r"] + b) % 50]
            assert r["_p"][t]["x"] == [src["a"], src["b"]]


def test_perceptron_plans_agree_and_the_rate_matters(spark):
    from segscore.operators import mlp
    rng = np.random.default_rng(5)
    x = rng.normal(size=(100, 3))
    rows = [(i, int(x[i, 0] + x[i, 1] > 0), *map(float, x[i])) for i in range(100)]
    d = _df(spark, rows, "id long, label int, a double, b double, c double").repartition(3)
    m = mlp.matrix(d, ["a", "b", "c"])
    slow, fast = mlp.fit_many(m, [mlp.Spec(hidden=4, epochs=3, batch=40, rate=v) for v in (0.001, 0.1)])
    assert not np.allclose(slow.weights, fast.weights)
    far = mlp._train_partitioned(m, mlp.Spec(hidden=4, epochs=3, batch=40, rate=0.1))
    assert np.allclose(far, fast.weights, atol=1e-9)
    good = mlp.fit_many(m, [mlp.Spec(hidden=8, epochs=200, rate=0.05)])[0]
    assert ((good.scores(x) >= 0.5) == (x[:, 0] + x[:, 1] > 0)).mean() > 0.95


def test_gradient_is_the_derivative():
    from segscore.operators import mlp
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(20, 3)), (rng.random(20) < 0.4).astype(float)
    w = mlp.start(3, mlp.Spec(hidden=5)) + 0.01
    g, loss = mlp.gradient(w, x, y, 5)
    for i in range(len(w)):
        e = np.zeros_like(w)
        e[i] = 1e-6
        assert abs((mlp.gradient(w + e, x, y, 5)[1] - mlp.gradient(w - e, x, y, 5)[1]) / 2e-6 - g[i]) < 1e-4


def test_stack_plans_agree(spark):
    from segscore.operators import stacking
    rng = np.random.default_rng(6)
    x = rng.normal(size=(80, 2))
    rows = [(i, int(x[i, 0] + 0.3 * rng.normal() > 0), *map(float, x[i]), i % 5) for i in range(80)]
    d = _df(spark, rows, "id long, label int, a double, b double, fold int")
    c = {"rf_rounds": 2, "rf_depth": 2, "mlp_hidden": 3, "mlp_epochs": 2, "gbt_rounds": 2, "gbt_depth": 1}
    near = stacking.fit(d, ["a", "b"], c, 1.0)
    z = stacking.with_one(x)
    w = stacking.newton(lambda v: stacking.newton_sums(z, (x[:, 0] > 0).astype(float), v), 2)
    t = _df(spark, [(int(v[0] > 0), *map(float, v)) for v in x], "label int, a double, b double")
    assert np.allclose(stacking.fit_logistic(t, ["a", "b"]), w, atol=1e-6)
    from segscore.operators import mlp
    m = mlp.matrix(d, ["a", "b"], fold="fold")
    folds = [near] * 5
    got = {r["key"]: r["b1"] for r in stacking._out_of_fold(m, folds).collect()}
    assert np.allclose([got[i] for i in range(80)], near.net.scores(x))
