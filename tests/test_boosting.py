"""Lockstep tree ensembles against a plain recursive booster, and the two plans against each other."""

import numpy as np
import pytest

from segscore.operators import boosting as B
from segscore.operators import metrics

UNIT = 2.0 ** 30


def plain_tree(x, g, h, w, p, columns, depth=0):
    """Nested (column, cut, left, right) or a value, over bins; rows with weight 0 only pass."""
    G, H = (g * w).sum(), (h * w).sum()
    best = (max(p.gamma, 1e-6), None)
    if depth < p.depth:
        for j in np.flatnonzero(columns):
            for c in range(B.BINS - 1):
                left = x[:, j] <= c
                gl, hl = (g * w)[left].sum(), (h * w)[left].sum()
                gr, hr = G - gl, H - hl
                if hl < p.child or hr < p.child or hl <= 0 or hr <= 0:
                    continue
                gain = gl ** 2 / (hl + p.lam) + gr ** 2 / (hr + p.lam) - G ** 2 / (H + p.lam)
                if gain > best[0] + 1e-12:
                    best = (gain, (j, c, left))
    if best[1] is None:
        return -G / (H + p.lam)
    j, c, left = best[1]
    return (j, c, *(plain_tree(x[s], g[s], h[s], w[s], p, columns, depth + 1) for s in (left, ~left)))


def plain_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def plain_scores(x, y, key, fold, p, objective, classes):
    f = np.zeros((classes, len(y)))
    for t in range(p.rounds[-1]):
        w = B.row_weights(p, t, key, fold)
        cols = B.tree_columns(p, t, x.shape[1])
        if objective == "softmax":
            prob = np.exp(f) / np.exp(f).sum(axis=0)
            g, h = prob - (y == np.arange(classes)[:, None]), 2 * prob * (1 - prob)
        elif objective == "binary":
            prob = 1 / (1 + np.exp(-f))
            weight = np.where(y == 1, p.positive, 1.0)
            g, h = weight * (prob - y), weight * prob * (1 - prob)
        elif objective == "rank":
            fit = fold != p.fold
            up, down = np.exp(-f[:, fit & (y == 1)]).sum(), np.exp(f[:, fit & (y == 0)]).sum()
            g = np.where(y == 1, -np.exp(-f) / up, np.exp(f) / down) * fit.sum() / 2
            h = np.abs(g)
        else:
            g, h = -y[None, :].astype(float), np.ones((1, len(y)))
        g, h = np.rint(g * UNIT) / UNIT, np.rint(np.maximum(h, 2.0 ** -24) * UNIT) / UNIT
        for k in range(classes):
            tree = plain_tree(x, g[k], h[k], w, p, cols)
            f[k] += [plain_value(tree, r) * (1 / p.rounds[-1] if objective == "forest" else p.eta) for r in x]
    return f


def table(spark, n=200, classes=2, seed=1):
    r = np.random.default_rng(seed)
    a, b, c = r.normal(size=n).round(2), r.integers(0, 5, n).astype(float), r.normal(size=n)
    y = (a + b / 2 + r.normal(size=n) > 1).astype(int) if classes == 2 else np.clip((a + b).astype(int), 0, classes - 1)
    rows = [(i, int(y[i]), float(a[i]), float(b[i]), float(c[i]), int(i % 4)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, label int, `a b` double, b double, c double, fold int").repartition(3), ["a b", "b", "c"]


PARAMS = [B.Params(rounds=(2, 5), depth=3, eta=0.3, fold=1), B.Params(rounds=(4,), depth=5, eta=0.1, subsample=0.7, colsample=0.6, gamma=0.2, child=3, fold=0),
          B.Params(rounds=(3,), depth=1, eta=0.5, positive=4.0, fold=2, lam=0.5)]


@pytest.mark.parametrize("objective,classes", [("binary", 1), ("softmax", 3), ("rank", 1), ("forest", 1)])
def test_scores_equal_a_plain_booster(spark, objective, classes):
    df, feats = table(spark, classes=max(2, classes))
    b = B.binned(df, feats, fold="fold", classes=classes)
    x, y, key, fold = b.held
    params = [B.Params(**{**p.__dict__, "bootstrap": True, "lam": 0.0}) for p in PARAMS] if objective == "forest" else PARAMS
    for p, (seen, trees, final) in zip(params, B._spread(b, params, objective, True, True, scores=True)):
        want = plain_scores(x.T, y, key, fold, p, objective, classes)
        near = 1e-6 if objective == "rank" else 1e-9
        assert np.allclose(final, want, atol=near)
        out = fold == p.fold
        assert np.isclose(seen[-1], B.staged(want[:, out], y[out], objective))
        model = B.as_trees(trees, b, p, objective)
        raw = np.array([[r["a b"], r["b"], r["c"]] for r in df.orderBy("id").collect()])
        assert np.allclose(model.raw(raw), want, atol=near)


@pytest.mark.parametrize("objective,classes", [("binary", 1), ("softmax", 3), ("rank", 1)])
def test_both_plans_grow_the_same_trees(spark, objective, classes):
    df, feats = table(spark, classes=max(2, classes))
    near = B.binned(df, feats, fold="fold", classes=classes)
    spark.conf.set("segscore.boosting.localCells", "0")
    try:
        far = B.binned(df.repartition(5), feats, fold="fold", classes=classes)
        assert far.held is None
        params = [B.Params(rounds=(1, 2), depth=2, eta=0.3, fold=1), B.Params(rounds=(2,), depth=3, eta=0.2, subsample=0.8, colsample=0.7, fold=3)]
        assert np.allclose(np.concatenate(B.search(near, params, objective)), np.concatenate(B.search(far, params, objective)), atol=1e-12)
        a, b = B.fit(near, params[1], objective), B.fit(far, params[1], objective)
    finally:
        spark.conf.unset("segscore.boosting.localCells")
    assert a.feature.tolist() == b.feature.tolist() and np.array_equal(a.cut, b.cut, equal_nan=True)
    assert np.allclose(a.value, b.value, atol=1e-12)


def test_stored_scores_continue_on_the_partitioned_plan(spark, monkeypatch):
    df, feats = table(spark, n=60)
    monkeypatch.setattr(B, "STORE_EVERY", 1)
    near = B.binned(df, feats)
    p = B.Params(rounds=(2,), depth=1, eta=0.5)
    far = B.Binned(near.rows, near.features, near.cuts, near.n, 1)
    assert np.allclose(B.as_trees(B._level_jobs(far, [p], "binary", False)[0][1], far, p, "binary").value, B.fit(near, p).value)


def test_stages_are_prefixes_and_importances_add_up(spark):
    df, feats = table(spark)
    b = B.binned(df, feats, fold="fold")
    long, short = B.Params(rounds=(3, 6), fold=1), B.Params(rounds=(3,), fold=1)
    (s_long, s_short) = B.search(b, [long, short])
    assert s_long[0] == s_short[0]
    m = B.fit(b, B.Params(rounds=(6,)))
    assert abs(m.importances().sum() - 1) < 1e-9
    x = np.array([[0.1, 2.0, 0.3], [1.0, 0.0, -1.0]])
    assert np.allclose(m.truncated(3).raw(x), m.raw(x, upto=3))


@pytest.mark.parametrize("objective,classes", [("binary", 1), ("softmax", 3)])
def test_models_that_differ_in_depth_grow_as_one_until_they_part(spark, objective, classes):
    df, feats = table(spark, classes=max(2, classes))
    b = B.binned(df, feats, fold="fold", classes=classes)
    params = [B.Params(rounds=(2, 4), depth=d, eta=0.4, child=0.5, fold=f) for d in (1, 2, 2, 9, 4, 12) for f in (0, 1)]
    together = B.run_group(b.held, params, objective, classes, True, True)
    for i, p in enumerate(params):
        alone = B.run_group(b.held, [p], objective, classes, True, True)
        assert together[0][i] == alone[0][0] and np.allclose(together[2][i], alone[2][0], atol=1e-12)
        assert [t["feature"].tolist() for t in together[1][i]] == [t["feature"].tolist() for t in alone[1][0]]


def test_save_load_transform_and_missing_features(spark, tmp_path):
    df, feats = table(spark, classes=3)
    m = B.fit(B.binned(df, feats, classes=3), B.Params(rounds=(4,)), "softmax")
    back = B.Trees.load(spark, str(tmp_path / "m"), m.save(str(tmp_path / "m")))
    holes = df.withColumn("b", __import__("pyspark").sql.functions.expr("if(id % 3 = 0, null, b)"))
    got = {r["id"]: (r["p"], r["q"]) for r in back.transform(m.transform(holes, "p"), "q").collect()}
    assert all((v == (None, None)) == (i % 3 == 0) for i, v in got.items()) and all(a == b for a, b in got.values())
    hit = m.transform(df, "p").selectExpr("avg(if(p = label, 1, 0)) AS a").first()["a"]
    assert hit > 0.7


def test_average_precision_equals_the_spark_form(spark):
    r = np.random.default_rng(0)
    s, y = r.integers(0, 9, 80) / 9, r.integers(0, 2, 80)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "score double, label int")
    assert np.isclose(B.average_precision(s, y), metrics.average_precision(df).first()[0])
    assert np.isnan(B.average_precision(s, y * 0))


def test_tables_without_rows_or_with_one_value(spark):
    df, feats = table(spark, n=30)
    empty = B.binned(df.limit(0), feats)
    assert empty.n == 0
    flat = df.selectExpr("id", "label", "1.0D AS `a b`", "cast(null AS double) AS b", "2.0D AS c")
    assert B.binned(flat, feats).n == 0
    m = B.fit(B.binned(flat, ["a b", "c"]), B.Params(rounds=(2,)))
    assert (m.feature == -1).all()


@pytest.mark.parametrize("objective,classes", [("binary", 1), ("softmax", 3), ("rank", 1), ("forest", 1)])
def test_columns_that_share_a_pass_and_models_apart_grow_the_same_trees(monkeypatch, objective, classes):
    r = np.random.default_rng(4)
    n, width = 300, 5
    x, key = r.integers(0, B.BINS, (width, n)).astype(np.uint8), np.arange(n)
    y = (r.integers(0, classes, n) if classes > 1 else (x[0] + r.integers(0, 20, n) > 25)).astype(float)
    params = [B.Params(rounds=(3,), depth=d, subsample=s, colsample=0.8, child=0.5, fold=f, bootstrap=objective == "forest")
              for d in (2, 5) for s in (1.0, 0.7) for f in (0, 1)]
    grown = []
    for paired, pairs, cells in ((10 ** 9, 10 ** 9, 1), (1, 1, 1 << 20)):
        monkeypatch.setattr(B, "PAIRED_ROWS", paired)
        monkeypatch.setattr(B, "LEVEL_PAIRS", pairs)
        monkeypatch.setattr(B, "LEVEL_CELLS", cells)
        grown.append(B.run_group((x, y, key, key % 3), params, objective, classes, True, True))
    (seen, trees, final), (seen2, trees2, final2) = grown
    assert np.array_equal(seen, seen2, equal_nan=True) and np.array_equal(final, final2)
    for a, b in zip(sum(trees, []), sum(trees2, [])):
        assert all(np.array_equal(a[k], b[k]) for k in a)


def test_two_columns_take_one_pass_over_the_rows():
    r = np.random.default_rng(5)
    n = 4 * B.PAIRED_ROWS
    x, y = r.integers(0, B.BINS, (3, n)).astype(np.uint8), r.integers(0, 2, n).astype(float)
    g = B.Group(x, y, np.arange(n), np.zeros(n, int), [B.Params(rounds=(1,))], "binary", 1)
    g.begin(0)
    of = g.histograms(1, np.arange(1))
    for j in range(3):
        want = np.bincount(x[j], 0.5 - y, B.BINS), np.bincount(x[j], np.full(n, 0.25), B.BINS)
        assert np.array_equal(np.stack(of(j))[:, 0], np.stack(want))
    assert list(g.codes) == [0]  # the first two columns came from one pass


@pytest.mark.parametrize("objective,classes", [("binary", 1), ("softmax", 4), ("rank", 1), ("forest", 1)])
def test_the_jvm_grows_the_same_trees(spark, objective, classes):
    """Deep and shallow families, samples, folds, rows that are never fitted, several stages."""
    r = np.random.default_rng(6)
    n, width = 400, 6
    x, key = r.integers(0, B.BINS, (width, n)).astype(np.uint8), r.integers(-50, 10 ** 12, n)
    x[1], x[2] = x[1] % 3, 7
    y = (r.integers(0, classes, n) if classes > 1 else (x[0] + r.integers(0, 20, n) > 30)).astype(float)
    b = B.Binned(spark.range(1), [f"f{i}" for i in range(width)], [np.arange(31.0)] * width, n, classes, (x, y, key, np.where(key % 5 == 0, B.NEVER, key % 3)))
    params = [B.Params(rounds=(1, 4, 9), depth=d, eta=e, subsample=s, colsample=c, gamma=g, child=h, positive=3.0, fold=f)
              for d in (1, 3, 3, 8, 14) for e, s, c, g, h in ((0.3, 1.0, 1.0, 0.0, 0.4), (0.1, 0.7, 0.6, 0.2, 3.0)) for f in (0, 1)]
    if objective == "forest":
        params = [B.replace(p, bootstrap=True, features=2, lam=0.0) for p in params]
    grown = B._spread(b, params, objective, True, True, True)
    lean = B._spread(b, params, objective, True, False)
    seen, trees, final = B.run_group(b.held, params, objective, classes, True, True)
    for i, got in enumerate(grown):
        assert np.allclose(got[0], seen[i], atol=1e-12, equal_nan=True) and lean[i] == (got[0], None, None)
        assert len(got[1]) == len(trees[i]) == 9 * classes
        assert all(np.array_equal(s[k], t[k]) for s, t in zip(got[1], trees[i]) for k in ("feature", "left"))
        assert all(np.array_equal(s["cut"][s["feature"] >= 0], t["cut"][s["feature"] >= 0]) for s, t in zip(got[1], trees[i]))
        assert all(np.allclose(s[k], t[k], atol=1e-9) for s, t in zip(got[1], trees[i]) for k in ("value", "gain"))
        assert np.allclose(got[2], final[i], atol=1e-9)


def test_the_jvm_takes_tables_without_rows(spark):
    df, feats = table(spark, n=30)
    b = B.binned(df.limit(0), feats)
    assert b.held is not None and (B.fit(b, B.Params(rounds=(2,))).feature == -1).all()
    assert np.isnan(B.search(b, [B.Params(rounds=(1, 2), fold=0)])).all()


def test_a_table_of_the_documents_at_six_gb_is_broadcast():
    """1.5 million rows of 6 columns, a score each; one job a level would be a hundred thousand jobs."""
    assert 1_500_000 * (6 + 8) <= B.TASK_CELLS * B.LOCAL_CELLS


def test_rows_of_a_node_lie_together_in_any_number_of_columns():
    r = np.random.default_rng(8)
    for width in (1, 6, 70):
        x = r.integers(0, B.BINS, (width, 500)).astype(np.uint8)
        order = B.near_rows(x)
        assert sorted(order.tolist()) == list(range(500))
        assert (np.diff(x[0, order] >> 4) >= 0).all()
