"""Shapley values by brute force, time folds that never look ahead, and bootstraps against a plain resampler."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from admill.operators import modelling, ordering, shap, statistics


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4)).round(2)
    y = 3 * x[:, 0] + np.where(x[:, 1] > 0, 2 * x[:, 2], -x[:, 0]) + rng.normal(size=400) / 10
    rows = spark.createDataFrame([(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, y double")
    return VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(rows)


def plain_value(nodes, tree, x, known):
    """The tree's mean where only some features are known."""
    at = {r.id: r for r in nodes[nodes["tree"] == tree].itertuples()}

    def mean(i):
        n = at[i]
        if n.leftChild < 0:
            return n.prediction
        if n.featureIndex in known:
            return mean(n.leftChild if x[n.featureIndex] <= n.leftCategoriesOrThreshold[0] else n.rightChild)
        left, right = at[n.leftChild], at[n.rightChild]
        return (left.rawCount * mean(n.leftChild) + right.rawCount * mean(n.rightChild)) / n.rawCount

    return at[0].weight * mean(0)


@pytest.mark.parametrize("depth", [1, 3, 4])
def test_shapley_values(spark, numbers, depth):
    model = GBTRegressor(labelCol="y", maxIter=4, maxDepth=depth, seed=1).fit(numbers)
    nodes = shap.nodes_of(model, spark)
    explained = shap.with_contributions(model.transform(numbers), model).collect()
    base = shap.expected(shap.leaf_paths(nodes))
    for r in explained:
        assert base + sum(r["shap"]) == pytest.approx(r["prediction"], abs=1e-9)
    for r in explained[:6]:
        x = r["features"].toArray()
        for i in range(4):
            others = [j for j in range(4) if j != i]
            value = 0.0
            for k in range(4):
                for s in itertools.combinations(others, k):
                    gain = sum(plain_value(nodes, t, x, {*s, i}) - plain_value(nodes, t, x, set(s)) for t in range(4))
                    value += gain * math.factorial(k) * math.factorial(3 - k) / math.factorial(4)
            assert r["shap"][i] == pytest.approx(value, abs=1e-9)


def test_shapley_ranking(spark, numbers):
    model = DecisionTreeRegressor(labelCol="y", maxDepth=4, seed=1).fit(numbers)
    ranked = {r["feature"]: r for r in shap.ranking(numbers, model, list("abcd")).collect()}
    each = np.array([r["shap"] for r in shap.with_contributions(numbers, model).collect()])
    for i, name in enumerate("abcd"):
        assert ranked[name]["absolute"] == pytest.approx(np.abs(each[:, i]).mean()) and ranked[name]["signed"] == pytest.approx(each[:, i].mean())
    assert ranked["a"]["absolute"] > ranked["d"]["absolute"]
    assert shap.ranking(numbers.limit(0), model, list("abcd")).count() == 0


def test_shapley_values_of_levels(spark):
    rng = np.random.default_rng(3)
    rows = [(float(rng.normal()) if i % 9 else None, "pqr"[i % 3], float(i % 3 == 1) * 4 + (i % 9 == 0)) for i in range(300)]
    docs = spark.createDataFrame(rows, "price double, hook string, y double")
    model = modelling.train_boosted(docs, "y", ["price"], ["hook"], rounds=4)
    out = model.transform(modelling.with_indicators(docs, ["price"]))
    names = modelling.encoded_names(out, ["price"], ["hook"])
    assert names[:2] == ["numeric__price", "numeric__missingindicator_price"] and {"categorical__hook_p", "categorical__hook_q", "categorical__hook_r"} < set(names)
    base = shap.expected(shap.leaf_paths(shap.nodes_of(model.stages[-1], spark)))
    for r in shap.with_contributions(out, model.stages[-1]).select("shap", "prediction").collect():
        assert len(r["shap"]) == len(names) and base + sum(r["shap"]) == pytest.approx(r["prediction"], abs=1e-9)
    ranked = {r["feature"]: r["absolute"] for r in shap.ranking(out, model.stages[-1], names).collect()}
    assert max(ranked, key=ranked.get) == "categorical__hook_q"


def test_preprocessing_is_fitted_on_training_rows(spark):
    docs = spark.createDataFrame([(float(i), "ab"[i % 2], float(i)) for i in range(20)] + [(None, "a", 3.0)], "x double, h string, y double")
    fitted = modelling.preprocessor(["x"], ["h"]).fit(modelling.with_indicators(docs, ["x"]))
    out = np.array([r["features"].toArray() for r in fitted.transform(modelling.with_indicators(docs, ["x"])).collect()])
    assert np.allclose(out[:, :2].mean(axis=0), 0) and np.allclose(out[:, :2].std(axis=0, ddof=1), 1)
    later = fitted.transform(modelling.with_indicators(spark.createDataFrame([(1e6, "new", 0.0)], docs.schema), ["x"])).first()["features"].toArray()
    assert later[0] > 1e4 and later[2:4].sum() == 0


@pytest.mark.parametrize("n", [23, 24])
def test_time_folds(spark, n):
    rng = np.random.default_rng(4)
    days = rng.integers(0, 9, n).tolist()
    rows = spark.createDataFrame([(i, f"2024-01-{d + 1:02d}" if d else None) for i, d in enumerate(days)], "id long, s string").withColumn("day", F.to_date("s"))
    got = {r["id"]: r["fold"] for r in modelling.time_folds(rows, "day", "id", 4).collect()}
    order = sorted(range(n), key=lambda i: (days[i], i))
    size = n // 5
    want = {i: max(-1, (p - (n - 4 * size)) // size) for p, i in enumerate(order)}
    assert got == want
    for f in range(4):  # no fold trains on what is newer than its test rows
        assert max(days[i] for i in got if got[i] < f) <= min(days[i] for i in got if got[i] == f)
    with pytest.raises(ValueError):
        modelling.time_folds(rows.limit(3), "day", "id", 4)


def test_time_search(spark):
    rows = spark.createDataFrame([(i, i, float(i % 7), float(i % 7) * 2 + i / 100) for i in range(120)], "id long, t long, x double, y double")
    folds = modelling.time_folds(rows.withColumn("t", F.timestamp_seconds("t")), "t", "id", 2).cache()
    grid = [{"rounds": 1, "depth": 1, "step": 0.1}, {"rounds": 3, "depth": 3, "step": 0.1}]
    found = modelling.time_search(folds, "y", ["x"], [], grid).cache()
    assert sorted((r["point"], r["fold"], r["n_train"], r["n_test"]) for r in found.collect()) == [(p, f, 40 + 40 * f, 40) for p in (0, 1) for f in (0, 1)]
    best = modelling.best_point(found).collect()
    assert best[0]["point"] == 1 and best[0]["mae_mean"] < best[1]["mae_mean"] and best[0]["r2_mean"] > 0.9


def test_bootstrap_against_a_plain_resampler(spark):
    rng = np.random.default_rng(5)
    rows = [(i, f"g{rng.integers(40)}", float(a := rng.normal()), float(a + rng.normal() / 2)) for i in range(600)]
    frame = spark.createDataFrame(rows, "id long, g string, a double, p double").repartition(5)
    got = statistics.cluster_bootstrap(frame, "g", "a", "p", 0.1, resamples=300, seed=3, key="id").first()
    groups = sorted({r[1] for r in rows})
    rank = lambda v: {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[v], r[0])))}
    by_p, by_a, k = rank(3), rank(2), math.ceil(600 * 0.2)
    top = [(r[1], by_a[r[0]] < k) for r in rows if by_p[r[0]] < k]
    drawn = {s: {g: statistics.poisson_weights(s, g, 300) for g in groups} for s in (3, 4)}
    w = np.array([drawn[3][r[1]] for r in rows])
    e, b, d = (np.array(x) for x in zip(*((abs(a - p), abs(a - 0.1), p - a) for _, _, a, p in rows)))
    difference, gap = (w * (e - b)[:, None]).sum(0) / w.sum(0), (w * d[:, None]).sum(0) / w.sum(0)
    t = np.array([drawn[4][g] for g, _ in top])
    hits = (t * np.array([h for _, h in top])[:, None]).sum(0) / t.sum(0)
    want = {"clusters": len(groups), "top_clusters": len({g for g, _ in top}), "difference": (e - b).mean(), "calibration_gap": d.mean(), "precision": np.mean([h for _, h in top])}
    for name, values in (("difference", difference), ("calibration", gap), ("precision", hits)):
        want |= {f"{name}_lower_95": np.percentile(values, 2.5), f"{name}_upper_95": np.percentile(values, 97.5)}
    assert got.asDict() == pytest.approx(want)
    assert 0.9 < np.mean([drawn[3][g].mean() for g in groups]) < 1.1
    with pytest.raises(ValueError):
        statistics.cluster_bootstrap(frame.withColumn("g", F.lit(" ")), "g", "a", "p", 0.1)


def test_grouped_quantiles(spark):
    rng = np.random.default_rng(6)
    rows = [(["a", "b", None][int(g)], float(v)) for g, v in zip(rng.integers(0, 3, 900), rng.integers(0, 200, 900) ** 2)] + [("c", 5.0), ("d", None), ("e", 1.0), ("e", 2.0)] + [("a", 7.0)] * 400
    frame = spark.createDataFrame(rows, "g string, x double").repartition(6)
    points = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in ordering.grouped_quantiles(frame, "g", "x", points, "q").collect()}
    assert set(got) == {"a", "b", "c", "e", None}
    for g, q in got.items():
        assert q == pytest.approx(np.quantile([x for k, x in rows if k == g and x is not None], points).tolist())
    assert ordering.grouped_quantiles(frame.limit(0), "g", "x", points).count() == 0
