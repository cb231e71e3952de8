"""Faults that the findings of round 4 named."""

import inspect

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from admill.operators import modelling
from admill.plans import registry


def test_search_does_the_whole_grid_on_five_folds(spark, tiny, monkeypatch):
    search, asked = inspect.signature(modelling.time_search), {}

    def seen(*args, **kwargs):
        bound = search.bind(*args, **kwargs)
        bound.apply_defaults()
        asked.update(bound.arguments)
        return bound.arguments["rows"]

    monkeypatch.setattr(modelling, "time_search", seen)
    registry.QUERIES["boosted_search"](spark, tiny)
    sizes = {r["fold"]: r["count"] for r in asked["rows"].groupBy("fold").count().collect()}
    assert sorted(sizes) == [-1, 0, 1, 2, 3, 4] and sum(sizes.values()) == spark.read.parquet(f"{tiny}/orders.parquet").count()
    assert [(p["rounds"], p["depth"], p["step"], p["least"]) for p in asked["grid"]] == [(200, 3, 0.05, 1), (400, 3, 0.03, 3), (300, 4, 0.05, 3), (250, 5, 0.03, 5)]


@pytest.mark.parametrize("task_rows", [40, 100_000])
def test_kinds_give_the_models_of_their_rows(spark, monkeypatch, task_rows):
    monkeypatch.setattr(modelling, "TASK_ROWS", task_rows)
    rng = np.random.default_rng(8)
    rows = []
    for i in range(900):
        price, n, hook = float(rng.integers(1, 3000)) / 10, int(rng.integers(0, 5)), [*"pqr", None][rng.integers(4)]
        rows.append((i, i, price if i % 11 else None, n, hook, price / 9 + 7 * (hook == "q") * n + float(rng.normal())))
    frame = spark.createDataFrame(rows, "id long, t long, price double, n long, hook string, y double").withColumn("t", F.timestamp_seconds("t"))
    folds = modelling.time_folds(frame, "t", "id", 2).cache()
    numeric, grid = ["price", "n"], [{"rounds": 12, "depth": 3, "step": 0.1, "least": 3}, {"rounds": 5, "depth": 2, "step": 0.3, "least": 40}]
    got = {(r["point"], r["fold"]): r for r in modelling.time_search(folds, "y", numeric, ["hook"], grid, subsample=1.0).collect()}
    assert len(got) == 4
    for (point, f), r in got.items():
        train, test, p = folds.filter(F.col("fold") < f), folds.filter(F.col("fold") == f), grid[point]
        ranges = modelling.value_ranges(train, numeric)
        assert len(ranges["price"]) == 31 and ranges["n"] == [0, 1, 2, 3, 4]
        train, test = (modelling.with_indicators(modelling.in_value_ranges(x, ranges), numeric) for x in (train, test))
        prepared = modelling.preprocessor(numeric, ["hook"]).fit(train)
        plain = GBTRegressor(labelCol="y", maxIter=p["rounds"], maxDepth=p["depth"], stepSize=p["step"], minInstancesPerNode=p["least"], seed=7).fit(prepared.transform(train))
        scored = plain.transform(prepared.transform(test)).select("y", "prediction").collect()
        error = np.array([x["y"] - x["prediction"] for x in scored])
        assert (r["n_train"], r["n_test"]) == (300 + 300 * f, 300) == (train.count(), len(scored))
        assert r["mae"] == pytest.approx(np.abs(error).mean(), abs=1e-6) and r["mae"] < r["baseline_mae"]
        y = np.array([x["y"] for x in scored])
        assert r["r2"] == pytest.approx(1 - (error**2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-6)
