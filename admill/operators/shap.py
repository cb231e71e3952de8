"""Shapley values of boosted trees' features, exactly and by tree paths.

A fitted model's nodes are a table. Every leaf pays its value times, for each feature on its path, either whether
the row follows the path there or the share of training rows that do. With at most as many features on a path as the tree is
deep, the weighted sum over subsets of the others comes from a small product of polynomials, for a whole batch of rows at once.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from admill.operators.storage import shared_dir

#: Most nodes of a model whose paths are shipped to tasks.
MOST_NODES = 500_000


class Rule(NamedTuple):
    """What a path asks of one feature: low < x <= high, and x among the categories unless these are None; share: of training rows that follow."""

    feature: int
    low: float
    high: float
    among: frozenset | None
    share: float


def nodes_of(model, spark: SparkSession) -> pd.DataFrame:
    """The nodes of a tree ensemble or of one tree, as its writer lists them, with each tree's weight."""
    path = f"{shared_dir(spark)}/admill-{spark.sparkContext.applicationId}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    n = data.count()
    if n > MOST_NODES:
        raise ValueError(f"{n} nodes; at most {MOST_NODES}")
    found = data.select("tree", "id", "prediction", "rawCount", "leftChild", "rightChild", "split.featureIndex", "split.leftCategoriesOrThreshold", "split.numCategories").toPandas()
    weights = list(model.treeWeights) if hasattr(model, "treeWeights") else [1.0]
    return found.assign(weight=found["tree"].map(lambda t: weights[t])).sort_values(["tree", "id"], ignore_index=True)


def leaf_paths(nodes: pd.DataFrame) -> list[tuple[float, list[Rule]]]:
    """(weighted value, rules) of every leaf, one rule per feature on its path."""
    out = []
    for _, tree in nodes.groupby("tree"):
        at = {r.id: r for r in tree.itertuples()}

        def walk(i: int, rules: dict[int, Rule]) -> None:
            node = at[i]
            if node.leftChild < 0:
                out.append((node.weight * node.prediction, list(rules.values())))
                return
            f, cut = int(node.featureIndex), list(node.leftCategoriesOrThreshold)
            old = rules.get(f, Rule(f, -math.inf, math.inf, None, 1.0))
            for child, left in ((node.leftChild, True), (node.rightChild, False)):
                share = old.share * at[child].rawCount / node.rawCount
                if node.numCategories < 0:
                    new = Rule(f, old.low if left else max(old.low, cut[0]), min(old.high, cut[0]) if left else old.high, old.among, share)
                else:
                    known = frozenset(float(c) for c in (cut if left else set(range(int(node.numCategories))) - set(map(int, cut))))
                    new = Rule(f, old.low, old.high, known if old.among is None else old.among & known, share)
                walk(child, {**rules, f: new})

        walk(0, {})
    return out


def expected(paths: list[tuple[float, list[Rule]]]) -> float:
    """The prediction where no feature is known."""
    return sum(v * math.prod(r.share for r in rules) for v, rules in paths)


def contributions(paths: list[tuple[float, list[Rule]]], x: np.ndarray) -> np.ndarray:
    """Shapley values of all features for each row of x."""
    out = np.zeros(x.shape)
    for value, rules in paths:
        depth = len(rules)
        weights = [math.factorial(k) * math.factorial(depth - k - 1) / math.factorial(depth) for k in range(depth)]
        follows = []
        for r in rules:
            column = x[:, r.feature]
            ok = (column > r.low) & (column <= r.high)
            follows.append((ok if r.among is None else ok & np.isin(column, list(r.among))).astype(float))
        for i, r in enumerate(rules):
            subsets = np.zeros((depth, len(x)))  # by how many others are known
            subsets[0] = 1
            for j, other in enumerate(rules):
                if j != i:
                    subsets[1:] = subsets[1:] * other.share + subsets[:-1] * follows[j]
                    subsets[0] *= other.share
            out[:, r.feature] += value * (follows[i] - r.share) * (np.array(weights) @ subsets)
    return out


def with_contributions(rows: DataFrame, model, features: str = "features", into: str = "shap") -> DataFrame:
    """rows with an array of every feature's Shapley value; with `expected` they add up to the model's prediction."""
    paths = rows.sparkSession.sparkContext.broadcast(leaf_paths(nodes_of(model, rows.sparkSession)))

    def explain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, 0))
            yield pd.Series(list(contributions(paths.value, x)))

    return rows.withColumn(into, F.pandas_udf(explain, "array<double>")(vector_to_array(features)))


def feature_names(rows: DataFrame, features: str = "features") -> list[str]:
    """Names of a feature vector's places, as its assembler noted them."""
    attrs = rows.schema[features].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for kind in attrs.values() for a in kind), key=lambda a: a["idx"])]


def ranking(rows: DataFrame, model, names: list[str], features: str = "features") -> DataFrame:
    """(feature, absolute, signed): mean absolute and mean signed value of each feature over rows. Tasks send sums, one row a feature."""
    paths = rows.sparkSession.sparkContext.broadcast(leaf_paths(nodes_of(model, rows.sparkSession)))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, absolute, signed = 0, 0.0, 0.0
        for batch in batches:
            if len(batch):
                found = contributions(paths.value, np.stack(batch["x"].to_numpy()))
                n, absolute, signed = n + len(batch), absolute + np.abs(found).sum(axis=0), signed + found.sum(axis=0)
        if n:
            yield pd.DataFrame({"place": range(len(absolute)), "n": n, "a": absolute, "s": signed})

    parts = rows.select(vector_to_array(features).alias("x")).mapInPandas(sums, "place int, n long, a double, s double")
    named = F.element_at(F.array(*map(F.lit, names)), F.col("place") + 1)
    return parts.groupBy("place").agg((F.sum("a") / F.sum("n")).alias("absolute"), (F.sum("s") / F.sum("n")).alias("signed")).select(named.alias("feature"), "absolute", "signed")
