"""Model inputs and models: pooled levels, imputation, boosted trees with a baseline, proportional hazards."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product
from operator import and_

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

from admill.operators.ordering import quantiles, with_row_number
from admill.operators.storage import shared_dir, stored

RARE = "infrequent"
#: Training rows that one task of a fit holds.
TASK_ROWS = 100_000
#: Value ranges of a number that a search's trees tell apart, as many as Spark's trees do by themselves.
BINS = 32


def pool_rare(rows: DataFrame, column: str, least: int = 5, train: Column | None = None) -> DataFrame:
    """rows with rare levels of the column pooled; levels are counted over the training rows. Null stays null."""
    counted = rows if train is None else rows.filter(train)
    common = counted.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select(column, F.lit(True).alias("_common"))
    pooled = F.when(F.col(column).isNull() | F.col("_common"), F.col(column)).otherwise(RARE)
    return rows.join(common, column, "left").withColumn(column, pooled).drop("_common")


def constant_columns(rows: DataFrame, columns: list[str]) -> list[str]:
    """Columns with at most one distinct value, nulls included as a value."""
    counts = rows.agg(*[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns]).first()
    return [c for c in columns if (counts[c] or 0) <= 1]


def preprocessor(numeric: list[str], categorical: list[str]) -> Pipeline:
    """Median imputation with indicators for missing numbers, both standardised, and one-hot levels; unseen levels encode as none. All of it is fitted on the training rows."""
    stages = [Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}_i" for c in numeric])] if numeric else []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_x", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"{c}_x", outputCol=f"{c}_o", handleInvalid="keep"))
    if numeric:
        stages.append(VectorAssembler(inputCols=[f"{c}_{kind}" for kind in ("i", "m") for c in numeric], outputCol="numbers"))
        stages.append(StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True))
    inputs = (["scaled"] if numeric else []) + [f"{c}_o" for c in categorical]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features")])


def encoded_names(transformed: DataFrame, numeric: list[str], categorical: list[str]) -> list[str]:
    """Names of the feature vector's places: numeric__column, numeric__missingindicator_column, categorical__column_level."""
    names = [f"numeric__{c}" for c in numeric] + [f"numeric__missingindicator_{c}" for c in numeric]
    for c in categorical:
        attrs = transformed.schema[f"{c}_o"].metadata["ml_attr"]["attrs"]
        names += [f"categorical__{c}_{x['name']}" for x in sorted((x for kind in attrs.values() for x in kind), key=lambda x: x["idx"])]
    return names


def with_indicators(rows: DataFrame, numeric: list[str]) -> DataFrame:
    out = rows.withColumns({c: F.col(c).cast("double") for c in numeric})
    return out.withColumns({f"{c}_m": F.col(c).isNull().cast("double") for c in numeric})


def in_tasks(rows: DataFrame) -> DataFrame:
    """rows in as many partitions as keep TASK_ROWS a task on average: files hold many small rows a megabyte, and trees read cached rows of a partition at once."""
    parts = -(-rows.count() // TASK_ROWS)
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def train_boosted(train: DataFrame, target: str, numeric: list[str], categorical: list[str], seed: int = 7, rounds: int = 20, depth: int = 3, step: float = 0.1) -> PipelineModel:
    trees = GBTRegressor(featuresCol="features", labelCol=target, maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=0.8, seed=seed)
    return Pipeline(stages=[preprocessor(numeric, categorical), trees]).fit(with_indicators(in_tasks(train.select(target, *numeric, *categorical)), numeric))


def errors(target: str, prediction: str, median: float | None) -> list[Column]:
    """Aggregates n_test, mae, baseline_mae and r2 of predictions, with the error of a median beside them."""
    mean = F.avg(target)
    residual = F.sum(F.pow(F.col(target) - F.col(prediction), 2))
    total = F.sum(F.pow(target, F.lit(2.0))) - F.count("*") * mean * mean
    return [F.count("*").alias("n_test"), F.avg(F.abs(F.col(target) - F.col(prediction))).alias("mae"), F.avg(F.abs(F.col(target) - F.lit(median))).alias("baseline_mae"), (1 - F.try_divide(residual, total)).alias("r2")]


def evaluate(model: PipelineModel, train: DataFrame, test: DataFrame, target: str, numeric: list[str]) -> DataFrame:
    """One row: error and R2 on the test rows, and the error of the training median."""
    median = next(iter(quantiles(train, target, [0.5])), None)
    return model.transform(with_indicators(test, numeric)).agg(*errors(target, "prediction", median))


def value_ranges(rows: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    """For each numeric column the least values of at most BINS ranges: every value where they are that few, else quantiles."""
    out = {}
    for c in columns:
        known = rows.select(F.col(c).cast("double").alias(c)).filter(F.col(c).isNotNull() & ~F.isnan(c))
        values = [r[0] for r in known.distinct().limit(BINS + 1).collect()]
        out[c] = sorted(values if len(values) <= BINS else set(known.approxQuantile(c, [i / BINS for i in range(1, BINS)], 0.001)))
    return out


def in_value_ranges(rows: DataFrame, ranges: dict[str, list[float]]) -> DataFrame:
    """rows with each numeric column's range numbers, in the values' order, for its values; what isn't known stays."""
    place = lambda c, lows: F.size(F.filter(F.array(*map(F.lit, lows)), lambda x: x <= F.col(c))).cast("double") if lows else F.lit(0.0)
    return rows.withColumns({c: F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).otherwise(place(c, lows)) for c, lows in ranges.items()})


def kinds(rows: DataFrame, target: str, inputs: list[str]) -> DataFrame:
    """(inputs, target, _weight): rows of equal inputs as one, with the mean of their targets and their number; rows without a target are left out.

    For trees of squared errors these say as much as the rows: splits and leaves are the same. So that a tree's subsample leaves out some rows of equal
    inputs and not all, they are dealt by hash into bundles, as many as keep all of them near TASK_ROWS; inputs that differ in every row stay rows.
    """
    different = rows.select(*inputs).distinct().count()
    bundle = F.pmod(F.xxhash64(*rows.columns), F.lit(max(1, TASK_ROWS // max(1, different))))
    known = rows.filter(F.col(target).isNotNull()).withColumn("_bundle", bundle)
    out = known.groupBy(*inputs, "_bundle").agg(F.avg(target).alias(target), F.count("*").cast("double").alias("_weight")).drop("_bundle")
    return out.repartition(max(1, -(-different // TASK_ROWS)))


#: Rounds, depth, step and least rows of a leaf of the models that a search tries.
GRID = [{"rounds": 200, "depth": 3, "step": 0.05, "least": 1}, {"rounds": 400, "depth": 3, "step": 0.03, "least": 3}, {"rounds": 300, "depth": 4, "step": 0.05, "least": 3}, {"rounds": 250, "depth": 5, "step": 0.03, "least": 5}]


def time_folds(rows: DataFrame, time: str, key: str, folds: int = 5, into: str = "fold") -> DataFrame:
    """rows with the number of the expanding time fold that tests them, from 0, oldest first by a time column, then key; -1 for the oldest, which only train.

    The newest folds * (n // (folds + 1)) rows are dealt to folds of n // (folds + 1) rows. Fold f trains on all rows of lower numbers.
    Places come from value ranges, so no task sorts all rows. Too few rows for that many folds are an error.
    """
    seconds = F.when(F.col(time).isNotNull(), F.unix_timestamp(F.col(time).cast("timestamp"))).otherwise(-(1 << 62))
    placed = with_row_number(rows.withColumn("_t", seconds), "_t", [F.col(key)], "_place")
    n = rows.count()
    if (size := n // (folds + 1)) == 0:
        raise ValueError(f"{n} rows for {folds} folds")
    block = F.floor((F.col("_place") - 1 - (n - folds * size)) / size).cast("int")
    return placed.withColumn(into, F.greatest(block, F.lit(-1))).drop("_t", "_place")


def time_search(rows: DataFrame, target: str, numeric: list[str], categorical: list[str], grid: list[dict] = GRID, fold: str = "fold", at_once: int = 8, subsample: float = 0.8, seed: int = 7) -> DataFrame:
    """(point, rounds, depth, step, fold, n_train, n_test, mae, baseline_mae, r2): every grid point tested on every fold of stored rows, trained on the folds before.

    A point's least, if it has one, comes along. Value ranges and preprocessing are fitted anew on each fold's training rows. Trees are fitted on kinds of
    training rows and tell each kind of test rows once, so rows aren't read for every level of a tree. Folds and fits are independent, so some of them run side by side.
    """
    spark = rows.sparkSession
    if not spark.sparkContext.getCheckpointDir():  # hundreds of rounds are too long a lineage
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    numbers = sorted(r[fold] for r in rows.select(fold).distinct().collect() if r[fold] >= 0)  # as many as there are folds
    inputs = [*numeric, *categorical]

    def prepare(f: int) -> tuple:
        train, test = rows.filter(F.col(fold) < f), rows.filter(F.col(fold) == f)
        ranges = value_ranges(train, numeric)
        seen = in_value_ranges(train, ranges)
        prepared = preprocessor(numeric, categorical).fit(with_indicators(seen, numeric))
        points = prepared.transform(with_indicators(kinds(seen, target, inputs), numeric)).select("features", target, "_weight")
        tested = in_value_ranges(test, ranges).select(target, *inputs)
        asked = prepared.transform(with_indicators(tested.select(*inputs).distinct(), numeric)).select("features", *inputs)
        return stored(points, "kinds"), tested, asked, train.count(), next(iter(quantiles(train, target, [0.5])), None)

    def fit(task: tuple[int, int]) -> GBTRegressionModel:
        point, f = task
        p, (points, _, _, n, _) = grid[point], folds[f]
        least = max(0.0, min(0.49, (p.get("least", 1) - 0.5) / n))  # whole rows, so half of one settles it
        trees = GBTRegressor(featuresCol="features", labelCol=target, weightCol="_weight", predictionCol=f"_p{point}", maxIter=p["rounds"], maxDepth=p["depth"], stepSize=p["step"], subsamplingRate=subsample, minWeightFractionPerNode=least, seed=seed)
        return trees.fit(points)

    with ThreadPoolExecutor(at_once) as pool:
        folds = dict(zip(numbers, pool.map(prepare, numbers)))
        tasks = sorted(product(range(len(grid)), numbers), key=lambda t: (-grid[t[0]]["rounds"] * grid[t[0]]["depth"], t))  # the longest first
        models = dict(zip(tasks, pool.map(fit, tasks)))
    out = None
    for f, (_, tested, asked, n, median) in folds.items():
        for point in range(len(grid)):
            asked = models[point, f].transform(asked)
        # stored, since a broadcast join would put off the models' calls to each of its rows
        told_of = stored(asked.select(*[F.col(c).alias(f"_{c}") for c in inputs], *[f"_p{i}" for i in range(len(grid))]), "predictions")
        scored = tested.join(told_of, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in inputs]))
        told = [F.struct(*[F.lit(v).alias(k) for k, v in {"point": i, **p, "fold": f, "n_train": n}.items()], *errors(target, f"_p{i}", median)) for i, p in enumerate(grid)]
        part = scored.agg(F.array(*told).alias("_points")).select(F.inline("_points"))
        out = part if out is None else out.unionByName(part)
    return out


def best_point(searched: DataFrame) -> DataFrame:
    """searched's grid points by mean error over the folds, best first, with the spread over folds: as many rows as points."""
    by = searched.groupBy("point", "rounds", "depth", "step").agg(F.avg("mae").alias("mae_mean"), F.stddev_pop("mae").alias("mae_std"), F.avg("r2").alias("r2_mean"), F.stddev_pop("r2").alias("r2_std"))
    return by.orderBy("mae_mean", "point")


def proportional_hazards(rows: DataFrame, duration: str, observed: str, features: list[str], ridge: float = 1.0, rounds: int = 15) -> dict[str, float]:
    """Coefficients of a ridge Cox model (Breslow ties) on standardised features, by Newton steps.

    Each step is one aggregation to whole days; the risk sets are running sums over those days, of
    which there are as many as a lifetime has.
    """
    stats = rows.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    x = [((F.col(c) - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0)).alias(f"x{i}") for i, c in enumerate(features)]
    data = rows.select(F.col(duration).alias("t"), F.col(observed).cast("int").alias("e"), *x).persist()
    p = len(features)
    beta = np.zeros(p)
    for _ in range(rounds):
        risk = F.exp(sum((F.lit(float(b)) * F.col(f"x{i}") for i, b in enumerate(beta)), F.lit(0.0)))
        pairs = [(i, j) for i in range(p) for j in range(i, p)]
        sums = [F.sum(risk).alias("r"), F.sum("e").alias("d")] + [F.sum(risk * F.col(f"x{i}")).alias(f"a{i}") for i in range(p)] + [F.sum(F.when(F.col("e") == 1, F.col(f"x{i}")).otherwise(0.0)).alias(f"g{i}") for i in range(p)]
        sums += [F.sum(risk * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i, j in pairs]
        days = data.groupBy("t").agg(*sums).orderBy(F.desc("t")).toPandas()  # a row per day
        r = days["r"].cumsum().to_numpy()
        a = days[[f"a{i}" for i in range(p)]].cumsum().to_numpy()
        d = days["d"].to_numpy(dtype=float)
        gradient = days[[f"g{i}" for i in range(p)]].to_numpy().sum(axis=0) - (d[:, None] * a / r[:, None]).sum(axis=0) - ridge * beta
        hessian = np.zeros((p, p))
        for i, j in pairs:
            h = days[f"h{i}_{j}"].cumsum().to_numpy()
            hessian[i, j] = hessian[j, i] = (d * (h / r - a[:, i] * a[:, j] / r**2)).sum()
        step = np.linalg.solve(hessian + ridge * np.eye(p), gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    data.unpersist()
    return dict(zip(features, beta.tolist()))


def expanded_vectors(rows: DataFrame, column: str, size: int) -> DataFrame:
    """rows with a column for each of the first `size` numbers of a vector column, all null where the vector is missing or empty."""
    full = F.size(column) > 0
    return rows.select(*[c for c in rows.columns if c != column], *[F.when(full, F.get(column, F.lit(i)).cast("double")).alias(f"{column}_{i}") for i in range(size)])


def inputs_and_target(rows: DataFrame, target: str, ids: list[str], targets: list[str], leaky: list[str] = ()) -> DataFrame:
    """The model inputs of rows with a known target: all but ids, other targets and leaky columns, and the target itself as y."""
    left_out = {*ids, *targets, *leaky}
    return rows.filter(F.col(target).isNotNull()).select(*[c for c in rows.columns if c not in left_out], F.col(target).cast("double").alias("y"))


def top_coefficients(fitted: DataFrame, n: int = 20) -> DataFrame:
    """The n features of the largest absolute coefficient, ties by name."""
    return fitted.orderBy(F.desc(F.abs("coefficient")), "feature").limit(n)
