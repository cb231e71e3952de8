"""Helpers that the corpus operators share: tables, shared scratch folders, checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from admill.operators.storage import shared_dir, stored

#: ASCII white space that separates words everywhere in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"
#: Most rows and bytes of a small table that may be broadcast; beyond them the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, grouped by application so that it can be cleared as a whole."""
    return f"{shared_dir(spark)}/admill-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


#: Writes a frame to the shared folder and reads it back: lineage ends in files that outlive executors.
materialise = stored


def is_small(df: DataFrame, most: int | None = None, most_bytes: int | None = None) -> bool:
    """Whether df is counted to have at most that many rows and, spelt out, bytes."""
    most = BROADCAST_ROWS if most is None else most
    head = df.limit(most + 1).agg(F.count("*"), F.sum(F.length(F.to_json(F.struct("*"))))).first()
    return head[0] <= most and (head[1] or 0) <= (BROADCAST_BYTES if most_bytes is None else most_bytes)


def join_checked(left: DataFrame, right: DataFrame, on, how: str = "inner", most: int | None = None) -> DataFrame:
    """Joins, broadcasting right only if it is counted to be small."""
    return left.join(F.broadcast(right) if is_small(right, most) else right, on, how)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """df, with a clear error if it lacks a column; null columns and extra columns are fine."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}; found {df.columns}")
    return df


def shielded(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with all but the used columns under names that can't clash, and what gives the columns back as they were."""
    names = {c: c if c in used else f"__extra_{i}" for i, c in enumerate(docs.columns)}
    hidden = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return hidden, lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()])


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what this application has written below the shared folder; results not yet read go too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/admill-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a whole text."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t), F.xxhash64(F.lit(1), t)]
