"""Tables changed bucket by bucket, and bundles of tables that are published once and can be verified."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from admill.operators.storage import stored

BUCKETS = 64
MANIFEST = "manifest"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def bucket(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def upsert_buckets(changes: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> int:
    """Puts changed rows in place of old ones and adds new ones; returns how many buckets were rewritten.

    The table lies in folders by bucket of its key. Rows that it holds already as they are change nothing, and only the buckets of
    the others are read in full, merged, stored elsewhere, and swapped in by one committed write. Keys that are null or come twice are errors.
    """
    spark = changes.sparkSession
    fresh = stored(changes.withColumn("_bucket", bucket(key, buckets)), "changes")
    if not fresh.groupBy(key).agg(F.count("*").alias("_n")).filter((F.col("_n") > 1) | F.col(key).isNull()).isEmpty():
        raise ValueError(f"{key} must be known and stand for one row of the changes")
    if _exists(spark, path):
        table = spark.read.parquet(path)
        if sorted(table.columns) != sorted(fresh.columns):
            raise ValueError(f"{path} has other columns: {table.columns}")
        table = table.select(*[F.col(c).cast(t).alias(c) for c, t in fresh.dtypes])
        same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in fresh.columns]
        unchanged = same[0]
        for s in same[1:]:
            unchanged = unchanged & s
        fresh = stored(fresh.alias("n").join(table.alias("o"), unchanged & (F.col(f"o.{key}") == F.col(f"n.{key}")), "left_anti"), "changes")
        touched = sorted(r["_bucket"] for r in fresh.select("_bucket").distinct().collect())  # at most as many as there are buckets
        if not touched:
            return 0
        kept = table.filter(F.col("_bucket").isin(touched)).join(fresh.select(key), key, "left_anti")
        merged = stored(kept.unionByName(fresh), "merged")
    else:
        merged, touched = fresh, sorted(r["_bucket"] for r in fresh.select("_bucket").distinct().collect())
    merged.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)
    return len(touched)


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path below the folder, bytes, sha256) of every file of a folder, hashed by the tasks that read them. Folders' own marks (_SUCCESS, .crc) don't count."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    below = F.expr(f"substring(path, locate({full + '/'!r}, path) + {len(full) + 1})")
    return files.select(below.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def publish_bundle(tables: dict[str, DataFrame], path: str, version: str, file_rows: int = 1_000_000) -> DataFrame:
    """Publishes tables under their roles' names, with a manifest of all files, in one step; returns the manifest (role, path, bytes, sha256, version).

    Everything is written and hashed in a folder beside, which is then renamed: a reader sees the whole bundle or none. What is there already is an error.
    """
    if not tables or any(not r or set(r) & set("/\\") or r.startswith((".", "_")) or r == MANIFEST for r in tables):
        raise ValueError(f"roles must be plain names: {sorted(tables)}")
    spark = next(iter(tables.values())).sparkSession
    if _exists(spark, path):
        raise FileExistsError(path)
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    for role, rows in tables.items():
        rows.write.option("maxRecordsPerFile", file_rows).parquet(f"{staged}/{role}")
    manifest = stored(file_hashes(spark, staged).withColumns({"role": F.split_part("path", F.lit("/"), F.lit(1)), "version": F.lit(version)}), "manifest")
    manifest.select("role", "path", "bytes", "sha256", "version").coalesce(1).write.json(f"{staged}/{MANIFEST}")  # a row per file
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target) or not system.rename(source, target):
        raise FileExistsError(path)
    return bundle_manifest(spark, path)


def bundle_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("role string, path string, bytes long, sha256 string, version string").json(f"{path}/{MANIFEST}")


def verify_bundle(spark: SparkSession, path: str, roles: list[str]) -> DataFrame:
    """(path, problem) of everything that a bundle's files and its manifest disagree on; empty if it holds.

    Problems: escapes (the manifest names a path outside), missing, tampered, extra, role_missing, role_unknown.
    """
    manifest = bundle_manifest(spark, path)
    escapes = F.col("path").startswith("/") | F.col("path").contains("\\") | F.array_contains(F.split("path", "/"), "..") | F.col("path").contains(":")
    outside = manifest.filter(escapes).select("path", F.lit("escapes").alias("problem"))
    there = file_hashes(spark, path).filter(~F.col("path").startswith(f"{MANIFEST}/")).select("path", F.col("bytes").alias("_b"), F.col("sha256").alias("_h"))
    both = manifest.filter(~escapes).select("path", "bytes", "sha256").join(there, "path", "full")
    problem = F.when(F.col("_h").isNull(), "missing").when(F.col("sha256").isNull(), "extra").when((F.col("_b") != F.col("bytes")) | (F.col("_h") != F.col("sha256")), "tampered")
    wanted = spark.createDataFrame([(r,) for r in roles], "path string").withColumn("_w", F.lit(True))
    named = manifest.select(F.col("role").alias("path")).distinct().withColumn("_n", F.lit(True)).join(wanted, "path", "full")
    wrong = named.select("path", F.when(F.col("_n").isNull(), "role_missing").when(F.col("_w").isNull(), "role_unknown").alias("problem"))
    return both.select("path", problem.alias("problem")).unionByName(outside).unionByName(wrong).filter("problem IS NOT NULL")
