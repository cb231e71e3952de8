"""Scans: corpora, document folders, event logs, diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from admill.operators.relational import latest_per_key

IMAGES = ["jpg", "jpeg", "png", "webp"]


def json_corpus(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that hold one JSON array of objects each; the schema is given, never inferred."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def raw_items(spark: SparkSession, path: str) -> DataFrame:
    """One schemaless item a line, as variants (column raw); lines that don't parse are left out."""
    return spark.read.text(path).select(F.try_parse_json("value").alias("raw")).filter(F.col("raw").isNotNull())


def document_folder(spark: SparkSession, path: str, schema: str, key: str = "ad_id") -> DataFrame:
    """A JSON document per file; invalid ones are left out, and of files with the same key the last by name stays."""
    rows = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    rows = rows.schema(f"{schema}, _corrupt string").json(path).withColumn("_file", F.input_file_name())
    good = rows.filter(F.col("_corrupt").isNull() & F.col(key).isNotNull())
    return latest_per_key(good, [key], [F.desc("_file")]).drop("_file", "_corrupt")


def observation_log(spark: SparkSession, path: str, item: str) -> DataFrame:
    """Observations, whether each file is a list of them or an object that holds the list."""
    rows = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    listed = F.coalesce(F.try_variant_get("v", "$.observations", f"array<{item}>"), F.try_variant_get("v", "$", f"array<{item}>"))
    return rows.select(F.explode(listed).alias("o")).select("o.*")


def latest_snapshots(snapshots: DataFrame, key: str = "ad_id") -> DataFrame:
    return latest_per_key(snapshots, [key], [F.desc("observed_at"), F.asc("snapshot_id")])


def distinct_events(events: DataFrame, key: str = "observation_id") -> DataFrame:
    """One row per id of an at-least-once log, the latest observed."""
    return latest_per_key(events, [key], [F.desc("observed_at")])


def failed_urls(spark: SparkSession, path: str) -> DataFrame:
    """Distinct URLs of a diagnostics CSV that failed or came without a price."""
    rows = spark.read.option("header", True).csv(path)
    missing = F.col("product_price").isNull() if "product_price" in rows.columns else F.lit(False)
    return rows.filter((F.lower("success") == "false") | missing).filter(F.col("url").isNotNull()).select("url").distinct()


def image_folder(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of image files."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return rows.filter(F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1)).isin(IMAGES)).select("path", "length", "content")


def block_tree(blocks: DataFrame) -> DataFrame:
    """(doc, id, block_type, depth) of a block tree given as rows (doc, id, parent, block_type): those with a type and an id."""
    return blocks.sparkSession.sql(
        """WITH RECURSIVE t AS (SELECT doc, id, block_type, 0 AS depth FROM {blocks} WHERE parent IS NULL
      UNION ALL SELECT b.doc, b.id, b.block_type, t.depth + 1 FROM {blocks} b JOIN t ON b.doc = t.doc AND b.parent = t.id)
      SELECT doc, id, block_type, depth FROM t WHERE block_type IS NOT NULL AND id <> ''""",
        blocks=blocks,
    )


#: What an extraction document holds of the fields that predictions are judged by.
PREDICTION = """ad_id string, typography_hierarchy struct<primary_headline: struct<text: string>, secondary_copy: array<struct<text: string>>>,
  marketing_psychology struct<hook_framework: string>, human_model_analysis struct<human_presence: boolean, model_count: int>"""


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """(ad_id, predicted_headline, predicted_secondary_copy, predicted_hook_framework, predicted_human_presence, predicted_model_count) of a folder of
    extraction documents; documents that don't parse or lack an id are left out, missing parts take defaults."""
    docs = document_folder(spark, path, PREDICTION).filter("ad_id <> ''")
    or_ = lambda c, default: F.coalesce(F.col(c), F.lit(default))
    copy = F.transform(F.coalesce("typography_hierarchy.secondary_copy", F.array().cast("array<struct<text: string>>")), lambda b: F.coalesce(b["text"], F.lit("")))
    return docs.select(
        "ad_id",
        or_("typography_hierarchy.primary_headline.text", "").alias("predicted_headline"),
        copy.alias("predicted_secondary_copy"),
        or_("marketing_psychology.hook_framework", "Unknown").alias("predicted_hook_framework"),
        or_("human_model_analysis.human_presence", False).alias("predicted_human_presence"),
        or_("human_model_analysis.model_count", 0).alias("predicted_model_count"),
    )


def golden_set(spark: SparkSession, path: str, labels: str) -> DataFrame:
    """Entries of a golden set (one JSON array) with the given label columns (`name type, ...`), null while not labelled."""
    return json_corpus(spark, path, f"ad_id string, {labels}")


def local_artifacts(spark: SparkSession, ads_path: str, documents_path: str, ads: str, documents: str, matrix_path: str | None = None, matrix: str = "ad_id string") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three artifacts of a run: its ads, its extraction documents, and its matrix with one row an id, the last in the file (empty without a path).

    The schemas are given. Every document stays, two of one ad included; those that don't parse stop the load.
    """
    docs = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(documents).json(documents_path)
    if matrix_path is None:
        return json_corpus(spark, ads_path, ads), docs, spark.createDataFrame([], matrix)
    rows = json_corpus(spark, matrix_path, matrix).withColumn("_place", F.monotonically_increasing_id())
    return json_corpus(spark, ads_path, ads), docs, latest_per_key(rows, ["ad_id"], [F.desc("_place")]).drop("_place")
