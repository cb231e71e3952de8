"""The pipeline's stages on a small table, and the registered queries' columns."""

import duckdb

import __spark_entry__
import corpus_pipeline
from admill.llm import queries


def test_stages_keep_columns_and_shrink(spark, tiny, tmp_path):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, tiny).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == columns and 0 < docs.count() <= n
            n = docs.count()
    assert docs.select("doc_id").distinct().count() == n


def test_registered(spark):
    names = __spark_entry__.queries()
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names


def test_oracles(spark, tiny):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tiny}/{t}.parquet')")
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, tiny)
        result = con.execute(sql)
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert sorted(map(repr, result.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())
