"""State of streams, chained windows, bucketed upserts and bundles."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from admill.operators import lifecycle, windows
from admill.sources import publishing
from admill.streaming import lifecycle_stream

OBS = "observation_id long, ad_id long, observed_at timestamp, observed_status string, poll_complete boolean, reported_stop_date date"


def observations(n, ads, seed):
    rng = random.Random(seed)
    kinds = ["active", "not_observed", "not_observed", "not_observed", "explicitly_inactive", "unknown", None]
    return [(i, rng.randrange(ads), datetime(2024, 1, 1) + timedelta(hours=rng.randrange(400)), rng.choice(kinds), rng.random() < 0.7, rng.choice([None, date(2024, 1, 5)])) for i in range(n)]


def test_stream_equals_the_batch_fold(spark, tmp_path):
    rows = observations(300, 12, 1)
    rng = random.Random(2)
    shuffled = rng.sample(rows, len(rows))
    parts = [shuffled[:120], shuffled[100:220], rng.sample(shuffled, 60) + shuffled[220:], shuffled[:40]]  # late rows, repeats within and across batches
    for i, part in enumerate(parts):
        spark.createDataFrame(part, OBS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(OBS).parquet(str(tmp_path / "in"))
        lifecycle_stream.run(stream, str(tmp_path / "log"), str(tmp_path / "states"), str(tmp_path / "cp"), str(tmp_path / "counts")).awaitTermination()
        known = spark.createDataFrame(list({r[0]: r for p in parts[: i + 1] for r in p}.values()), OBS)
        want = lifecycle.resolve(known)
        got = lifecycle_stream.current_states(spark, str(tmp_path / "states")).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 300 == log.select("observation_id").distinct().count()
    epochs = {r["epoch"]: r["n_new"] for r in spark.read.parquet(str(tmp_path / "counts")).collect()}
    assert sum(epochs.values()) == 300 and sorted(epochs.values())[0] == 0
    first = min(epochs)
    assert lifecycle_stream.due(spark, str(tmp_path / "counts")).first()["due"]
    after = lifecycle_stream.due(spark, str(tmp_path / "counts"), max(epochs) - 1).first()
    assert (after["n_new"], after["due"]) == (0, False) and epochs[first] == 120


def test_step_against_the_batch_fold(spark):
    rows = observations(400, 40, 3)
    want = {r["ad_id"]: r for r in lifecycle.resolve(spark.createDataFrame(rows, OBS)).collect()}
    for ad in range(40):
        now = lifecycle_stream.NEW
        for r in sorted((r for r in rows if r[1] == ad), key=lambda r: (r[2], r[0])):
            now = lifecycle_stream.step(now, r[2], r[3], r[4], r[5])
        if now[6]:
            w = want[ad]
            assert now == (w["state"], w["last_active_at"], w["first_missing_at"], w["event_at"], w["reported_stop_date"], w["consecutive_complete_misses"], w["observation_count"])


def ads(spark, ids, day=1):
    return spark.createDataFrame([(str(i), f"p{i % 3}", f"2024-01-{day + i % 5:02d}") for i in ids], "ad_id string, page_id string, observed_at string")


def test_window_chain(spark):
    first, second = ads(spark, range(20)), ads(spark, range(15, 40), 10)
    polls = spark.createDataFrame([(str(i), i % 2 == 0) for i in range(30)], "ad_id string, poll_complete boolean")
    one = windows.window_manifest(first).cache()
    two = windows.window_manifest(second, polls, one, first).cache()
    w = two.first()
    assert (w["role"], w["previous_window_id"], w["n_ads"], w["n_new_ads"], w["eligible"]) == ("future_holdout", one.first()["window_id"], 25, 20, True)
    assert windows.verify_window(one, first).isEmpty() and windows.verify_window(two, second.repartition(7), polls.orderBy(F.desc("ad_id")), one, first).isEmpty()
    wrong = lambda *sources: {r["field"] for r in windows.verify_window(two, *sources).collect()}
    assert {"ads_sha256", "window_id"} <= wrong(second.withColumn("page_id", F.lit("x")), polls, one, first) and "ad_ids_sha256" not in wrong(second.withColumn("page_id", F.lit("x")), polls, one, first)
    assert {"ad_ids_sha256", "n_ads"} <= wrong(second.filter("ad_id <> '39'"), polls, one, first)
    assert {"observations_sha256", "window_id"} <= wrong(second, polls.unionAll(polls.limit(1)), one, first)
    other = windows.window_manifest(ads(spark, range(19))).cache()
    assert {"previous_window_id", "window_id"} <= wrong(second, polls, other, first)
    forged = two.withColumn("previous_window_id", F.lit(other.first()["window_id"]))
    assert "window_id of its own fields" in {r["field"] for r in windows.verify_window(forged, second, polls, one, first).collect()}
    for bad in (first.limit(0), first.unionAll(first.limit(1)), first.withColumn("ad_id", F.when(F.col("ad_id") != "3", F.col("ad_id")))):
        with pytest.raises(ValueError):
            windows.window_manifest(bad)


def test_content_hash_is_of_the_multiset(spark):
    rows = [(i, None if i % 3 else "x") for i in range(50)]
    h = lambda r: windows.content_hash(spark.createDataFrame(r, "a int, b string")).first()["hash"]
    assert h(rows) == h(rows[::-1]) != h(rows + rows[:1]) and h(rows) != h(rows[1:]) and h([]) == h([]) and len({h([(1, None)]), h([(1, "null")]), h([(None, "1")])}) == 3


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(i, f"v{i}", None) for i in range(500)], "id long, v string, w double")
    assert publishing.upsert_buckets(base, path, "id", 16) == 16
    before = files(path)
    changes = spark.createDataFrame([(3, "new", None), (4, "v4", None), (1000, "added", 1.0)], base.schema)
    touched = publishing.upsert_buckets(changes, path, "id", 16)
    after = files(path)
    assert 1 <= touched <= 2 and len(set(before) & set(after)) >= 14 and all(after[f] == before[f] for f in set(before) & set(after))
    got = {r["id"]: (r["v"], r["w"]) for r in spark.read.parquet(path).collect()}
    assert len(got) == 501 and got[3] == ("new", None) and got[1000] == ("added", 1.0) and got[4] == ("v4", None)
    assert publishing.upsert_buckets(changes, path, "id", 16) == 0 and files(path) == after
    for bad in (changes.unionAll(changes), changes.withColumn("id", F.lit(None).cast("long")), changes.drop("w")):
        with pytest.raises(ValueError):
            publishing.upsert_buckets(bad, path, "id", 16)


def test_bundle(spark, tmp_path):
    path = str(tmp_path / "b")
    tables = {"guide": spark.range(30).repartition(3), "report": spark.range(5)}
    manifest = publishing.publish_bundle(tables, path, "v1").collect()
    assert len(manifest) >= 4 and all(r["bytes"] == os.path.getsize(f"{path}/{r['path']}") and r["version"] == "v1" for r in manifest)
    problems = lambda roles=("guide", "report"): {(r["path"], r["problem"]) for r in publishing.verify_bundle(spark, path, list(roles)).collect()}
    assert not problems() and problems(("guide", "survival")) == {("survival", "role_missing"), ("report", "role_unknown")}
    with pytest.raises(FileExistsError):
        publishing.publish_bundle(tables, path, "v2")
    with pytest.raises(ValueError):
        publishing.publish_bundle({"../x": spark.range(1)}, str(tmp_path / "c"), "v1")
    assert sorted(os.listdir(tmp_path)) == ["b"] and spark.read.parquet(f"{path}/guide").count() == 30
    listed = sorted(r["path"] for r in manifest)
    with open(f"{path}/{listed[0]}", "ab") as f:
        f.write(b"x")
    os.remove(f"{path}/{listed[1]}")
    with open(f"{path}/guide/extra.parquet", "wb") as f:
        f.write(b"y")
    line = '{"role":"guide","path":"guide/../../secret","bytes":1,"sha256":"0","version":"v1"}\n'
    name = next(f for f in os.listdir(f"{path}/manifest") if f.startswith("part-"))
    os.path.exists(f"{path}/manifest/.{name}.crc") and os.remove(f"{path}/manifest/.{name}.crc")
    with open(f"{path}/manifest/{name}", "a") as f:
        f.write(line)
    os.path.exists(f"{path}/{os.path.dirname(listed[0])}/.{os.path.basename(listed[0])}.crc") and os.remove(f"{path}/{os.path.dirname(listed[0])}/.{os.path.basename(listed[0])}.crc")
    assert problems() == {(listed[0], "tampered"), (listed[1], "missing"), ("guide/extra.parquet", "extra"), ("guide/../../secret", "escapes")}
