"""Findings of the third round."""

from __future__ import annotations

import time
from statistics import stdev

from pyspark.sql import functions as F

from admill.functions import color, geometry
from admill.operators import modelling, normalize, similarity


def test_vibrancy_of_large_palettes(spark):
    palettes = spark.createDataFrame([(1, ["#ff0000", "#102030"] * 1000), (2, ["#336699"] * 7), (3, ["#ff0000", "none", None]), (4, [])], "k int, p array<string>")
    begun = time.perf_counter()
    got = {r["k"]: r["v"] for r in palettes.select("k", color.vibrancy(F.col("p")).alias("v")).collect()}
    assert time.perf_counter() - begun < 20  # a mean per colour took minutes
    assert abs(got[1] - stdev([1.0, 2 / 3] * 1000)) < 1e-12 and got[2] == 0.0 and got[3] is None and got[4] is None
    flat = palettes.select("k", F.explode("p").alias("c")).groupBy("k").agg(color.group_vibrancy(F.col("c")).alias("v"))
    assert {r["k"]: r["v"] and round(r["v"], 12) for r in flat.collect()} == {1: round(got[1], 12), 2: 0.0, 3: None}


def test_alignment_of_exact_means(spark):
    from itertools import permutations

    orders = [(i, list(p)) for i, p in enumerate(permutations([0.05, 0.33, 0.47, 0.75]))] + [(100 + i, list(p)) for i, p in enumerate(permutations([0.25, 0.67, 0.53, 0.95]))]
    rows = spark.createDataFrame([*orders, (200, [0.38, 0.62]), (201, [0.39, 0.61]), (202, [])], "k int, x array<double>")
    whole = {r["k"]: r["a"] for r in rows.select("k", geometry.alignment(F.col("x")).alias("a")).collect()}
    parts = {r["k"]: r["a"] for r in rows.select("k", F.explode("x").alias("x")).groupBy("k").agg(geometry.group_alignment(F.col("x")).alias("a")).collect()}
    assert parts == {k: v for k, v in whole.items() if k != 202} and whole[202] == ""
    assert {v for k, v in whole.items() if k < 202 and k != 201} == {"mixed"} and whole[201] == "center"  # means of exactly 0.4, 0.6 and 0.5; 0.12 off isn't the middle


def test_merge_fills_negative_zero(spark):
    from decimal import Decimal

    base = spark.createDataFrame([(1, "", -0.0, Decimal("0.00"), True), (2, "0.00", 0.5, Decimal("0.10"), None)], "k int, name string, price double, cost decimal(9,2), sold boolean")
    other = spark.createDataFrame([(1, "n", 2.0, Decimal("3.00"), None), (2, "m", -0.0, Decimal("5.00"), None)], "k int, name string, price double, cost decimal(9,2), sold boolean")
    got = {r["k"]: tuple(r)[1:] for r in normalize.merge_pages(base, other, "k", ["name", "price", "cost"], ["sold"]).collect()}
    assert got == {1: ("n", 2.0, Decimal("3.00"), True, True), 2: ("0.00", 0.5, Decimal("0.10"), False, False)}


def test_nearest_ranks_by_rounded_cosines(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    kinds = rng.normal(size=(40, 8))
    vectors = {i: kinds[i % 40] * (1 + i / 7) for i in range(600)}  # copies in direction, whose cosines differ in the last bits
    rows = [(i, v.tolist()) for i, v in vectors.items()] + [(900, [0.0] * 8), (901, None)]
    items = spark.createDataFrame(rows, "id int, v array<double>").repartition(3)
    got = {}
    for r in similarity.nearest(items.filter("id % 50 = 0"), items, "id", "v", 20, most_queries=5).collect():
        got.setdefault(r["query"], []).append((r["rank"], r["item"], r["cosine"]))
    for q in range(0, 600, 50):
        a = vectors[q] / np.linalg.norm(vectors[q])
        want = sorted((-round(float(a @ v / np.linalg.norm(v)), 7), i) for i, v in vectors.items() if i != q)[:20]
        assert [(i, round(c, 7)) for _, i, c in sorted(got[q])] == [(i, -c) for c, i in want]
    assert len(got[900]) == 20 and all(c is None for _, _, c in got[900])


def test_training_rows_are_dealt_into_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(modelling, "TASK_ROWS", 100)
    rows = spark.range(0, 950, 1, 2).select(F.col("id"), (F.col("id") % 7).cast("double").alias("x"))
    assert modelling.in_tasks(rows).rdd.getNumPartitions() == 10 and modelling.in_tasks(rows).count() == 950
    assert modelling.in_tasks(rows.limit(50)).count() == 50


def test_sensitivity_ranks_kinds_of_rows(spark, monkeypatch):
    from collections import Counter

    import numpy as np
    import pandas as pd

    from admill.operators import scoring

    rng = np.random.default_rng(5)
    data = pd.DataFrame({"ad_id": rng.permutation(3000), "p_days_active": rng.integers(1, 5, 3000) / 4, "p_brand_scaling_count": rng.integers(1, 3, 3000) / 2, "p_collation_count": rng.integers(1, 4, 3000) / 3})
    ranked = Counter()
    monkeypatch.setattr(scoring, "with_row_number", lambda df, *a, **b: ranked.update(["whole"]) or df)  # an order of all rows per scenario took an hour
    monkeypatch.setattr(scoring, "average_ranks", lambda df, *a, **b: ranked.update(["whole"]) or df)
    got = {r["scenario"]: r for r in scoring.sensitivity(spark.createDataFrame(data)).collect()}
    assert not ranked
    d, b, c = data["p_days_active"], data["p_brand_scaling_count"], data["p_collation_count"]
    scores = {k: (w[0] * d + w[1] * d * b + w[2] * c).round(9) for k, w in scoring.SCENARIOS.items()}
    tops = {k: set(data.assign(s=s).sort_values(["s", "ad_id"], ascending=[False, True])["ad_id"][:600]) for k, s in scores.items()}
    first = next(iter(scores))
    for k, s in scores.items():
        assert abs(got[k]["spearman"] - scores[first].rank().corr(s.rank())) < 1e-9
        assert abs(got[k]["top_jaccard"] - len(tops[first] & tops[k]) / len(tops[first] | tops[k])) < 1e-12


def test_stream_asks_for_state_by_ad(monkeypatch):
    from datetime import date
    from types import SimpleNamespace

    from pyspark.sql import Row
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from admill.streaming import lifecycle_stream as ls

    asked = []

    class State:
        def __init__(self):
            self.held = None

        def __getattr__(self, name):
            def ask(*a):
                asked.append(name)
                if name == "get":
                    return self.held if not isinstance(self.held, list) else iter(self.held)
                if name == "update":
                    self.held = a[0]
                if name == "appendList":
                    self.held = [*(self.held or []), *a[0]]
                if name in ("exists", "containsKey"):
                    return False

            return ask

    kinds = {"observation_id": LongType(), "observed_at": LongType(), "reported_stop_date": StringType()}
    lives = ls.Lifecycles(StructType([StructField(c, t) for c, t in kinds.items()]))
    lives.init(SimpleNamespace(getValueState=lambda *a: State(), getListState=lambda *a: State(), getMapState=lambda *a: State()))
    row = lambda i: Row(observation_id=i, ad_id=1, observed_at=i, observed_status=("active", "not_observed", "explicitly_inactive", "not_observed")[i % 4], poll_complete=i % 3 > 0, reported_stop_date=str(date(2024, 1, 1 + i % 28)))
    batches = [range(100, 200), [*range(0, 100), *range(150, 250)], [7, 130], [250, 250]]
    for at, batch in enumerate(batches):
        asked.clear()
        out = list(lives.handleInputRows((1,), iter(map(row, batch)), None))
        assert len(asked) <= 4  # two for each row before
        done = sorted({i for b in batches[: at + 1] for i in b})
        want = ls.NEW
        for i in done:
            want = ls.step(want, i, *row(i)[3:])
        assert not out if at == 2 else tuple(out[0])[2:] == want
        assert at == 2 or sorted(o.observation_id for o in out[0].fresh) == sorted(set(batch) - {i for b in batches[:at] for i in b})


def test_band_pairs_stay_in_their_tasks(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(11)
    base = rng.integers(0, 1 << 32, 128)
    signatures = np.tile(base, (120, 1))
    for s in signatures:  # of one band, most too far apart for a link; every third near the one before
        s[4:] = np.where(rng.random(124) < 0.4, rng.integers(0, 1 << 32, 124), s[4:])
    for i in range(2, 120, 3):
        signatures[i] = signatures[i - 1]
        signatures[i][rng.choice(np.arange(4, 128), 20, replace=False)] = 7
    ids, roots = np.arange(120), np.arange(120) // 40 * 40 + np.arange(120) % 40
    rooted = spark.createDataFrame([(0, 5, int(i), int(r)) for i, r in zip(ids, roots)], "band int, h long, first long, root long")
    kinds = spark.createDataFrame([(int(i), s.tolist()) for i, s in zip(ids, signatures)], "first long, s array<long>")
    want = {(i, j) for i in range(120) for j in range(i + 1, 120) if (signatures[i] == signatures[j]).sum() >= 103}
    assert len(want) == 40
    for chunk in (4096, 25):
        monkeypatch.setattr(similarity, "CHUNK", chunk)
        got = [tuple(r) for r in similarity.band_links(rooted, kinds, 103).collect()]
        assert sorted(got) == sorted(want)
    copies = spark.createDataFrame([(int(i), base.tolist()) for i in ids], "first long, s array<long>")
    monkeypatch.setattr(similarity, "CHUNK", 4096)
    assert similarity.band_links(rooted, copies, 103).count() == 119  # links that join classes, not 7,140 pairs


def test_concordance_deals_its_blocks_by_rows(spark, monkeypatch):
    import numpy as np

    from admill.operators import survival

    rng = np.random.default_rng(2)
    t, e, r = rng.integers(0, 40, 700), rng.random(700) < 0.6, rng.integers(0, 300, 700) / 8
    rows = spark.createDataFrame([(int(a), bool(b), float(c)) for a, b, c in zip(t, e, r)], "t long, e boolean, r double")
    monkeypatch.setattr(survival, "TASK_ROWS", 500)
    monkeypatch.setattr(survival, "RANGE_ROWS", 5)
    tasks, dealt = [], survival.block_points
    monkeypatch.setattr(survival, "block_points", lambda *a: tasks.append((out := dealt(*a)).rdd.glom().map(len).collect()) or out)
    got = survival.concordance(rows, "t", "e", "r").first()
    pairs = e[:, None] & (t[None] > t[:, None])
    good = (pairs * np.where(r[None] < r[:, None], 1.0, np.where(r[None] == r[:, None], 0.5, 0.0))).sum()
    assert got["pairs"] == pairs.sum() and abs(got["concordance"] - good / pairs.sum()) < 1e-12
    assert len(tasks[0]) >= 7 and max(tasks[0]) < 1000  # the session's four partitions before, whatever the rows
