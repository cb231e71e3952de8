"""Tail probabilities, near-duplicate classes, page functions and reviews on literal rows."""

import pytest
from pyspark.sql import functions as F

from admill.functions import distributions, html, money, text, tree
from admill.operators import evaluation, graph, ordering, similarity, statistics, survival


def test_tail_probabilities():
    # published critical values at five and one per cent
    for t, df, p in ((2.228139, 10, 0.05), (12.7062, 1, 0.05), (2.5758, 10**7, 0.01)):
        assert distributions.t_tail(t, df) == pytest.approx(p, rel=1e-3) == distributions.t_tail(-t, df)
    for f, a, b, p in ((4.102821, 2, 10, 0.05), (3.098391, 3, 20, 0.05), (6.8949, 4, 12, 0.0040)):
        assert distributions.f_tail(f, a, b) == pytest.approx(p, rel=2e-2)
    assert distributions.incomplete_beta(2, 3, 0.5) == pytest.approx(0.6875) and distributions.t_tail(0, 7) == 1


def test_tests_of_targets(spark):
    rows = spark.createDataFrame([(float(i), float(i % 7) + (20 if i % 2 else 0), "ab"[i % 2], None if i % 3 else 1) for i in range(60)], "x double, y double, g string, m int")
    r = statistics.pearson_test(rows, "x", "y").first()
    assert r["n"] == 60 and 0 < r["p"] < 1
    assert statistics.anova_test(rows, "g", "y").first()["p"] < 1e-9
    w = statistics.welch_test(rows, "m", "y").first()
    assert w["n_null"] == 40 and w["likely_mnar"] == (w["p"] < 0.05)
    assert statistics.pearson_test(rows.limit(5), "x", "y").first()["p"] is None


def test_clean_price():
    cases = {"$49.99": 49.99, "1,234.56 USD": 1234.56, "€29.99": 29.99, "call for price": None, "": None, "$59.99 $39.99": 39.99, "$ 49.99": 49.99, "-5": -5.0, "$49.99/2": 49.992, None: None}
    from pyspark.sql import SparkSession

    df = SparkSession.getActiveSession().createDataFrame([(k,) for k in cases], "raw string")
    assert {r["raw"]: r["p"] for r in df.select("raw", money.clean_price(F.col("raw")).alias("p")).collect()} == cases


def test_minhash_classes_equal_all_pairs(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[: 60 - k] + [f"n{j}" for j in range(k)]) for k in (0, 1, 2, 4, 8, 16, 30)] + [" ".join(f"o{i}{j}" for j in range(30)) for i in range(5)] + [" ".join(base)] * 3 + [None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    signed = {r["id"]: r["s"] for r in rows.select("id", similarity.minhash(F.col("t")).alias("s")).collect() if r["s"]}
    for least in (0.8, 0.95):
        root = {i: i for i in signed}
        for a in signed:
            for b in signed:
                if a < b and sum(x == y for x, y in zip(signed[a], signed[b])) >= least * similarity.PERMUTATIONS:
                    low, high = sorted((root[a], root[b]))
                    root = {i: low if v == high else v for i, v in root.items()}
        got = {r["id"]: r["first"] for r in similarity.near_duplicates(rows, "id", "t", least).collect()}
        assert got == {i: v for i, v in root.items() if v != i}
    assert similarity.bands_for(0.8) == 32 and similarity.bands_for(0.95) == 8


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 50), (60, 61)], "a long, b long")
    assert {r["node"]: r["root"] for r in graph.components(links).collect()} == {**{i: 0 for i in range(1, 31)}, 61: 60}


def test_concordance_of_continuous_risks(spark):
    import random

    rng = random.Random(3)
    rows = [(float(rng.randrange(40)), rng.random() < 0.6, rng.choice([rng.random(), 0.5])) for _ in range(300)]
    good = pairs = 0
    for t, e, r in rows:
        for u, _, s in rows:
            if e and u > t:
                pairs += 1
                good += 1.0 if s < r else 0.5 if s == r else 0
    out = survival.concordance(spark.createDataFrame(rows, "t double, e boolean, r double"), "t", "e", "r").first()
    assert out["pairs"] == pairs and out["concordance"] == pytest.approx(good / pairs)
    assert survival.concordance(spark.createDataFrame([], "t double, e boolean, r double"), "t", "e", "r").first()["pairs"] == 0


def test_quantiles(spark):
    rows = spark.createDataFrame([(float(x),) for x in (5, 1, 4, 2, 3, 3)] + [(None,)], "x double")
    assert ordering.quantiles(rows, "x", [0, 0.25, 0.5, 0.9, 1]) == [1, 2.25, 3, 4.5, 5]
    assert ordering.quantiles(rows.limit(0), "x", [0.5]) == []


PAGE = """<html><head><title>Rosa Beet – Shop</title><script>window.ShopifyAnalytics.meta.product = {"price": 4999, "variants": [{"title": "1 bottle"}, {"name": "3 bottles"}]};
{"shop": {"name": "Rosa Labs"}}</script></head><body><nav><div>$1 off</div></nav><div>Beet root capsules, one bottle for $49.99, order now and save, with everything that a long hero section of a page may say about it.</div>
<section>4.8 stars, 134 reviews</section><ul><li>60 capsules</li><li>Vegan</li></ul></body></html>"""


def test_page_functions(spark):
    row = spark.createDataFrame([(PAGE,)], "h string").select(
        html.title(F.col("h")).alias("t"), html.product_name(html.title(F.col("h"))).alias("n"), html.window_product(F.col("h")).alias("w"), tree.zones(F.col("h")).alias("z")
    ).withColumn("p", tree.pruned(F.col("z"))).first()
    assert (row["t"], row["n"]) == ("Rosa Beet – Shop", "Rosa Beet")
    assert tuple(row["w"]) == ("Rosa Labs", 49.99, ["1 bottle", "3 bottles"])
    assert "$49.99" in row["z"]["hero"] and "134 reviews" in row["z"]["social_proof"] and row["z"]["specs"] == "<ul><li>60 capsules</li><li>Vegan</li></ul>"
    assert row["p"].startswith("Page title: Rosa Beet") and "$1 off" not in row["p"]
    names = spark.createDataFrame([("A | B – C",), ("no separator",), (" | x",), ("y" * 60 + " | z",), (None,)], "t string")
    assert [r[0] for r in names.select(html.product_name(F.col("t"))).collect()] == ["A", None, None, None, None]
    told = spark.createDataFrame([('{"type":"root","children":[{"type":"text","value":"One "},{"type":"text","value":"two"}]}',), ("<p>plain</p>",), (None,)], "d string")
    assert [r[0] for r in told.select(html.description(F.col("d"))).collect()] == ["One  two", "plain", ""]


def test_review_strata(spark):
    rows = spark.createDataFrame([("Collagen cream for your DOG", ["Beauty", ""]), (None, None)], "t string, q array<string>")
    assert [r[0] for r in rows.select(text.review_strata(F.col("t"), F.col("q"))).collect()] == [["candidate:collagen", "possible_pet", "possible_topical", "query:beauty"], ["query:unknown"]]


def test_adjudication(spark):
    kind = "ad_id string, primary struct<reviewer: string, label: boolean, subcategory: string, rationale: string>, secondary struct<reviewer: string, label: boolean, subcategory: string, rationale: string>, adjudication struct<reviewer: string, label: boolean, subcategory: string, rationale: string>"
    yes, no = ("a", True, "x", ""), ("a", False, None, "")
    rows = [
        ("1", yes, None, None), ("2", yes, ("b", True, "x", ""), None), ("3", yes, ("b", False, None, ""), ("c", True, "x", "seen")), ("4", yes, ("b", True, "y", ""), None), ("5", yes, ("a", True, "x", ""), None),
        ("6", no, ("b", True, "x", ""), ("a", True, "x", "seen")), ("7", no, ("b", True, "x", ""), ("c", True, "x", " ")), ("8", ("", True, "x", ""), None, None), ("9", no, ("b", False, "z", ""), None),
    ]
    out = {r["ad_id"]: (r["outcome"], r["final_label"]) for r in evaluation.adjudicated(spark.createDataFrame(rows, kind)).collect()}
    assert out == {
        "1": ("primary", True), "2": ("agreed", True), "3": ("adjudicated", True), "4": ("adjudication_missing", None), "5": ("same_reviewer", None),
        "6": ("adjudicator_not_independent", None), "7": ("rationale_missing", None), "8": ("primary_incomplete", None), "9": ("agreed", False),
    }
    good = [(str(i), (yes if i % 2 else no), (("b", *(yes if i % 2 else no)[1:])), None) for i in range(10)]
    frame = spark.createDataFrame(good, kind)
    report = evaluation.adjudication_report(frame.select("ad_id"), frame).first()
    assert (report["status"], report["n_approved"], report["kappa"]) == ("passed", 5, 1.0)
    report = evaluation.adjudication_report(frame.select("ad_id").limit(9), frame).first()
    assert report["status"] == "failed" and report["n_approved"] == 0 and "extra_reviews" in report["failures"]
