"""Relational, lifecycle, survival and statistics operators on literal rows."""

from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from admill.operators import guide, lifecycle, normalize, relational, scoring, similarity, splits, statistics, survival
from admill.sources import readers, sinks
from admill.streaming import lifecycle_stream

OBS = "observation_id int, ad_id int, observed_at timestamp, observed_status string, poll_complete boolean, reported_stop_date date"


def fold(rows, misses=2):
    """The state machine, one observation after the other."""
    state, last, first, event, stop, n = "unknown", None, None, None, None, 0
    for at, status, complete, reported in rows:
        if status == "active":
            state, last, first, n = "active", at, None, 0
        elif status == "explicitly_inactive":
            state, event, stop, n = "inactive_explicit", at, reported, 0
        elif status == "not_observed" and complete:
            n += 1
            first = first or at
            if state != "inactive_explicit" and n >= misses:
                state, event = "inactive_inferred", first
    return state, last, first, event, stop, n


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["active", "explicitly_inactive", "not_observed", "unknown"]), st.booleans()), min_size=1, max_size=9), min_size=1, max_size=12))
def test_lifecycle(spark, histories):
    rows, expected = [], {}
    for ad, history in enumerate(histories):
        steps = [(datetime(2024, 1, 1 + i), s, c, datetime(2024, 1, 1 + i).date() if s == "explicitly_inactive" else None) for i, (s, c) in enumerate(history)]
        rows += [(100 * ad + i, ad, *s) for i, s in enumerate(steps)]
        expected[ad] = fold(steps)
    got = lifecycle.resolve(spark.createDataFrame(rows, OBS)).collect()
    assert {r["ad_id"]: (r["state"], r["last_active_at"], r["first_missing_at"], r["event_at"], r["reported_stop_date"], r["consecutive_complete_misses"]) for r in got} == expected


def test_best_offer(spark):
    kind = "array<struct<id: int, quantity: int, price_per_unit: double, is_best_value: boolean>>"
    cases = [([(1, 2, 5.0, False), (2, 1, 9.0, False)], 2), ([(1, 2, 5.0, False), (2, 1, 9.0, True)], 2), ([(1, 3, 5.0, False), (2, 2, 4.0, False)], 2), ([(1, 3, None, None)], 1), ([], None)]
    df = spark.createDataFrame([(o, e) for o, e in cases], f"o {kind}, e int").select(relational.best_offer(F.col("o"))["id"].alias("got"), "e")
    assert all(r["got"] == r["e"] for r in df.collect())


def test_score_weights_must_sum_to_one():
    with pytest.raises(ValueError):
        scoring.validated({"longevity": 0.5, "longevity_scaling_interaction": 0.2, "variant_boost": 0.1})


def test_score_of_variants_only(spark):
    rows = spark.createDataFrame([(1, 5, 1, 0), (2, 5, 1, 4)], "ad_id int, days_active int, brand_scaling_count int, collation_count int")
    out = scoring.success_score(rows, weights={"longevity": 0.0, "longevity_scaling_interaction": 0.0, "variant_boost": 1.0})
    assert {r["ad_id"]: r["composite_success_score"] for r in out.collect()} == {1: 0.5, 2: 1.0}


def test_scrape_stamp(spark):
    rows = spark.createDataFrame([("a",)] * 9 + [("b",)], "end_date string")
    assert [r["end_date"] for r in survival.scrape_dates(rows, 0.1).collect()] == ["a"]


def test_survival_reaches_zero(spark):
    rows = spark.createDataFrame([(1, True), (2, False), (3, True)], "d int, e boolean")
    assert [r["survival"] for r in survival.kaplan_meier(rows, "d", "e").orderBy("t").collect()] == pytest.approx([2 / 3, 2 / 3, 0.0])


def test_novelty_and_empty_tables(spark):
    a, none = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([], "k int")
    assert tuple(relational.novelty(a, none, "k").first()) == (2, 0, 0)
    assert tuple(relational.novelty(none, a, "k").first()) == (0, 0, 2)


def test_admission_outcomes(spark):
    ads = spark.createDataFrame([(i,) for i in range(7)], "ad_id int")
    p = spark.createDataFrame([(1, True, 0.5), (2, True, 0.95), (3, False, 0.95), (4, None, 0.95), (5, True, 0.1), (6, True, 0.1)], "ad_id int, predicted boolean, confidence double")
    g = spark.createDataFrame([(5, True), (6, False)], "ad_id int, truth boolean")
    got = [r["outcome"] for r in relational.admit(ads, p, g, "ad_id", 0.9).orderBy("ad_id").collect()]
    assert got == ["missing_prediction", "queued_low_confidence", "accepted_classifier", "rejected_classifier", "invalid_prediction", "accepted_human", "rejected_human"]


def test_psi_of_equal_halves_is_zero(spark):
    rows = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert statistics.psi(rows, rows, "x").first()["psi"] == pytest.approx(0.0)
    flat = spark.range(10).select(F.lit(1.0).alias("x"))
    assert statistics.psi(flat, rows, "x").first()["psi"] == 0.0


def test_kappa_without_variation_is_null(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1)], "a int, b int")
    assert statistics.cohen_kappa(rows, "a", "b").first()["kappa"] is None


def test_bootstrap_covers_the_difference(spark):
    rows = spark.range(3000).select((F.col("id") % 60).alias("g"), F.rand(1).alias("a"), F.lit(0.5).alias("p"))
    r = statistics.cluster_bootstrap(rows, "g", "a", "p", 2.0, resamples=300).first()
    assert r["clusters"] == 60 and r["difference_lower_95"] < r["difference"] < r["difference_upper_95"] < 0


def test_missing_evidence_blocks(spark):
    columns = "taxonomy_status string, enrichment_status string, worktree_dirty boolean, advertiser_overlap int, n_test int, n_test_advertisers int, n_clusters int, test_mae double, baseline_mae double, mae_upper_95 double, precision_lower_95 double"
    rows = spark.createDataFrame([("passed", "passed", False, 0, 200, 20, 20, 0.3, 0.4, -0.01, 0.3), ("passed", None, None, 0, 200, 20, 20, 0.3, 0.4, None, 0.3)], columns)
    a, b = statistics.promotion(rows).collect()
    assert a["status"] == "promoted" and b["failed_checks"] == "product_enrichment_passed,git_worktree_clean,mae_bootstrap_interval_below_zero"


def test_diversified_top(spark):
    rows = spark.createDataFrame([(1, "p", 0.9), (2, "p", 0.8), (3, "q", 0.1), (4, None, 0.05)], "ad_id int, page string, s double")
    got = splits.diversified_top(rows, "s", splits.advertiser(F.col("page"), F.col("ad_id")), "ad_id", 4).collect()
    assert [r["ad_id"] for r in got] == [1, 3, 4, 2]


def test_jaccard_pairs_equal_brute_force(spark):
    sets = {i: {f"t{(i * 7 + j * j) % 23}" for j in range(6)} for i in range(40)}
    rows = spark.createDataFrame([(i, " ".join(s)) for i, s in sets.items()], "id int, t string")
    got = {(r["a"], r["b"]) for r in similarity.jaccard_pairs(rows, "id", similarity.token_set(F.col("t")), 0.6).collect()}
    assert got == {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}


def test_near_duplicates_point_to_the_earliest(spark):
    base = [f"w{i}" for i in range(300)]
    rows = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base[1:])), (3, "other words here"), (4, " ".join(base)), (5, ""), (6, None)], "id int, t string")
    assert {(r["id"], r["first"]) for r in similarity.near_duplicates(rows, "id", "t", 0.9).collect()} == {(2, 1), (4, 1)}


def test_guide_and_alignment(spark):
    e = spark.createDataFrame([("categorical__creative_cta_type_shop_now", 0.5, 0.6, "shap"), ("categorical__cta_type_unknown", 0.5, 0.6, "shap"), ("numeric__rating", -0.001, 0.5, "shap"), ("other", 1.0, 1.0, "shap")], "feature string, signed double, absolute double, source string")
    buckets = spark.createDataFrame([("cta_type", "visual"), ("rating", "visual")], "dimension string, bucket string")
    d = guide.directives(guide.parse_features(e, ["cta", "cta_type", "rating"]), buckets)
    assert {(r["dimension"], r["value"], r["direction"]) for r in d.collect()} == {("cta_type", "shop_now", "higher_is_better"), ("rating", None, "unknown")}
    ads = spark.createDataFrame([(1, "shop_now"), (2, "other"), (3, None)], "ad_id int, cta_type string")
    assert {r["ad_id"]: r["alignment"] for r in guide.alignment(ads, "ad_id", d, ["cta_type"]).collect()} == {1: 1, 2: 0, 3: 0}


def test_normalize_ads(spark):
    items = [
        '{"ad_archive_id":"1","page_id":5,"start_date":1704067200,"end_date":1704153600,"publisher_platform":["a","b"],"snapshot":{"body":{"text":"hi"},"images":[{"original_image_url":"","resized_image_url":"r"}]},"impressions_with_index":{"impressions_index":-1,"impressions_text":"x"}}',
        '{"adArchiveID":"2","startDate":"2024-01-05T00:00:00Z","publisherPlatform":"a","snapshot":{"body":"plain","videos":[{"video_sd_url":"v","video_preview_image_url":"p"}],"cards":[{"video_hd_url":"h"}]}}',
        '{"id":"3","snapshot":{}}',
    ]
    rows = spark.createDataFrame([(i,) for i in items], "value string").select(F.parse_json("value").alias("raw"))
    a, b, c = normalize.normalize_ads(rows, "2024-01-10").orderBy("ad_archive_id").collect()
    assert (a["start_date"], a["days_active"], a["image_urls"], a["body"], a["impressions_index"], a["is_active"], a["page_id"]) == ("2024-01-01", 1, ["r"], "hi", None, False, "5")
    assert (b["days_active"], b["image_urls"], b["video_urls"], b["body"], b["publisher_platforms"], b["is_active"]) == (5, ["p"], ["v", "h"], "plain", ["a"], True)
    assert (c["days_active"], c["image_urls"], c["body"], c["start_date"], c["snapshot_url"]) == (0, [], "", None, "https://www.facebook.com/ads/library/?id=3")


def test_merge_pages(spark):
    kind = "url string, brand string, price double, all_variants boolean"
    base = spark.createDataFrame([("u", "", 0.0, False), ("v", "B", 1.0, None)], kind)
    other = spark.createDataFrame([("u", "X", 5.0, True)], kind)
    a, b = normalize.merge_pages(base, other, "url", ["brand", "price"], ["all_variants"]).orderBy("url").collect()
    assert tuple(a) == ("u", "X", 5.0, True, True) and tuple(b)[:4] == ("v", "B", 1.0, False)


def test_sources_and_sinks(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "a.json").write_text('{"ad_id":"1","x":1}')
    (folder / "b.json").write_text('{"ad_id":"1","x":2}')
    (folder / "c.json").write_text("{broken")
    assert [tuple(r) for r in readers.document_folder(spark, str(folder), "ad_id string, x int").collect()] == [("1", 2)]
    (tmp_path / "o.json").write_text('{"observations":[{"ad_id":"1"},{"ad_id":"2"}]}')
    (tmp_path / "p.json").write_text('[{"ad_id":"3"}]')
    got = [r["ad_id"] for p in ("o.json", "p.json") for r in readers.observation_log(spark, str(tmp_path / p), "struct<ad_id: string>").collect()]
    assert got == ["1", "2", "3"]
    blocks = spark.createDataFrame([(1, "r", None, "Page"), (1, "a", "r", "Text"), (1, "b", "a", None), (1, "c", "b", "Text")], "doc int, id string, parent string, block_type string")
    assert {(r["id"], r["depth"]) for r in readers.block_tree(blocks).collect()} == {("r", 0), ("a", 1), ("c", 3)}
    rows = spark.createDataFrame([(1, "x")], "a int, b string")
    assert sinks.publish_immutable(rows, str(tmp_path / "w")) and not sinks.publish_immutable(rows, str(tmp_path / "w"))
    with pytest.raises(ValueError):
        sinks.publish_immutable(spark.createDataFrame([(2, "x")], "a int, b string"), str(tmp_path / "w"))


def test_lifecycle_stream(spark, tmp_path):
    rows = [(i, i % 2, datetime(2024, 1, 1 + i), "active" if i < 2 else "not_observed", True, None) for i in range(6)]
    df = spark.createDataFrame(rows, OBS)
    for part in (df.filter("observation_id < 3"), df):
        part.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        lifecycle_stream.run(stream, str(tmp_path / "log"), str(tmp_path / "states"), str(tmp_path / "cp")).awaitTermination()
    states = {r["ad_id"]: (r["state"], r["observation_count"]) for r in lifecycle_stream.current_states(spark, str(tmp_path / "states")).collect()}
    assert states == {0: ("inactive_inferred", 3), 1: ("inactive_inferred", 3)}


def test_cox_equals_a_direct_solution(spark):
    import numpy as np

    from admill.operators import modelling

    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    t = rng.exponential(30 * np.exp(-0.8 * x[:, 0] + 0.3 * x[:, 1])).astype(int)
    e = rng.random(300) < 0.8
    rows = spark.createDataFrame([(int(a), bool(b), float(c), float(d)) for a, b, (c, d) in zip(t, e, x)], "t int, e boolean, a double, b double")
    got = modelling.proportional_hazards(rows, "t", "e", ["a", "b"])
    z = (x - x.mean(0)) / x.std(0)

    def gradient(beta):
        risk = np.exp(z @ beta)
        g = -beta
        for i in np.flatnonzero(e):
            at = t >= t[i]
            g = g + z[i] - (risk[at, None] * z[at]).sum(0) / risk[at].sum()
        return g

    assert np.abs(gradient(np.array([got["a"], got["b"]]))).max() < 1e-4 and got["a"] > 0.5 > 0 > got["b"]


def test_storefront_and_provenance(spark):
    from admill.operators import products

    doc = '{"product":{"title":"P","vendor":"V","tags":"a, b","body_html":"<p>Hi <b>you</b></p>","variants":[{"title":"S","price":"9.50"},{"title":"Default Title","price":"12.00"}]}}'
    r = spark.range(1).select(products.storefront_product(F.parse_json(F.lit(doc))).alias("p")).first()["p"]
    assert (r["price"], r["price_range"], r["variants"], r["tags"], r["description"]) == (9.5, "9.50-12.00", ["S"], ["a", "b"], "Hi you")
    rows = spark.createDataFrame([(1, ("m", "f" * 64)), (2, (None, "short")), (3, ("", "a" * 64))], "id int, provenance struct<model: string, sha: string>")
    got = [r["reasons"] for r in products.provenance_reasons(rows, ["model", "sha"], ["sha"]).orderBy("id").collect()]
    assert got == [[], ["missing_model", "invalid_sha"], ["blank_model"]]
