"""Queries of page, layout and clean-up functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from admill.functions import color, dates, geometry, html, money, pixels, text, tiers, tree, url
from admill.operators import modelling, normalize, relational as rel, splits
from admill.plans.registry import query
from admill.plans.scalar import _TEXT
from admill.plans.views import AS_OF, ads, table


@query("""SELECT page_id, len(list_distinct(regexp_extract_all(html, '(?i)<img[^>]*\\bsrc="([^"]+)"', 1))) AS images FROM pages WHERE len(regexp_extract_all(html, '(?i)<img[^>]*\\bsrc="([^"]+)"', 1)) > 0""")
def pages_with_images(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.size(html.image_addresses(F.col("html"))).alias("images")).filter("images > 0")


_TITLE = "trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g'))"


@query(f"""WITH t AS (SELECT page_id, {_TITLE} AS title FROM pages), s AS (SELECT *, regexp_split_to_array(title, '\\s+[–|]\\s+') AS parts FROM t)
SELECT page_id, title, CASE WHEN len(parts) > 1 AND trim(parts[1]) <> '' AND length(trim(parts[1])) <= 50 THEN trim(parts[1]) END AS product FROM s""")
def page_titles(spark, sf):
    title = html.title(F.col("html"))
    return table(spark, sf, "pages").select("page_id", title.alias("title"), html.product_name(title).alias("product"))


@query(f"SELECT page_id, substr(t, 1, 3000) AS description FROM (SELECT page_id, {_TEXT} AS t FROM pages)")
def page_descriptions(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.description(F.col("html")).alias("description"))


_CASCADED = f"""SELECT page_id, {_TITLE} AS title, page_id % 5 AS k, CAST(10 + page_id % 90 AS DOUBLE) AS price FROM pages"""


@query(f"""WITH t AS ({_CASCADED}), s AS (SELECT *, regexp_split_to_array(title, '\\s+[–|]\\s+') AS parts FROM t)
SELECT page_id, CASE WHEN k = 1 THEN 'P' || page_id WHEN len(parts) > 1 AND trim(parts[1]) <> '' AND length(trim(parts[1])) <= 50 THEN trim(parts[1]) END AS product_name, CASE WHEN k < 4 THEN price END AS product_price,
CASE k WHEN 0 THEN 'xhr' WHEN 1 THEN 'json_ld' WHEN 2 THEN 'window' WHEN 3 THEN 'dom' END AS price_tier, CAST(CASE k WHEN 0 THEN 4.5 WHEN 1 THEN 4.25 WHEN 3 THEN 3.5 END AS DOUBLE) AS rating,
CASE k WHEN 0 THEN page_id WHEN 1 THEN page_id + 1 WHEN 3 THEN page_id + 3 END AS rating_count, CASE k WHEN 0 THEN 'xhr' WHEN 1 THEN 'json_ld' WHEN 3 THEN 'dom' END AS count_tier FROM s""")
def product_cascade(spark, sf):
    """Pages with the same product told at different tiers, a lower tier repeated below with another price."""
    k, n, price = F.col("page_id") % 5, F.col("page_id").cast("string"), (10 + F.col("page_id") % 90).cast("string")
    said = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    answer = said('[{"url": "x"}, {"body": {"products": [{"variants": [{"title": "a", "price": "', price, '"}, {"price": 2000}]}], "average_rating": "4.5", "reviews_count": ', n, "}}]")
    ld = said('<script type="application/ld+json">{"@type": ["Product"], "name": "P', n, '", "offers": [{"price": "', price, '"}], "aggregateRating": {"ratingValue": 4.25, "reviewCount": ', (F.col("page_id") + 1).cast("string"), "}}</script>")
    script = said('<script>window.__INITIAL_STATE__ = {"price": ', (F.col("page_id") % 90 * 100 + 1000).cast("string"), "};</script>")
    script = F.when(F.col("page_id") % 90 == 0, said('<script>window.__INITIAL_STATE__ = {"price": 10};</script>')).otherwise(script)
    element = said('<s class="money"> </s><span class="x price">$', price, '</span><div class="jdgm-widget" data-average-rating="3.5" data-number-of-reviews="', (F.col("page_id") + 3).cast("string"), '"></div>')
    lower = said('<span class="price">$5</span>')
    before = F.when(k == 1, F.concat(ld, lower)).when(k == 2, F.concat(script, lower)).when(k == 3, element).otherwise(F.lit(""))
    pages = table(spark, sf, "pages").select("page_id", "url", F.concat(before, F.col("html")).alias("html"), F.when(k == 0, answer).alias("fetched"))
    out = tiers.cascade(pages, fetched="fetched")
    return out.select("page_id", "product_name", "product_price", F.col("told_by")["product_price"].alias("price_tier"), "rating", "rating_count", F.col("told_by")["rating_count"].alias("count_tier"))


@query()
def page_zones(spark, sf):
    """Zones need an element tree, which SQL lacks; tests hold all pages against a plain version by another parser of nesting."""
    found = table(spark, sf, "pages").select("page_id", tree.zones(F.col("html")).alias("z"))
    return found.select("page_id", "z.hero", "z.social_proof", "z.specs", "z.from_zones", tree.pruned(F.col("z")).alias("pruned"))


@query()
def block_runs(spark, sf):
    """Paragraph runs of every page; they need an element tree, so tests hold all pages against a plain parser."""
    found = table(spark, sf, "pages").select("page_id", tree.block_runs(F.col("html")).alias("b"))
    return found.select("page_id", F.posexplode("b.runs").alias("place", "r")).select("page_id", "place", "r.*")


_NAMED = ", ".join([f"CASE WHEN regexp_matches(text, '{p}') THEN '{k}' END" for k, p in text.RISKS.items()] + [f"CASE WHEN regexp_matches(text, '{p}') THEN 'candidate:{k}' END" for k, p in text.CANDIDATES.items()])


@query(f"""WITH s AS (SELECT conv_id, turn, list_sort(list_distinct(list_filter(list_concat(CASE WHEN turn > 0 THEN ['query:' || lower(role)] ELSE [] END, [{_NAMED}]), lambda x: x IS NOT NULL))) AS s FROM conversations)
SELECT conv_id, turn, array_to_string(CASE WHEN len(s) = 0 THEN ['query:unknown'] ELSE s END, ',') AS strata FROM s""")
def review_strata(spark, sf):
    asked = F.when(F.col("turn") > 0, F.array("role"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(text.review_strata(F.col("text"), asked), ",").alias("strata"))


@query("""SELECT role, array_to_string(list_sort(list_distinct(list(CAST(turn AS VARCHAR)))), ',') AS notes FROM conversations GROUP BY role""")
def sorted_unique_notes(spark, sf):
    return table(spark, sf, "conversations").groupBy("role").agg(F.array_join(text.sorted_notes(F.collect_set(F.col("turn").cast("string"))), ",").alias("notes"))


@query("""SELECT doc_id, CASE WHEN quality = 1 THEN lang END AS subcategory, CASE WHEN l.doc_id IS NULL THEN '' WHEN quality = 1 THEN 'human_adjudication' ELSE 'validated_classifier' END AS source FROM documents d LEFT JOIN labels l USING (doc_id)""")
def taxonomy_context(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    context = text.taxonomy_context(F.when(F.col("quality") == 1, "human_adjudication").when(F.col("quality") == 0, "validated_classifier"), F.col("lang"))
    return docs.select("doc_id", context["subcategory"].alias("subcategory"), context["source"].alias("source"))


@query("""WITH b AS (SELECT p_partkey, (p_partkey % 90) / 100.0 AS x, (p_partkey % 71) / 100.0 AS y, 0.1 + (p_size % 9) / 10.0 AS w, 0.1 + (p_size % 4) / 10.0 AS h, p_size % 2 = 0 AS first FROM part),
r AS (SELECT *, CASE WHEN w > 0.7 THEN 0.0 WHEN x + w / 2 < 0.5 THEN least(1.0, x + w + 0.03) ELSE 0.0 END AS rx,
  CASE WHEN w > 0.7 AND 1.0 - (y + h) >= y THEN least(1.0, y + h + 0.03) ELSE 0.0 END AS ry,
  CASE WHEN w > 0.7 THEN 1.0 WHEN x + w / 2 < 0.5 THEN greatest(0.0, 1.0 - least(1.0, x + w + 0.03)) ELSE greatest(0.0, x - 0.03) END AS rw,
  CASE WHEN w <= 0.7 THEN 1.0 WHEN 1.0 - (y + h) >= y THEN greatest(0.0, 1.0 - least(1.0, y + h + 0.03)) ELSE greatest(0.0, y - 0.03) END AS rh FROM b)
SELECT p_partkey, round(CASE WHEN rw * rh >= 0.15 THEN rx + 0.01 END, 6) AS x, round(CASE WHEN rw * rh >= 0.15 THEN ry + 0.01 + CASE WHEN first THEN 0 ELSE 0.6 * rh END END, 6) AS headline_y,
round(CASE WHEN rw * rh >= 0.15 THEN ry + 0.01 + CASE WHEN first THEN 0.8 * rh ELSE 0 END END, 6) AS cta_y, round(CASE WHEN rw * rh >= 0.15 THEN greatest(0.0, rw - 0.02) END, 6) AS width,
round(CASE WHEN rw * rh >= 0.15 AND rw < 1 AND greatest(0.0, 1.0 - least(1.0, y + h + 0.03)) >= 0.15 THEN least(1.0, y + h + 0.03) END, 6) AS offer_y FROM r""")
def layout_plan(spark, sf):
    x, y = F.pmod("p_partkey", F.lit(90)) / 100, F.pmod("p_partkey", F.lit(71)) / 100
    w, h = 0.1 + F.pmod("p_size", F.lit(9)) / 10, 0.1 + F.pmod("p_size", F.lit(4)) / 10
    plan = geometry.layout(x, y, w, h, F.col("p_size") % 2 == 0, F.lit(True))
    rows = table(spark, sf, "part").select("p_partkey", plan.alias("l"))
    fields = {"x": "l.headline.x", "headline_y": "l.headline.y", "cta_y": "l.cta.y", "width": "l.headline.width", "offer_y": "l.price_offer.y"}
    return rows.select("p_partkey", *[F.round(c, 6).alias(k) for k, c in fields.items()])


@query("""WITH h AS (SELECT l_returnflag AS f, CAST(l_quantity AS INT) AS v, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT f, sum(n) AS total, sum(n * v) AS whole FROM h GROUP BY f),
c AS (SELECT h.f, h.v, sum(n) OVER w AS below, sum(n * v) OVER w AS part, total, whole FROM h JOIN t ON t.f = h.f WINDOW w AS (PARTITION BY h.f ORDER BY h.v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT f AS l_returnflag, CAST(arg_max(v, below * (total - below) * (part / below - (whole - part) / (total - below)) * (part / below - (whole - part) / (total - below))) AS INT) AS threshold FROM c WHERE below < total GROUP BY f""")
def otsu_thresholds(spark, sf):
    """Quantities stand for grey levels."""
    counts = table(spark, sf, "lineitem").groupBy("l_returnflag", F.col("l_quantity").cast("int").alias("v")).agg(F.count("*").alias("n"))
    levels = counts.groupBy("l_returnflag").agg(F.map_from_entries(F.collect_list(F.struct("v", "n"))).alias("m"))
    histogram = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)).cast("double"))
    return levels.select("l_returnflag", color.otsu_threshold(histogram).alias("threshold"))


@query()
def pixel_colors(spark, sf):
    """Components of vectors stand for pixels; tests hold text colour and border against plain loops."""
    vectors = table(spark, sf, "embeddings").filter("size(embedding) >= 63")
    values = F.transform(F.slice("embedding", 1, 63), lambda v: F.pmod((F.abs(v) * 700).cast("int"), F.lit(256)))
    found = vectors.select("vec_id", pixels.colours(values, F.lit(7)).alias("c"))
    return found.select("vec_id", "c.text_color", F.array_join("c.palette", ",").alias("palette"), "c.border_color", color.background_style(F.col("c.border_deviation")).alias("style"))


@query("""SELECT l_returnflag, CASE WHEN stddev_pop(l_quantity) < 12 THEN 'Studio' WHEN stddev_pop(l_quantity) < 40 THEN 'Gradient' ELSE 'Busy' END AS style,
CASE WHEN max(l_quantity * 5) - min(l_quantity * 5) >= 140 THEN 'High' WHEN max(l_quantity * 5) - min(l_quantity * 5) <= 50 THEN 'Low' ELSE 'Medium' END AS contrast FROM lineitem GROUP BY 1""")
def background_styles(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.stddev_pop("l_quantity").alias("d"), F.array(F.min("l_quantity") * 5, F.max("l_quantity") * 5).alias("l"))
    return rows.select("l_returnflag", color.background_style(F.col("d")).alias("style"), color.contrast_class(F.col("l")).alias("contrast"))


@query("""SELECT p_partkey, CASE WHEN p_retailprice BETWEEN 2 AND 1500 THEN p_retailprice END AS price, CASE WHEN p_size / 8.0 > 0 AND p_size / 8.0 <= 5 THEN p_size / 8.0 END AS rating, round(p_size * 1e9 / 1073741824 * 0.02, 9) AS cost,
CASE p_partkey % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'us' WHEN 2 THEN 'gb' END AS region FROM part""")
def money_guards(spark, sf):
    host = F.element_at(F.array(*map(F.lit, ("www.amazon.de", "amazon.com", "smile.amazon.co.uk", "amazon.de.example.com"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf, "part").select(
        "p_partkey", money.accepted_price(F.col("p_retailprice")).alias("price"), money.accepted_rating(F.col("p_size") / 8.0).alias("rating"), F.round(money.monthly_cost(F.col("p_size") * 1e9), 9).alias("cost"), money.marketplace(host)["region"].alias("region")
    )


@query("""SELECT page_id, regexp_matches(regexp_extract(url, '//[^/?#]*([^?#]*)', 1), '/products?/[^/]+') AS is_product, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') || '.json' AS document FROM pages""")
def product_addresses(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", url.has_product_path(u).alias("is_product"), url.product_json(u).alias("document"))


@query("""WITH t AS (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS t, text FROM documents), h AS (SELECT *, substr(t, 1, 300) AS head FROM t), b AS (SELECT *, strpos(reverse(head), chr(10) || chr(10)) AS back FROM h)
SELECT doc_id, CASE WHEN length(t) <= 300 THEN t WHEN back > 0 THEN rtrim(substr(head, 1, length(head) - back - 1)) ELSE head END AS cut, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS plain FROM b""")
def text_clean_up(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", text.cut_at_paragraph(F.replace(t, F.lit("\n"), F.lit("\n\n")), 300).alias("cut"), text.normalised(t).alias("plain"))


@query("SELECT o_orderkey, o_orderkey % 2 = 0 AS grounded FROM orders")
def grounded_numbers(spark, sf):
    """Every other text tells a price one off."""
    told = F.concat(F.lit("now $"), F.format_number(F.col("o_totalprice") + F.col("o_orderkey") % 2, 2), F.lit(" only"))
    return table(spark, sf, "orders").select("o_orderkey", text.grounded_number(F.col("o_totalprice"), told).alias("grounded"))


@query(f"SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CASE WHEN o_orderstatus = 'F' THEN last_day(CAST(o_orderdate AS DATE)) ELSE DATE '{AS_OF}' END) AS INT) AS age FROM orders")
def target_ages(spark, sf):
    return ads(spark, sf).select(F.col("ad_id").alias("o_orderkey"), dates.target_age(F.col("start_date"), F.col("end_date"), F.lit(AS_OF).cast("date")).alias("age"))


@query("""WITH b AS (SELECT p_partkey, p_size AS x, p_size % 7 AS y, 10 + p_size % 5 AS w FROM part) SELECT p_partkey, CAST(x * 2.0 AS DOUBLE) AS x0, CAST((y + w) * 0.5 AS DOUBLE) AS y1,
round(greatest(0, least(x + w, 25) - greatest(x, 5)) * greatest(0, least(y + w, 25) - greatest(y, 5)) / (w * w + 400.0 - greatest(0, least(x + w, 25) - greatest(x, 5)) * greatest(0, least(y + w, 25) - greatest(y, 5))), 9) AS overlap FROM b""")
def box_overlaps(spark, sf):
    x, y, w = F.col("p_size"), F.col("p_size") % 7, 10 + F.col("p_size") % 5
    box = F.struct(x.alias("x0"), y.alias("y0"), (x + w).alias("x1"), (y + w).alias("y1"))
    fixed = F.struct(F.lit(5).alias("x0"), F.lit(5).alias("y0"), F.lit(25).alias("x1"), F.lit(25).alias("y1"))
    scaled = geometry.scaled(box, F.lit(2.0), F.lit(0.5))
    return table(spark, sf, "part").select("p_partkey", scaled["x0"].alias("x0"), scaled["y1"].alias("y1"), F.round(geometry.overlap(box, fixed), 9).alias("overlap"))


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS batch FROM orders")
def sink_batches(spark, sf):
    return splits.batches(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("SELECT c AS constant FROM (VALUES ('one', (SELECT count(DISTINCT 1) FROM orders)), ('status', (SELECT count(DISTINCT o_orderstatus) FROM orders))) v(c, n) WHERE n <= 1")
def constant_columns(spark, sf):
    rows = table(spark, sf, "orders").select(F.lit(1).alias("one"), F.col("o_orderstatus").alias("status"))
    return spark.createDataFrame([(c,) for c in modelling.constant_columns(rows, ["one", "status"])], "constant string")


@query("""WITH b AS (SELECT c_custkey AS k, CASE WHEN c_acctbal > 0 THEN c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE c_acctbal END AS price, c_custkey % 2 = 0 AS sold FROM customer),
o AS (SELECT o_custkey AS k, min(o_orderpriority) AS name, max(o_totalprice) AS price, bool_or(o_orderstatus = 'P') AS sold FROM orders GROUP BY 1)
SELECT b.k, coalesce(b.name, o.name) AS name, coalesce(nullif(b.price, 0), nullif(o.price, 0), b.price) AS price, coalesce(b.sold, false) OR coalesce(o.sold, false) AS sold, (b.name IS NULL AND o.name IS NOT NULL) OR (coalesce(b.price, 0) = 0 AND coalesce(o.price, 0) <> 0) AS filled FROM b LEFT JOIN o ON o.k = b.k""")
def page_merge(spark, sf):
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 3 == 0, 0.0).otherwise(F.col("c_acctbal")).alias("price"), (F.col("c_custkey") % 2 == 0).alias("sold"))
    other = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderpriority").alias("name"), F.max("o_totalprice").alias("price"), F.bool_or(F.col("o_orderstatus") == "P").alias("sold"))
    return normalize.merge_pages(base, other, "k", ["name", "price"], ["sold"])


@query(f"""SELECT 'ad-' || o_orderkey AS ad_archive_id, 'p' || o_custkey AS page_id, strftime(o_orderdate, '%Y-%m-%d') AS start_date, CASE WHEN o_orderstatus = 'F' THEN strftime(last_day(CAST(o_orderdate AS DATE)), '%Y-%m-%d') END AS end_date,
o_orderstatus <> 'F' AS is_active, CAST(greatest(0, date_diff('day', CAST(o_orderdate AS DATE), CASE WHEN o_orderstatus = 'F' THEN last_day(CAST(o_orderdate AS DATE)) ELSE DATE '{AS_OF}' END)) AS INT) AS days_active, o_orderpriority AS body, 'https://www.facebook.com/ads/library/?id=ad-' || o_orderkey AS snapshot_url FROM orders""")
def normalized_ads(spark, sf):
    """Orders written as scraper items come back as flat ads."""
    o = table(spark, sf, "orders")
    item = F.struct(
        F.concat(F.lit("ad-"), F.col("o_orderkey").cast("string")).alias("adArchiveID"), F.unix_timestamp("o_orderdate").alias("start_date"), F.when(F.col("o_orderstatus") == "F", F.date_format(F.last_day("o_orderdate"), "yyyy-MM-dd")).alias("end_date"),
        F.struct(F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("page_id"), F.struct(F.col("o_orderpriority").alias("text")).alias("body")).alias("snapshot"),
    )
    out = normalize.normalize_ads(o.select(F.parse_json(F.to_json(item)).alias("raw")), AS_OF)
    return out.select("ad_archive_id", "page_id", "start_date", "end_date", "is_active", "days_active", "body", "snapshot_url")


@query("""SELECT p_partkey, coalesce(p_name, '') <> '' AND p_size > 25 OR p_size % 3 = 0 OR p_size % 8 <> 0 AS told FROM part""")
def min_fields(spark, sf):
    s = F.col("p_size")
    told = html.has_min_fields(F.when(s > 25, F.col("p_name")), F.when(s % 3 == 0, F.array(F.lit("x"))), F.lit(0.0), s % 8)
    return table(spark, sf, "part").select("p_partkey", told.alias("told"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'base' END AS merged FROM orders""")
def semantic_merge(spark, sf):
    told = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise("")
    return table(spark, sf, "orders").select("o_orderkey", rel.merged_semantics(F.lit("base"), told).alias("merged"))


@query("""WITH o AS (SELECT l_orderkey, l_linenumber AS n, l_extendedprice AS total, CASE WHEN l_quantity > 10 THEN l_extendedprice / l_quantity END AS unit, l_quantity, l_returnflag = 'R' AS best, l_linestatus AS label FROM lineitem),
r AS (SELECT l_orderkey, coalesce(unit, total) AS price, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN best THEN 0 WHEN l_quantity = 1 THEN 1 WHEN unit IS NOT NULL THEN 2 ELSE 3 END, CASE WHEN NOT best AND l_quantity <> 1 THEN unit END, n, total) AS rn FROM o),
l AS (SELECT l_orderkey, count(*) AS labels FROM o GROUP BY 1) SELECT r.l_orderkey, round(price, 9) AS price, labels FROM r JOIN l ON l.l_orderkey = r.l_orderkey WHERE rn = 1""")
def direct_response(spark, sf):
    l = table(spark, sf, "lineitem")
    offer = F.struct(
        F.col("l_linenumber").alias("n"), F.col("l_extendedprice").alias("total_price"), F.when(F.col("l_quantity") > 10, F.col("l_extendedprice") / F.col("l_quantity")).alias("price_per_unit"),
        F.col("l_quantity").alias("quantity"), (F.col("l_returnflag") == "R").alias("is_best_value"), F.col("l_linestatus").alias("tier_label"),
    )
    rows = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(offer)).alias("offers"))
    got = rel.direct_response({"price": F.lit(None).cast("double"), "variants": F.lit(None).cast("array<string>")}, F.col("offers"), {})
    return rows.select("l_orderkey", F.round(got["price"], 9).alias("price"), F.size(got["variants"]).cast("long").alias("labels"))
