"""Quality rules with adaptive thresholds.

Every document gets counts of words, marks (ASCII punctuation and symbols), echoes (words equal to the word
before), repeated lines and repeated windows. No rule's cutoff is fixed: a log-binned quantile
sketch (relative error `GAMMA - 1`) is counted per language and source over the documents that pass the
base rules, and the cutoff lies a number of quantile ranges above an upper quantile (`RULES`; a range runs from the
lower edge of one bin to the upper edge of the other, so it is never narrower than the sketch can tell). The
quantiles of bulk measures leave room for a quarter of junk in a group; measures that are mostly
zero use the 99th. Sketches are plain bin counts, so partial sketches merge by addition: a group
with fewer than `MIN_GROUP` documents uses the merged sketch of its language, and failing that of the
corpus. A group whose upper quantile of a measure is zero has no range for it and takes the wider group's cutoff; where that holds
for the corpus too, the quantiles of its other values count. There are no bounds on a cutoff: a group's own distribution decides.

Cases: a null text counts as empty (no words, base_failed); null language or source form
groups of their own; an empty table gives an empty result; repeated rows are judged alike; ties at a
cutoff are kept; a text of any length is read whole. The filter gives back all columns of docs, whatever
their names; the report gives its own columns only.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from operator import eq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.llm.common import join_checked, materialise, require, shielded

GAMMA = 1.005
MIN_GROUP = 50
WINDOW = 5
#: For each rule: numerator and denominator of its measure, lower and upper quantile of the sketch, and how many
#: times their difference the cutoff lies above the upper one.
RULES = {
    "marks": ("n_marks", "n_words", 0.5, 0.75, 12.0),
    "mean_word": ("word_chars", "n_words", 0.5, 0.75, 10.0),
    "echoes": ("n_echoes", "n_words", 0.5, 0.9, 8.0),
    "dup_lines": ("n_dup_lines", "n_lines", 0.5, 0.99, 1.0),
    "repeats": ("n_repeat_words", "n_words", 0.5, 0.99, 1.0),
}
_SCALE = 10_000
_SPACES, _SYMBOLS, _MARKS = " \t\n\r\x0b\x0c", "#*$%&|<>", string.punctuation.encode()
METRICS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_marks long, n_echoes long"


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of `size` words which the text has at least twice."""
    grams = list(zip(*(words[i:] for i in range(size))))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    covered, end = 0, 0
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            covered += i + size - max(i, end)
            end = i + size
    return covered


def text_metrics(text: str | None) -> tuple[int, ...]:
    """Values of METRICS for a whole text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(data) - len(data.translate(None, _MARKS)),
        sum(map(eq, words, words[1:])),
    )


def _metrics(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in METRICS.split(", ")]
    for batch in texts:
        yield pd.DataFrame([text_metrics(x) for x in batch], columns=names, dtype="int64")


def add_metrics(docs: DataFrame, into: str = "_quality") -> DataFrame:
    """docs with a struct column of whole-text counts."""
    return require(docs, "text").withColumn(into, F.pandas_udf(_metrics, METRICS)(F.col("text")))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.floor(top * _SCALE / F.greatest(bottom, F.lit(1))).cast("long")


def _scaled(m: Column) -> dict[str, Column]:
    return {k: _ratio(m[top], m[bottom]) for k, (top, bottom, *_) in RULES.items()}


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def sketch(measured: DataFrame, by: list[str], into: str = "_quality") -> DataFrame:
    """Bin counts (by..., rule, bin, n) of every rule's metric: a mergeable quantile sketch."""
    pairs = [F.struct(F.lit(k).alias("rule"), v.alias("x")) for k, v in _scaled(F.col(into)).items()]
    x = F.col("_r.x")
    log_bin = F.when(x > 0, F.ceil(F.log(x) / math.log(GAMMA))).otherwise(-1).cast("int")
    return (
        measured.select(*by, F.explode(F.array(*pairs)).alias("_r"))
        .groupBy(*by, F.col("_r.rule").alias("rule"), log_bin.alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def merge_sketches(bins: DataFrame, by: list[str]) -> DataFrame:
    return bins.groupBy(*by, "rule", "bin").agg(F.sum("n").alias("n"))


def fences(bins: DataFrame, by: list[str]) -> DataFrame:
    """(by..., rule, n, fence): the rule's cutoff in each group, from its bins.

    Where the high quantile is zero there is no range to go by: a group's fence is null then, and the whole corpus's comes from its other values.
    """
    group = Window.partitionBy(*by, "rule")
    below = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    value = F.when(F.col("bin") < 0, 0.0).otherwise(F.pow(F.lit(GAMMA), F.col("bin"))) / _SCALE
    low, high, times = (F.create_map(*[F.lit(y) for k, v in RULES.items() for y in (k, v[i])])[F.col("rule")] for i in (2, 3, 4))

    def quantile(q: Column, zeros: Column) -> Column:
        return F.min(F.when((F.col("_below") > zeros) & (F.col("_below") - zeros >= F.ceil((F.col("_all") - zeros) * q)), value))

    none, zeros = F.lit(0), F.col("_zeros")
    out = (
        bins.withColumn("_below", below)
        .withColumns({"_all": F.sum("n").over(group), "_zeros": F.coalesce(F.sum(F.when(F.col("bin") < 0, F.col("n"))).over(group), none)})
        .groupBy(*by, "rule")
        .agg(F.first("_all").alias("n"), quantile(low, none).alias("low"), quantile(high, none).alias("high"), quantile(low, zeros).alias("low_1"), quantile(high, zeros).alias("high_1"))
    )
    fence = lambda a, b: b + times * (b - a / GAMMA)
    alone = F.lit(None).cast("double") if by else fence(F.col("low_1"), F.col("high_1"))
    return out.select(*by, "rule", "n", F.when(F.col("high") > 0, fence(F.col("low"), F.col("high"))).otherwise(alone).alias("fence"))


def fit_thresholds(measured: DataFrame, into: str = "_quality") -> DataFrame:
    """One row per (lang, source) with a fence per rule, from the smallest group that is large enough."""
    by = ["lang", "source"]
    bins = sketch(measured.filter(~base_failed(F.col(into))), by, into)
    wide = [F.max(F.when(F.col("rule") == k, F.col("fence"))).alias(f"max_{k}") for k in RULES]

    def level(keys: list[str]) -> DataFrame:
        return fences(bins if keys == by else merge_sketches(bins, keys), keys).groupBy(*keys).agg(F.max("n").alias("n"), *wide)

    own, lang, every = level(by), level(["lang"]), level([])
    names = [f"max_{k}" for k in RULES]
    lang = lang.select(F.col("lang").alias("_lang"), F.col("n").alias("_lang_n"), *[F.col(c).alias(f"_lang_{c}") for c in names])
    every = every.select(*[F.col(c).alias(f"_every_{c}") for c in names])  # one row
    joined = join_checked(own, lang, own["lang"].eqNullSafe(F.col("_lang")), "left").join(F.broadcast(every), F.lit(True), "left")
    pick = lambda c: F.coalesce(F.when(F.col("n") >= MIN_GROUP, F.col(c)), F.when(F.col("_lang_n") >= MIN_GROUP, F.col(f"_lang_{c}")), F.col(f"_every_{c}"))
    return joined.select(*by, *[pick(c).alias(c) for c in names])


def judge(measured: DataFrame, thresholds: DataFrame, into: str = "_quality") -> DataFrame:
    """measured with base_failed and kept. Thresholds join by language and source, nulls included."""
    t = thresholds.select(F.col("lang").alias("_t_lang"), F.col("source").alias("_t_source"), *[F.col(f"max_{k}").alias(f"_max_{k}") for k in RULES])
    on = F.col("lang").eqNullSafe(F.col("_t_lang")) & F.col("source").eqNullSafe(F.col("_t_source"))
    out = join_checked(measured, materialise(t, "thresholds"), on, "left")
    m = F.col(into)
    fine = F.lit(True)
    for name, value in _scaled(m).items():
        fine &= F.coalesce(value / _SCALE <= F.col(f"_max_{name}"), F.lit(True))
    return out.withColumn("base_failed", base_failed(m)).withColumn("kept", ~F.col("base_failed") & fine).drop("_t_lang", "_t_source", *[f"_max_{k}" for k in RULES])


def quality_report(docs: DataFrame) -> DataFrame:
    """Counts and verdict for each row of docs (doc_id, text, lang, source)."""
    measured = materialise(add_metrics(require(docs, "doc_id", "text", "lang", "source")).select("doc_id", "lang", "source", "_quality"), "quality")
    return judge(measured, fit_thresholds(measured)).select("doc_id", "lang", "source", "_quality.*", "base_failed", "kept")


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with their own columns."""
    rows, restore = shielded(require(docs, "text", "lang", "source"), "text", "lang", "source")
    measured = materialise(add_metrics(rows), "quality")
    return restore(judge(measured, fit_thresholds(measured)).filter("kept"))


def _fence_sql(name: str, keys: list[str]) -> str:
    """Common table expressions that give a fence per rule for groups of the keys."""
    by = "".join(f"{k}, " for k in keys)
    low, high, times = (" ".join(f"WHEN '{k}' THEN {v[i]}" for k, v in RULES.items()) for i in (2, 3, 4))
    wide = ", ".join(f"max(CASE WHEN rule = '{k}' THEN fence END) AS max_{k}" for k in RULES)
    return f"""{name}_b AS (SELECT {by}rule, bin, sum(n) AS n FROM bins GROUP BY ALL),
{name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {by}rule ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS below, sum(n) OVER (PARTITION BY {by}rule) AS total,
  coalesce(sum(n) FILTER (bin < 0) OVER (PARTITION BY {by}rule), 0) AS zeros,
  CASE WHEN bin < 0 THEN 0.0 ELSE pow(CAST({GAMMA} AS DOUBLE), bin) END / {_SCALE} AS v FROM {name}_b),
{name}_q AS (SELECT {by}rule, max(total) AS n, min(CASE WHEN below >= ceil(total * CASE rule {low} END) THEN v END) AS low, min(CASE WHEN below >= ceil(total * CASE rule {high} END) THEN v END) AS high,
  min(CASE WHEN below > zeros AND below - zeros >= ceil((total - zeros) * CASE rule {low} END) THEN v END) AS low_1, min(CASE WHEN below > zeros AND below - zeros >= ceil((total - zeros) * CASE rule {high} END) THEN v END) AS high_1
  FROM {name}_c GROUP BY ALL),
{name}_f AS (SELECT {by}rule, n, CASE WHEN high > 0 THEN high + CASE rule {times} END * (high - low / {GAMMA}) {"" if keys else f"ELSE high_1 + CASE rule {times} END * (high_1 - low_1 / {GAMMA})"} END AS fence FROM {name}_q),
{name} AS (SELECT {by}max(n) AS n, {wide} FROM {name}_f GROUP BY {", ".join(keys) or "()"})"""


def report_sql() -> str:
    """The report in SQL: the same counts, sketches and fences."""
    x = {k: f"CAST(floor({a} * {_SCALE} / greatest({b}, 1)) AS BIGINT)" for k, (a, b, *_) in RULES.items()}
    pick = "coalesce(CASE WHEN own.n >= {m} THEN own.max_{k} END, CASE WHEN lang.n >= {m} THEN lang.max_{k} END, every_doc.max_{k})"
    fine = " AND ".join(f"coalesce({x[k]} / {_SCALE} <= {pick.format(m=MIN_GROUP, k=k)}, true)" for k in RULES)
    rules = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS rule, {v} AS x FROM m WHERE NOT base_failed" for k, v in x.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS k FROM (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], chr(1)) AS gram FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w))),
p AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS j FROM g WHERE k > 1) GROUP BY r),
c AS (SELECT w.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  length(t) - length(regexp_replace(t, '[!-/:-@\\[-`{{-~]', '', 'g')) AS n_marks, len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_echoes,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN p ON p.r = w.r),
m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
bins AS (SELECT lang, source, rule, CASE WHEN x > 0 THEN CAST(ceil(ln(x) / {math.log(GAMMA)!r}) AS INT) ELSE -1 END AS bin, count(*) AS n FROM ({rules}) GROUP BY ALL),
{_fence_sql("own", ["lang", "source"])},
{_fence_sql("lang", ["lang"])},
{_fence_sql("every_doc", [])}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {fine} AS kept
FROM m LEFT JOIN own ON own.lang IS NOT DISTINCT FROM m.lang AND own.source IS NOT DISTINCT FROM m.source LEFT JOIN lang ON lang.lang IS NOT DISTINCT FROM m.lang LEFT JOIN every_doc ON true
"""
