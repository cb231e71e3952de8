"""Secret scans in DataFrame functions only: fixed patterns, and character Markov models.

Patterns find assignments, access keys and hex digits. Two bigram models over characters, one of
random strings and one of ordinary identifiers, find the rest: a run of token characters is a
secret if the log-likelihood ratio of the two models, averaged over its transitions, exceeds
`MARGIN`. Both are trained from samples that rules label: values that the patterns match are random
strings (mixed half and half with the uniform model), other runs of letters, few of them capital,
are ordinary; the rest has no label. Pairs back off to single characters. Counts cover every document; only the table of ratios, at most one number for each pair of characters, reaches the
driver, which sends it back as a constant.

Texts are scanned once: the spans, with the tokens that the models learn from and judge, are written and reread, and the
texts aren't. A run has at least `RUN_LEAST` characters and no dots, so a token with dots is judged in parts, and a
shorter secret is found by its pattern only.

A text's match positions come from splitting it at the pattern: gaps and matches alternate, so
running sums of their lengths are the spans, in code points, without a loop over the text.

Cases: null text is empty; no match gives zero counts and the digest of an empty string; adjacent
matches stay apart; ties of two kinds at one start stand in the kinds' order; repeated rows get equal results; of the columns of docs
only those named in `keep` go on, so others may have any name, and a kept column named as a result is an error; an empty table trains a model that flags
nothing; texts are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from admill.llm.common import materialise, require

#: The patterns of the three base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN_LEAST = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{RUN_LEAST},}}"
#: Natural-log units that the average transition must favour the random model by.
MARGIN = 0.5
#: Pseudo-count of the single-character model behind each character's row.
BACKOFF = 5.0
_SPAN = "array<struct<start: int, stop: int, kind: int>>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def spans(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Array of (start, stop, kind) of the pattern's matches; keep is an array of booleans for the matches."""
    sizes = F.transform(matches(text, pattern), F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.zip_with(gaps, sizes, lambda g, m: F.struct(g.alias("gap"), m.alias("size")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + pair["gap"]
        stop = begin + F.coalesce(pair["size"], F.lit(0))
        span = F.struct(begin.alias("start"), stop.alias("stop"), F.lit(kind).alias("kind"))
        return F.struct(stop.alias("at"), F.when(pair["size"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], F.array(span))).alias("found"))

    found = F.aggregate(pairs, start, step, lambda acc: acc["found"])
    if keep is not None:
        found = F.transform(F.filter(F.zip_with(found, keep, lambda s, k: F.struct(s.alias("s"), k.alias("k"))), lambda x: x["k"]), lambda x: x["s"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    long_enough = F.transform(matches(text, ASSIGN, 2), lambda v: F.length(v) >= 6)
    return F.concat(spans(text, ASSIGN, 0, long_enough), spans(text, ACCESS, 1), spans(text, HEX, 2))


def _free(span: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: (o["start"] < span["stop"]) & (o["stop"] > span["start"]))


def _cut(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["stop"] - span["start"])


def scanned(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of docs with base (spans of the patterns), values (the last token of each) and runs (other runs of token characters: span and token)."""
    if clash := {"base", "values", "runs", "spans"} & set(keep):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    rows = require(docs, "text", *keep).select(*keep, F.coalesce("text", F.lit("")).alias("_text")).withColumn("base", base_spans(F.col("_text")))
    values = F.transform("base", lambda s: F.element_at(F.split(_cut(F.col("_text"), s), "[^A-Za-z0-9+/_-]+"), -1))
    free = F.filter(spans(F.col("_text"), RUN, 3), lambda s: _free(s, F.col("base")))
    runs = F.transform(free, lambda s: F.struct(s.alias("span"), _cut(F.col("_text"), s).alias("token")))
    return rows.select(*keep, "base", values.alias("values"), runs.alias("runs"))


def _transitions(token: Column) -> Column:
    """Array of numbers, one for each pair of neighbouring characters that are both in the alphabet."""
    at = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.zip_with(at, F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0))), lambda a, b: F.when((a > 0) & (b > 0), (a - 1) * len(ALPHABET) + b - 1))
    return F.filter(pairs, lambda p: p.isNotNull())


def train(found: DataFrame) -> list[int]:
    """Thousandths of the log ratio for each pair of characters, from the scanned documents."""
    letters = lambda t: t.rlike("^[A-Za-z_-]+$") & (4 * F.regexp_count(t, F.lit("[A-Z]")) <= F.length(t))
    ordinary = F.filter(F.transform("runs", lambda r: r["token"]), letters)
    labelled = F.concat(F.transform("values", lambda t: F.struct(F.lit(1).alias("random"), t.alias("token"))), F.transform(ordinary, lambda t: F.struct(F.lit(0).alias("random"), t.alias("token"))))
    tokens = found.select(F.explode(labelled).alias("x"))
    pairs = tokens.select("x.random", F.explode(_transitions(F.col("x.token"))).alias("pair"))
    size = len(ALPHABET)
    counts = [[0] * size * size, [0] * size * size]
    for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect():  # at most 2 * 67 * 67 rows
        counts[r["random"]][r["pair"]] = r["n"]
    return log_ratios(counts[1], counts[0])


def transition_model(counts: list[int]) -> list[float]:
    """Probabilities of a character after another, from counts by pair."""
    size = len(ALPHABET)
    single = [(sum(counts[b::size]) + 1) / (sum(counts) + size) for b in range(size)]
    seen = [sum(counts[a * size : (a + 1) * size]) for a in range(size)]
    return [(counts[a * size + b] + BACKOFF * single[b]) / (seen[a] + BACKOFF) for a in range(size) for b in range(size)]


def log_ratios(random: list[int], ordinary: list[int]) -> list[int]:
    uniform = 1 / len(ALPHABET)
    return [round(1000 * math.log((uniform + p) / 2 / q)) for p, q in zip(transition_model(random), transition_model(ordinary))]


def secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of docs with spans: array of (start, kind number, stop) in order, base and method spans together."""
    found = materialise(scanned(docs, keep), "secrets")
    ratios = train(found)
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    score = lambda t: F.aggregate(_transitions(t), F.lit(0).cast("long"), lambda acc, p: acc + F.get(table, p))
    random = lambda r: score(r["token"]) > F.lit(int(1000 * MARGIN)) * F.size(_transitions(r["token"]))
    told = F.transform(F.filter("runs", random), lambda r: r["span"])
    return found.select(*keep, F.array_sort(_by_start(F.concat("base", told))).alias("spans"))


def _by_start(found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))


def _spelt(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """A row per document: counts of the base kinds, the digest of base spans, and all spans."""
    found = secrets(require(docs, "doc_id"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_spelt(base), 256).alias("base_sha256"),
        _spelt(F.col("spans")).alias("spans"),
    )
