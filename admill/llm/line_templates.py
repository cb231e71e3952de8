"""Line dedup by a log-template tree, in DataFrame functions only.

A line is parsed as in a log-template tree of fixed depth: its token count, then its first
`DEPTH` tokens (tokens with digits count as variable) name a leaf. Only leaves that several
documents reach go on. In such a leaf the lines' tokens are counted by position, each distinct
line weighed by its documents: a token that stands in a position in at least `MIN_DOCS` documents
is constant, any other becomes a variable field. Lines whose template keeps at least `MIN_CONSTANT`
of its tokens share it, and templates that recur across documents are dropped from all of them.

Recurrence counts contexts, not copies: exact copies of a document count once, and a line's
context is a minhash of the leading tokens of its document's other lines, which near copies share. Under a
minhash a template recurs if it has `MIN_DOCS` contexts, and the documents outside of its largest
context are at least `SPREAD` times those inside. It is dropped if it recurs under half of `HASHES`
minhashes (boilerplate lines that go together can share one). An unchanged line of `LONG` words or more is
dropped from `LONG_DOCS` contexts on, under three quarters of the minhashes. So copied documents keep
their text for the near-duplicate step, while boilerplate goes; a line stays whose documents are nearly all
near copies of each other.

Only hashes are grouped; text moves once, in the last join, and not at all while the rows to change
are counted to be few. Leaves to look into are broadcast under the same kind of check.

Cases: extra columns come back whatever their names; null text stays null and counts no line; lines without a word are never dropped; a text
whose lines all go becomes empty; null and repeated doc_ids are fine (rows are told apart by id
and text); an empty table gives an empty result; texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from admill.llm.common import join_checked, materialise, require, shielded, text_key

DEPTH, MIN_DOCS, MIN_CONSTANT, HASHES = 3, 3, 0.6, 4
#: Words of a long line, contexts that it needs unchanged, and how the documents outside of a template's largest context compare with it.
LONG, LONG_DOCS, SPREAD = 50, 2, 0.5


def tidy(line: Column) -> Column:
    """The line with single spaces between its words; other white space has become spaces before."""
    plain = F.trim(line)
    return F.when(F.contains(plain, F.lit("  ")), F.regexp_replace(plain, " +", " ")).otherwise(plain)


def lines_of(text: Column) -> Column:
    """Tidy lines. Texts are rewritten only if they hold white space other than spaces and line ends."""
    t = F.coalesce(text, F.lit(""))
    odd = F.lit(False)
    for c in "\t\r\x0b\x0c":
        odd |= F.contains(t, F.lit(c))
    return F.transform(F.split(F.when(odd, F.translate(t, "\t\r\x0b\x0c", "    ")).otherwise(t), "\n"), tidy)


def lead(line: Column, depth: int = DEPTH) -> Column:
    """Hash of a line's leading tokens, variable ones masked."""
    first = F.transform(F.split(F.substring_index(line, " ", depth), " "), lambda w: F.when(w.rlike("[0-9]"), F.lit("<*>")).otherwise(w))
    return F.xxhash64(F.array_join(first, " "))


def leaf(line: Column, depth: int = DEPTH) -> Column:
    """Hash of the path to a line's leaf: token count and leading tokens."""
    return F.xxhash64(words_in(line), lead(line, depth))


def words_in(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _hashed(i: int):
    return lambda x: F.xxhash64(F.lit(i), x)


def parsed(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """A row per distinct text: t (its hash), lines as structs of lead, size in words and line hash, and for each minhash the two least leads."""
    t, check = text_key(F.col("text"))
    one = docs.select(t.alias("t"), check.alias("check"), F.filter(lines_of(F.col("text")), lambda x: x != "").alias("x"))
    hashed = F.array_distinct(F.transform("x", lambda x: F.struct(lead(x, depth).alias("lead"), words_in(x).alias("size"), F.xxhash64(x).alias("line"))))
    rows = one.select("t", "check", hashed.alias("lines"))
    leads = F.array_distinct(F.transform("lines", lambda x: x["lead"]))
    least = [F.slice(F.array_sort(F.transform(leads, _hashed(i))), 1, 2) for i in range(HASHES)]
    return rows.dropDuplicates(["t", "check"]).withColumn("least", F.array(*least))


def occurrences(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(leaf, size, line, ctx) for each distinct line of each distinct text; ctx has the least other lead by each minhash."""
    flat = parsed(docs, depth).select("least", F.explode("lines").alias("l"))

    def other(i: int) -> Column:
        two = F.get("least", F.lit(i))
        first, second = F.get(two, F.lit(0)), F.get(two, F.lit(1))
        return F.when(first == F.xxhash64(F.lit(i), "l.lead"), F.coalesce(second, F.lit(0))).otherwise(first)

    return flat.select(F.xxhash64("l.size", "l.lead").alias("leaf"), "l.size", "l.line", F.array(*[other(i) for i in range(HASHES)]).alias("ctx"))


def recurring(counts: DataFrame, by: str, min_docs: int, hashes: float) -> DataFrame:
    """Groups of (by, ctx, n) rows that have enough contexts, spread enough, under that many minhashes."""
    each = counts.select(by, "n", F.posexplode("ctx").alias("i", "c")).groupBy(by, "i", "c").agg(F.sum("n").alias("n"))
    groups = each.groupBy(by, "i").agg(F.count("*").alias("contexts"), F.sum("n").alias("docs"), F.max("n").alias("most"))
    fine = (F.col("contexts") >= min_docs) & (F.col("docs") - F.col("most") >= SPREAD * F.col("most"))
    return groups.groupBy(by).agg(F.count_if(fine).alias("fine")).filter(F.col("fine") >= hashes).select(by)


def recurring_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_constant: float = MIN_CONSTANT) -> DataFrame:
    """Hashes (column line) of the distinct lines whose template recurs across documents."""
    seen = materialise(occurrences(require(docs, "text"), depth).groupBy("leaf", "size", "line", "ctx").agg(F.count("*").alias("n")), "lines")
    leaves = materialise(seen.groupBy("leaf").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs).select("leaf"), "leaves")
    likely = materialise(join_checked(seen, leaves, "leaf", "left_semi"), "likely-lines")
    weights = likely.groupBy("leaf", "line").agg(F.sum("n").alias("docs"))

    every = docs.select(F.explode(F.array_distinct(F.filter(lines_of(F.col("text")), lambda x: x != ""))).alias("x")).select(leaf(F.col("x"), depth).alias("leaf"), "x")
    text = join_checked(every, leaves, "leaf", "left_semi").groupBy("leaf", F.xxhash64("x").alias("line")).agg(F.max("x").alias("x"))
    tokens = materialise(weights.join(text, ["leaf", "line"]).select("leaf", "line", "docs", F.posexplode(F.split("x", " ")).alias("place", "token")), "line-tokens")
    tokens = tokens.withColumn("token", F.xxhash64("token"))
    constant = tokens.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("d")).filter(F.col("d") >= min_docs).select("leaf", "place", "token", F.lit(True).alias("constant"))
    marked = tokens.join(constant, ["leaf", "place", "token"], "left")
    field = F.struct("place", F.when(F.col("constant"), F.col("token")).alias("token"))
    shapes = marked.groupBy("leaf", "line").agg(F.array_sort(F.collect_list(field)).alias("fields"), F.count("*").alias("size"), F.count("constant").alias("fixed"))
    shapes = shapes.filter(F.col("fixed") >= min_constant * F.col("size")).select("line", F.xxhash64("leaf", F.to_json("fields")).alias("template"))
    shapes = materialise(shapes, "templates")
    counts = likely.join(shapes, "line").groupBy("template", "ctx").agg(F.sum("n").alias("n"))
    by_template = shapes.join(recurring(counts, "template", min_docs, HASHES / 2), "template", "left_semi").select("line")
    unchanged = recurring(seen.filter(F.col("size") >= LONG), "line", min(LONG_DOCS, min_docs), 3 * HASHES / 4)
    return by_template.union(unchanged).distinct()


def marked_lines(docs: DataFrame, **limits) -> DataFrame:
    """docs with _gone: positions of the lines to drop; null where there are none."""
    gone = materialise(recurring_lines(docs, **limits), "gone-lines")
    t, check = text_key(F.col("text"))
    flat = docs.select(t.alias("_t"), check.alias("_check"), F.posexplode(F.transform(lines_of(F.col("text")), lambda x: F.when(x != "", F.xxhash64(x)))).alias("place", "line"))
    hit = join_checked(flat.filter(F.col("line").isNotNull()), gone, "line", "left_semi")
    # equal texts give equal lists, so a set of places serves every copy
    lists = materialise(hit.groupBy("_t", "_check").agg(F.collect_set("place").alias("_gone")), "gone-places")
    keyed = docs.withColumns({"_t": t, "_check": check})
    return join_checked(keyed, lists, ["_t", "_check"], "left").drop("_t", "_check")


def drop_lines(docs: DataFrame, **limits) -> DataFrame:
    """docs, with their own columns, without the lines whose template recurs; n_chars follows where there is one."""
    rows, restore = shielded(require(docs, "doc_id", "text"), "doc_id", "text", "n_chars")
    marked = marked_lines(rows, **limits)
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i))
    cleaned = marked.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return restore(cleaned)


def line_report(docs: DataFrame, **limits) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) for every row of docs."""
    marked = marked_lines(require(docs, "doc_id", "text").select("doc_id", "text"), **limits)
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i))
    return marked.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")) != ""))).cast("long").alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_dropped"),
        F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
    )
