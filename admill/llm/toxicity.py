"""Toxicity by a classifier chain of logistic regressions.

Categories are predicted one after the other. A document's features are the presence of the words
that the labels associate with any category, and a few shares over the whole text; each later model
also gets the earlier categories' probabilities. In training, those come from out-of-fold
predictions, so a later model never learns from a probability that saw the row's own label; a text's hash
decides its fold, so copies of a text stay together.

The models are fitted on at most `MAX_ROWS` labelled rows (those whose ids hash lowest, each with one text); every
document is scored. Words, counts and models are handled by Spark; scoring stays in the JVM.

Cases: null text counts as empty; rows without labels are only scored; several label rows of a
document each count; a category without both classes in the sample gets its base rate; repeated
rows and ties get equal scores; of several texts under a labelled id the one whose hash is least is learned from; extra columns are
left out whatever their names; empty tables give an empty result; texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from admill.llm.common import materialise, require

#: Bound of the labelled sample, folds, words kept, and the least chi-square of a kept word.
MAX_ROWS, FOLDS, MAX_WORDS, MIN_CHI2 = 20_000, 3, 512, 15.0
REGULAR, THRESHOLD = 0.001, 0.5
_SHARES = ["_upper", "_symbols", "_long"]


def words_of(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " "))


def prepared(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    removed = lambda p: F.length(text) - F.length(F.regexp_replace(text, p, ""))
    return docs.withColumns({"_words": words_of(F.col("text")), "_upper": removed("[A-Z]+") / size, "_symbols": removed("[#*$%&|<>]+") / size, "_long": F.log1p(size) / 10})


@dataclass
class Chain:
    """Fitted models in order; a float stands for a category that had one class only."""

    words: CountVectorizerModel
    steps: list[tuple[str, Model | float]] = field(default_factory=list)

    def features(self, docs: DataFrame) -> DataFrame:
        return self.words.transform(prepared(docs))

    def apply(self, rows: DataFrame) -> DataFrame:
        """rows (with features) with p_<category> for each step."""
        for i, (name, model) in enumerate(self.steps):
            rows = predict(rows, model, f"p_{name}", [f"p_{k}" for k, _ in self.steps[:i]])
        return rows

    def score(self, docs: DataFrame) -> DataFrame:
        return self.apply(self.features(docs)).drop("_words", "_counts", *_SHARES)


def assembled(rows: DataFrame, earlier: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=["_counts", *_SHARES, *earlier], outputCol="_features").transform(rows)


def predict(rows: DataFrame, model: Model | float, into: str, earlier: list[str]) -> DataFrame:
    if isinstance(model, float):
        return rows.withColumn(into, F.lit(model))
    out = model.setFeaturesCol("_features").setProbabilityCol("_p").setRawPredictionCol("_raw").setPredictionCol("_guess").transform(assembled(rows, earlier))
    return out.withColumn(into, F.get(vector_to_array("_p"), F.lit(1))).drop("_features", "_p", "_raw", "_guess")


def fit_step(rows: DataFrame, label: str, earlier: list[str]) -> Model | float:
    known = rows.filter(F.col(label).isNotNull())
    n, positive = known.agg(F.count("*"), F.sum(label)).first()
    if not n or positive in (0, n):
        return float(positive or 0) / max(1, n)
    return LogisticRegression(featuresCol="_features", labelCol=label, regParam=REGULAR, maxIter=50).fit(assembled(known, earlier))


def telling_words(rows: DataFrame, categories: list[str], most: int = MAX_WORDS, least: float = MIN_CHI2) -> list[str]:
    """The words most associated with any category, by chi-square over the sample."""
    totals = rows.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    n = totals["n"] or 1
    each = rows.select(F.explode("_words").alias("word"), *categories).groupBy("word").agg(F.count("*").alias("df"), *[F.sum(c).alias(c) for c in categories])

    def chi2(c: str) -> Column:
        expected = F.col("df") * F.lit(float(totals[c] or 0) / n)
        return F.when((expected > 0) & (F.col(c) > expected), F.pow(F.col(c) - expected, 2) / expected).otherwise(0.0)

    scores = each.filter((F.col("df") >= 3) & (F.col("word") != "")).withColumn("score", F.greatest(*[chi2(c) for c in categories], F.lit(0.0)))
    best = scores.filter(F.col("score") >= least).orderBy(F.desc("score"), "word").limit(most)
    return [r["word"] for r in best.select("word").collect()]  # at most `most` words


def fit_chain(rows: DataFrame, categories: list[str], folds: int = FOLDS) -> Chain:
    """rows: text, and a 0/1 (or null) column for each category."""
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.coalesce("text", F.lit(""))), F.lit(folds)).alias("_fold")
    sample = materialise(prepared(rows).select(fold, "_words", *_SHARES, *[F.col(c).cast("double").alias(c) for c in categories]), "labelled")
    words = telling_words(sample, categories) or [""]
    vocabulary = CountVectorizerModel.from_vocabulary(words, inputCol="_words", outputCol="_counts").setBinary(True)
    chain = Chain(vocabulary)
    held = materialise(vocabulary.transform(sample).drop("_words"), "chain")
    for i, category in enumerate(categories):
        earlier = [f"p_{k}" for k in categories[:i]]
        chain.steps.append((category, fit_step(held, category, earlier)))
        if i + 1 < len(categories):
            parts = [predict(held.filter(F.col("_fold") == f), fit_step(held.filter(F.col("_fold") != f), category, earlier), f"p_{category}", earlier) for f in range(folds)]
            together = parts[0]
            for part in parts[1:]:
                together = together.unionByName(part)
            held = materialise(together, "chain")
    return chain


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_ROWS) -> DataFrame:
    """At most `most` labelled rows with a text each: those whose ids hash lowest."""
    chosen = labels.filter(F.col("doc_id").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    numbered = materialise(chosen.withColumn("_label", F.monotonically_increasing_id()), "labels")
    met = docs.select("doc_id", "text").join(F.broadcast(numbered), "doc_id")  # `most` rows of numbers
    return met.groupBy("_label", *labels.columns).agg(F.min_by("text", F.xxhash64("text")).alias("text")).drop("_label")


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, p_low_quality, p_toxic, toxic) for every row of docs."""
    require(docs, "doc_id", "text")
    named = require(labels, "doc_id", "quality", "toxic").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = fit_chain(labelled_sample(docs, named, most), ["low_quality", "toxic"])
    scored = chain.score(docs.select("doc_id", "text"))
    return scored.select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= threshold).alias("toxic"))
