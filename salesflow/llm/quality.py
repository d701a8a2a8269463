"""Quality of texts by a sparse rule ensemble over statistics.

Shallow trees are grown on text statistics; every path from a root to a node is a rule, a
conjunction of thresholds. A logistic regression with an L1 penalty keeps few rules, and those
become one Spark column expression, so that scoring is a plain projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.labelled import SAMPLE_ROWS, labelled_sample
from salesflow.llm.tables import hash_bucket
from salesflow.sources.workspace import saved

THRESHOLD = 0.7
TREES = 24
DEPTH = 4
PENALTY = 0.0002
SEED = 7
# Without labels a text counts as good: three good ones and a bad one are assumed beforehand.
PRIOR_GOOD, PRIOR_BAD = 3.0, 1.0


def with_statistics(rows: DataFrame) -> DataFrame:
    """`rows` with its column `text` replaced by numbers about the whole text, in a struct.

    A NULL text counts as empty; the empty text has zeros.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    others = [c for c in rows.columns if c != "text"]
    parts = rows.select(
        *others,
        text.alias("text"),
        F.filter(F.split(text, r"\s+"), lambda w: w != "").alias("words"),
        F.split(text, "\n").alias("lines"),
    )
    counted = parts.select(
        *others,
        F.length("text").alias("chars"),
        F.size("words").alias("n_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size(
            F.filter(
                F.zip_with("words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), lambda a, b: a == b),
                lambda same: same,
            )
        ).alias("n_same"),
        F.size(F.filter("words", lambda w: F.length(w) <= 3)).alias("n_short"),
        F.array_max(F.transform("words", F.length)).alias("longest"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("lines")).alias("n_distinct_lines"),
        F.length(F.regexp_replace("text", r"\P{Lu}+", "")).alias("n_upper"),
        F.length(F.regexp_replace("text", r"[\p{L}\p{N}\s.,]+", "")).alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^0-9]+", "")).alias("n_digits"),
        F.length(F.regexp_replace("text", r"[^.,]+", "")).alias("n_stops"),
    )
    chars = F.greatest("chars", F.lit(1))
    words = F.greatest("n_words", F.lit(1))
    numbers = {
        "log_words": F.log1p("n_words"),
        "chars_per_word": chars / words,
        "distinct_words": F.col("n_distinct") / words,
        "distinct_growth": F.log1p("n_distinct") / F.greatest(F.log1p("n_words"), F.lit(0.5)),
        "same_as_before": F.col("n_same") / words,
        "short_words": F.col("n_short") / words,
        "longest_word": F.coalesce("longest", F.lit(0)).cast("double"),
        "words_per_line": words / F.col("n_lines"),
        "distinct_lines": F.col("n_distinct_lines") / F.col("n_lines"),
        "upper_case": F.col("n_upper") / chars,
        "symbols": F.col("n_symbols") / chars,
        "digits": F.col("n_digits") / chars,
        "stops_per_word": F.col("n_stops") / words,
    }
    return counted.select(
        *others, F.struct(*(c.alias(n) for n, c in numbers.items())).alias("statistics")
    )


@dataclass(frozen=True)
class Rule:
    """Thresholds (statistic, is_at_most, value) that must all hold, and the rule's weight."""

    conditions: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        def holds(name: str, at_most: bool, value: float) -> Column:
            number = F.col(f"statistics.{name}")
            return number <= value if at_most else number > value

        return reduce(lambda a, b: a & b, (holds(*c) for c in self.conditions)).cast("double")


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self) -> Column:
        """The probability of good quality, from a column `statistics`."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + rule.column() * rule.weight
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _paths(node, names: list[str], above: tuple = ()) -> list[tuple]:
    """The conditions from the root to each node of a tree."""
    found = [above] if above else []
    if node.numDescendants() == 0:
        return found
    name, value = names[node.split().featureIndex()], node.split().threshold()
    return (
        found
        + _paths(node.leftChild(), names, (*above, (name, True, value)))
        + _paths(node.rightChild(), names, (*above, (name, False, value)))
    )


def _tightest(path: tuple) -> tuple:
    """One threshold for each statistic and side, in a fixed order."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, at_most, value in path:
        choose = min if at_most else max
        bounds[name, at_most] = choose(value, bounds.get((name, at_most), value))
    return tuple(sorted((name, at_most, value) for (name, at_most), value in bounds.items()))


def _stored_in_order(rows: DataFrame, label: str) -> DataFrame:
    """The rows of one partition as a written table, read as one partition in the same order.

    A training runs a hundred jobs and more, and the driver serializes all the plan behind its rows for
    each of them. Behind stored rows there is a scan only, not hundreds of rules.
    """
    return saved(rows, label).coalesce(1)


def fit(sample: DataFrame) -> RuleEnsemble:
    """Rules from (doc_id, text, label); only the base rate if there is one class or none."""
    described = saved(with_statistics(sample), "statistics")
    counts = described.agg(F.sum("label"), F.count(F.lit(1))).first()
    good, total = counts[0] or 0, counts[1]
    if good in (0, total):
        odds = (good + PRIOR_GOOD) / (total - good + PRIOR_BAD)
        return RuleEnsemble(float(math.log(odds)), ())
    # A bounded number of rows: one ordered partition makes the fit repeatable.
    rows = _stored_in_order(described.orderBy("doc_id", "label").coalesce(1), "ordered")
    names = rows.select("statistics.*").columns
    flat = rows.select("label", *(F.col(f"statistics.{n}").alias(n) for n in names))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(flat)
    forest = RandomForestClassifier(
        labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="0.5"
    ).fit(vectors.select("label", "features"))
    paths = {
        _tightest(path)
        for tree in forest.trees
        for path in _paths(tree._java_obj.rootNode(), names)
    }
    rules = [Rule(p) for p in sorted(paths)]
    fired = rows.select("label", *(r.column().alias(f"rule_{i}") for i, r in enumerate(rules)))
    inputs = [f"rule_{i}" for i in range(len(rules))]
    lasso = LogisticRegression(
        labelCol="label", elasticNetParam=1.0, regParam=PENALTY, maxIter=100, standardization=False
    )
    marked = VectorAssembler(inputCols=inputs, outputCol="features").transform(fired)
    model = lasso.fit(_stored_in_order(marked.select("label", "features"), "fired"))
    weights = model.coefficients.toArray()
    kept = (Rule(r.conditions, float(w)) for r, w in zip(rules, weights, strict=True) if w)
    return RuleEnsemble(float(model.intercept), tuple(kept))


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    """Rules from the labelled documents that are not held out."""
    usable = hash_bucket(F.col("doc_id"), 4) != 2
    return fit(labelled_sample(docs, labels, "quality", usable, rows))


def scored(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of documents.

    Nothing but the text enters the score; NULL and empty texts have the score of zero statistics.
    A NULL doc_id counts as not held out. Repeated rows are scored alike, each on its own.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    score = with_statistics(rows).select("doc_id", model.score().alias("score"))
    return score.select(
        "doc_id",
        F.coalesce(hash_bucket(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_only(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """The rows whose text scores at least the threshold, with all their columns."""
    rows = docs.select(F.struct("*").alias("row"), docs["text"].alias("text"))
    return with_statistics(rows).filter(model.score() >= THRESHOLD).select("row.*")
