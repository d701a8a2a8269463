"""Toxicity of texts by a counterfactually regularised word classifier.

A sparse logistic model over the words of a text and their beginnings. For every labelled text that mentions a group,
its counterfactual names another group instead, and the model is penalised for scoring the two
differently, so that a mention alone does not make a text toxic.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.labelled import SAMPLE_ROWS, labelled_sample
from salesflow.llm.tables import hash_bucket, id_and_text
from salesflow.sources.workspace import saved

THRESHOLD = 0.5
# Words and beginnings that the model can weigh: the most telling ones of those in enough texts.
VOCABULARY = 4_000
LEAST_TEXTS = 4
PREFIXES = (3, 4, 5, 6)
PENALTY = 1.0  # of the L1 norm, in labelled texts
SWAP_PENALTY = 1.0  # of a squared score change, for each counterfactual text
STEPS = 400
CACHED_WORDS = 100_000
_TEXTS = 128
# Without labels a text counts as not toxic: so many clean and toxic texts are assumed beforehand.
PRIOR_CLEAN, PRIOR_TOXIC = 3.0, 1.0

# Words for groups of people (fixed values); a swap takes the next of the same line.
IDENTITY_TERMS = (
    "women men girls boys mothers fathers",
    "woman man girl boy mother father",
    "female male transgender nonbinary",
    "gay lesbian straight bisexual queer",
    "muslim christian jewish hindu buddhist atheist catholic",
    "muslims christians jews hindus buddhists atheists catholics",
    "black white asian latino hispanic african european arab",
    "immigrants refugees foreigners natives citizens",
    "american chinese indian mexican german french spanish russian turkish",
    "old young elderly teenage",
    "disabled deaf blind autistic",
)
_NEXT = {
    term: words[(i + 1) % len(words)]
    for words in (line.split() for line in IDENTITY_TERMS)
    for i, term in enumerate(words)
}
_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_WORDS.findall(text.lower()))


def forms_of(word: str) -> list[str]:
    """The word, and its beginnings with a mark, as inflected words share them."""
    return [word, *(f"{word[:n]}-" for n in PREFIXES if n < len(word))]


def features_of(words: set[str]) -> set[str]:
    return {form for word in words for form in forms_of(word)}


def swapped(words: set[str]) -> set[str]:
    """The words of the counterfactual text, in which every group is another one."""
    return {_NEXT.get(word, word) for word in words}


@dataclass(frozen=True)
class WordModel:
    intercept: float
    weights: dict[str, float]

    def score(self, text: str) -> float:
        """The probability of being toxic; without known words that of the intercept."""
        return self._chance(features_of(words_of(text)))

    def _chance(self, features) -> float:
        found = sorted(self.weights.keys() & features)
        total = self.intercept + sum(self.weights[w] for w in found)
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, total))))

    def scores(self, texts, known: dict[str, tuple[str, ...]] | None = None) -> list[float]:
        """The scores of many texts; `known` keeps the forms of words met before."""
        known = {} if known is None else known
        result = []
        for text in texts:
            found: set[str] = set()
            for word in words_of(text):
                forms = known.get(word)
                if forms is None:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    forms = known[word] = tuple(f for f in forms_of(word) if f in self.weights)
                found.update(forms)
            result.append(self._chance(found))
        return result


class _Sparse:
    """Rows of a matrix as (row, column, value) lists."""

    def __init__(self, rows: list[dict[int, float]], width: int):
        self._row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self._column = np.array([c for r in rows for c in r], np.int64)
        self._value = np.array([v for r in rows for v in r.values()], np.float64)
        self.shape = (len(rows), width)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self._row, weights[self._column] * self._value, self.shape[0])

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self._column, values[self._row] * self._value, self.shape[1])

    def norm(self) -> float:
        """The largest eigenvalue of the matrix times its transpose, by power iteration."""
        if not len(self._row):
            return 0.0
        vector = np.ones(self.shape[1])
        size = 0.0
        for _ in range(30):
            vector = self.transposed_times(self.times(vector))
            size = float(np.linalg.norm(vector))
            vector /= size
        return size


def _weights(texts: _Sparse, swaps: _Sparse, labels: np.ndarray) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient steps; the intercept is not penalised."""
    width = texts.shape[1]
    weights, ahead, pace = np.zeros(width), np.zeros(width), 1.0
    rate = max(1e-3, min(1 - 1e-3, labels.mean()))
    bias = ahead_bias = math.log(rate / (1 - rate))
    step = 1.0 / (0.25 * (texts.norm() + len(labels)) + 2 * SWAP_PENALTY * swaps.norm())
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-np.clip(texts.times(ahead) + ahead_bias, -30, 30)))
        slope = texts.transposed_times(chance - labels)
        slope += 2 * SWAP_PENALTY * swaps.transposed_times(swaps.times(ahead))
        moved = ahead - step * slope
        moved = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
        moved_bias = ahead_bias - step * float((chance - labels).sum())
        next_pace = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        momentum = (pace - 1) / next_pace
        ahead = moved + momentum * (moved - weights)
        ahead_bias = moved_bias + momentum * (moved_bias - bias)
        weights, bias, pace = moved, moved_bias, next_pace
    return bias, weights


def _with_features(batches):
    """The label and the features of each text and of its counterfactual, a few texts at a time."""
    strings = pa.list_(pa.string())
    for batch in batches:
        for start in range(0, batch.num_rows, _TEXTS):
            part = batch.slice(start, _TEXTS)
            words = [words_of(t) for t in part.column(1).to_pylist()]
            own = [sorted(features_of(w)) for w in words]
            other = [[] if w.isdisjoint(_NEXT) else sorted(features_of(swapped(w))) for w in words]
            arrays = [part.column(0), pa.array(own, strings), pa.array(other, strings)]
            yield pa.RecordBatch.from_arrays(arrays, ["label", "own", "other"])


def fit(sample: DataFrame, vocabulary: int = VOCABULARY) -> WordModel:
    """A model from (doc_id, text, label); only the base rate if there is one class or none.

    Equal texts count once. Words are counted on Spark; the driver gets the chosen words, and of
    each sampled text and its counterfactual the numbers of those in it.
    """

    rows = saved(
        sample.groupBy("text")
        .agg(F.max("label").alias("label"))
        .select("label", "text")
        .mapInArrow(_with_features, "label int, own array<string>, other array<string>"),
        "words",
    )
    toxic, total = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
    toxic = toxic or 0
    if toxic in (0, total):
        odds = (toxic + PRIOR_TOXIC) / (total - toxic + PRIOR_CLEAN)
        return WordModel(math.log(odds), {})
    counted = (
        rows.select("label", F.explode("own").alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum("label").alias("toxic"))
    )
    # How far the toxic share among a word's texts is from the overall one, in deviations.
    share = toxic / total
    telling = F.abs(F.col("toxic") - F.col("texts") * share) / F.sqrt(F.col("texts"))
    chosen = counted.filter(
        (F.col("texts") >= LEAST_TEXTS) | F.col("word").isin(*_NEXT)
    ).orderBy(F.col("word").isin(*_NEXT).desc(), telling.desc(), "word")
    vocabulary_words = [r["word"] for r in chosen.limit(vocabulary).select("word").collect()]
    number = {w: i for i, w in enumerate(vocabulary_words)}
    known = F.broadcast(
        sample.sparkSession.createDataFrame(sorted(number.items()), "word string, number int")
    )
    def marked(column: str, side: int) -> Column:
        return F.transform(column, lambda w: F.struct(w.alias("word"), F.lit(side).alias("side")))

    sides = (
        rows.withColumn("row", F.monotonically_increasing_id())
        .select("row", "label", F.explode_outer(F.concat(marked("own", 0), marked("other", 1))).alias("f"))
        .select("row", "label", "f.word", "f.side")
    )

    def numbers(side: int) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("side") == side, F.col("number"))))

    numbered = (
        sides.join(known, "word", "left")
        .groupBy("row", "label")
        .agg(numbers(0).alias("own"), numbers(1).alias("other"), F.max("side").alias("has_other"))
    )
    found = sorted(numbered.collect(), key=lambda r: (r["label"], r["own"], r["other"], r["row"]))
    texts = [dict.fromkeys(r["own"], 1.0) for r in found]
    swaps = []
    for r in found:
        if r["has_other"]:
            gone, new = set(r["own"]) - set(r["other"]), set(r["other"]) - set(r["own"])
            swaps.append(dict.fromkeys(gone, -1.0) | dict.fromkeys(new, 1.0))
    labels = np.array([r["label"] for r in found], np.float64)
    width = len(vocabulary_words)
    bias, weights = _weights(_Sparse(texts, width), _Sparse(swaps, width), labels)
    kept = {w: float(x) for w, x in zip(vocabulary_words, weights, strict=True) if x}
    return WordModel(bias, kept)


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> WordModel:
    """A model from the labelled documents that are not held out."""
    usable = hash_bucket(F.col("doc_id"), 5) != 0
    return fit(labelled_sample(docs, labels, "toxic", usable, rows))


def scored(docs: DataFrame, model: WordModel) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of documents.

    Nothing but the text enters the score; NULL counts as empty. A NULL doc_id counts as not held
    out. Repeated rows are scored alike, each on its own.
    """

    def rows(batches):
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            found = [
                score
                for start in range(0, batch.num_rows, _TEXTS)
                for score in model.scores(batch.column(1).slice(start, _TEXTS).to_pylist(), known)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    return id_and_text(docs).mapInArrow(rows, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(hash_bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
