"""Language of texts by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A sequence of letters is the product of their
vectors, each rotated by its place; a text is the sum of its sequences' vectors. Texts of one
language lie in one direction, so a language's prototype is the sum over its texts, and a document
gets the language with the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.labelled import share
from salesflow.llm.tables import hash_bucket, id_and_text
from salesflow.sources.workspace import saved

DIMENSIONS = 1024
SEED = 11
# Documents of each language that its prototype is learnt from, about.
SAMPLE_ROWS = 4_000
# Prototypes that are held at once, by the driver and by a worker; more are compared in blocks.
LANGUAGES = 500
UNKNOWN = "und"
# Sequences whose vectors a worker keeps.
_CACHED = 16_384
# Texts whose profiles are made at once, sequences added at once, and characters counted at once.
_TEXTS = 64
_SEQUENCES = 20_000
_PIECE = 1_000_000


class Profiles:
    """Vectors of letter sequences and of texts."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self._dimensions = dimensions
        self._letters: dict[int, np.ndarray] = {}
        self._cache: dict[int, np.ndarray] = {}
        self._is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)

    def _letter(self, letter: int) -> np.ndarray:
        vector = self._letters.get(letter)
        if vector is None:
            bits = np.random.default_rng((SEED, letter)).integers(0, 2, self._dimensions)
            vector = self._letters[letter] = (2 * bits - 1).astype(np.int8)
        return vector

    def _vector(self, code: int) -> np.ndarray:
        """The product of three letters' vectors, rotated by two places, one and none."""
        vector = self._cache.get(code)
        if vector is None:
            first, second, third = (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF)
            vector = np.roll(self._letter(first), 2) * np.roll(self._letter(second), 1)
            vector = (vector * self._letter(third)).astype(np.float32)
            if len(self._cache) >= _CACHED:
                self._cache.clear()
            self._cache[code] = vector
        return vector

    def _piece(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        letters = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
        letters = np.where(self._is_letter[letters], letters, 32).astype(np.int64)
        letters = letters[(letters != 32) | np.append(True, letters[:-1] != 32)]
        codes = letters[:-2] << 42 | letters[1:-1] << 21 | letters[2:]
        return np.unique(codes[letters[1:-1] != 32], return_counts=True)

    def sequences(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of three letters in the words of a text, and how often they occur.

        A blank begins and ends a word. A very long text is counted in pieces that end at a space.
        """
        if len(text) <= _PIECE:
            return self._piece(text)
        found, start = [], 0
        while start < len(text):
            end = start + _PIECE
            if end < len(text):
                end = max(text.rfind(" ", start, end), start) + 1
                end = end if end > start + 1 else start + _PIECE
            found.append(self._piece(text[start:end]))
            start = end
        codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
        return codes, np.bincount(at, np.concatenate([n for _, n in found]), len(codes))

    def profiles(self, texts: list[str]) -> np.ndarray:
        """A row for each text: the sum of its sequences' vectors; zeros without any letter.

        Sequences are added in bounded groups, whether one text has them or many.
        """
        total = np.zeros((len(texts), self._dimensions))
        group, held = [], 0
        for row, text in enumerate(texts):
            codes, counts = self.sequences(text)
            for start in range(0, len(codes), _SEQUENCES):
                part = slice(start, start + _SEQUENCES)
                group.append((row, codes[part], counts[part]))
                held += len(codes[part])
                if held >= _SEQUENCES:
                    self._add(total, group)
                    group, held = [], 0
        if group:
            self._add(total, group)
        return total

    def _add(self, total: np.ndarray, group: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        rows = [row for row, _, _ in group]
        codes, at = np.unique(np.concatenate([c for _, c, _ in group]), return_inverse=True)
        place = np.repeat(np.arange(len(group)), [len(c) for _, c, _ in group])
        counts = np.concatenate([n for _, _, n in group])
        for start in range(0, len(codes), 4096):
            part = codes[start : start + 4096].tolist()
            own = (at >= start) & (at < start + len(part))
            table = np.zeros((len(group), len(part)), np.float32)
            np.add.at(table, (place[own], at[own] - start), counts[own])
            np.add.at(total, rows, table @ np.stack([self._vector(c) for c in part]))


@dataclass(frozen=True)
class Block:
    """Unit vectors of some languages, in the order of their names."""

    names: tuple[str, ...]
    vectors: np.ndarray

    def languages(self, profiles: np.ndarray) -> list[tuple[str, float]]:
        """For each profile the language and its cosine, at least 0; of equal ones the first."""
        lengths = np.linalg.norm(profiles, axis=1)
        if not self.names:
            return [(UNKNOWN, 0.0)] * len(profiles)
        cosines = profiles @ self.vectors.T / np.maximum(lengths, 1e-9)[:, None]
        best = cosines.argmax(axis=1)
        return [
            (self.names[k], float(min(1.0, max(0.0, row[k])))) if length else (UNKNOWN, 0.0)
            for k, row, length in zip(best, cosines, lengths, strict=True)
        ]


class Prototypes:
    """The prototypes of all languages as a written table (block, lang, place, value)."""

    def __init__(self, values: DataFrame, languages: int):
        self._values = values
        self.languages = languages
        self.blocks = max(1, -(-languages // LANGUAGES))

    def block(self, number: int) -> Block:
        """At most `LANGUAGES` prototypes, which bounds what reaches the driver."""
        found: dict[str, np.ndarray] = {}
        for row in self._values.filter(F.col("block") == number).collect():
            found.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["place"]] = row["value"]
        names = tuple(sorted(found))
        vectors = np.array([found[n] / np.linalg.norm(found[n]) for n in names])
        return Block(names, vectors.reshape(len(names), DIMENSIONS))


def _bundles(batches):
    """Sums of the unit profiles of each language's texts, as (lang, place, value) rows."""
    profiles, sums = Profiles(), {}

    def rows():
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(total)],
                ["lang", "place", "value"],
            )

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for start in range(0, len(langs), _TEXTS):
            found = profiles.profiles(batch.column(1).slice(start, _TEXTS).to_pylist())
            lengths = np.linalg.norm(found, axis=1)
            for lang, profile, length in zip(langs[start : start + _TEXTS], found, lengths, strict=True):
                if length:
                    sums[lang] = sums.get(lang, 0.0) + profile / length
            if len(sums) > LANGUAGES:
                yield from rows()
                sums.clear()
    yield from rows()


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Prototypes:
    """Prototypes from documents with a language that are not held out.

    About `rows` documents of each language are taken, by a hash of the id; of a rarer language
    all. Every language whose texts have letters gets a prototype; a table without any gives none.
    """
    labelled = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .filter(hash_bucket(F.col("doc_id"), 4) != 2)
    )
    counts = saved(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("texts")), "languages")
    # A few languages are broadcast; beyond that texts are dealt by their language.
    few = counts.count() <= LANGUAGES
    sampled = labelled.join(F.broadcast(counts) if few else counts, "lang").filter(
        share(F.col("doc_id")) * F.col("texts") < rows
    )
    sums = saved(
        sampled.select("lang", "text")
        .mapInArrow(_bundles, "lang string, place int, value double")
        .groupBy("lang", "place")
        # Decimals add up alike in any order, so that reruns agree to the last bit.
        .agg(F.sum(F.col("value").cast("decimal(30,12)")).cast("double").alias("value")),
        "bundles",
    )
    names = sums.filter("value != 0").select("lang").distinct()
    number = F.row_number().over(Window.orderBy("lang")) - 1
    numbered = saved(names.select("lang", F.floor(number / LANGUAGES).cast("int").alias("block")), "blocks")
    return Prototypes(saved(sums.join(numbered, "lang"), "prototypes"), numbered.count())


def _with_language(block: Block):
    @F.pandas_udf("lang_pred string, score double")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        profiles = Profiles()
        for texts in batches:
            found = [
                language
                for start in range(0, len(texts), _TEXTS)
                for language in block.languages(profiles.profiles(texts.iloc[start : start + _TEXTS].tolist()))
            ]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    return language


def _profile():
    @F.pandas_udf("binary")
    def profile(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        profiles = Profiles()
        for texts in batches:
            parts = [
                found.astype("<f4").tobytes()
                for start in range(0, len(texts), _TEXTS)
                for found in profiles.profiles(texts.iloc[start : start + _TEXTS].tolist())
            ]
            yield pd.Series(parts, dtype=object)

    return profile


def _languages_of(block: Block):
    @F.pandas_udf("lang_pred string, score double")
    def language(stored: pd.Series) -> pd.DataFrame:
        found = [
            language
            for start in range(0, len(stored), _TEXTS)
            for language in block.languages(
                np.stack([np.frombuffer(p, "<f4") for p in stored.iloc[start : start + _TEXTS]]).astype(float)
            )
        ]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return language


def identified(docs: DataFrame, prototypes: Prototypes) -> DataFrame:
    """doc_id, held_out, lang_pred and score (the cosine) for each row of documents.

    A text without any letter, or NULL, is `und` with score 0, and so is every text if nothing was
    learnt. A NULL doc_id counts as not held out. Repeated rows are treated alike. With more than
    `LANGUAGES` languages, profiles are written once and compared with one block after the other.
    """
    held_out = F.coalesce(hash_bucket(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    if prototypes.blocks == 1:
        found = id_and_text(docs).select(
            "doc_id", held_out, _with_language(prototypes.block(0))("text").alias("found")
        )
        return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
    rows = id_and_text(docs).select("doc_id", held_out, _profile()("text").alias("profile"))
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "profiles")
    best = None
    for number in range(prototypes.blocks):
        scored = rows.select("row", _languages_of(prototypes.block(number))("profile").alias("f"))
        # Of equal scores the first language stands.
        scored = scored.select("row", F.struct((-F.col("f.score")).alias("minus"), "f.lang_pred").alias("best"))
        scored = scored if best is None else best.unionByName(scored)
        best = saved(scored.groupBy("row").agg(F.min("best").alias("best")), "best_languages")
    return rows.join(best, "row").select(
        "doc_id", "held_out", F.col("best.lang_pred"), (-F.col("best.minus")).alias("score")
    )
