"""Benchmark passages in documents, found by their templates.

Numbers, names and units become typed placeholders, so that a question with other values has the
same template. Windows of five template words are hash-joined. In an alignment of a document with an
item, a window counts if each of its values is unchanged or is always changed to the same value.
Windows with too few other words, and items shorter than a window, are joined by their exact words.

Windows that many different items have, such as a common instruction, are no evidence for one of them: an
item counts as found by the windows that few others have, where it has any, beside all of them. Arithmetic
of several operators is also joined as a whole, numbers being placeholders and operators words.

Texts are read twice: in lower case with listed names, and by their case, where other capitalised words
are names too and number words of one number are one placeholder. A finding of either reading counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.tables import text_of
from salesflow.sources.workspace import saved

WINDOW_WORDS = 5
# Words of a window that are no placeholders; windows with fewer only say something word for word.
LEAST_LITERALS = 3
# A document holds an item if it has this share of its windows, or as many in one alignment.
SHARE = 0.8
ALIGNED_WINDOWS = 9
# A window that more different items have says nothing about one of them.
COMMON_ITEMS = 10
# Operators from which on an item is looked for as a formula.
LEAST_OPERATORS = 3
# Bits of the map of benchmark windows that every task has: 2 MB, whatever the benchmark.
MAP_BITS = 1 << 24

# Words that stand for numbers, units and names (fixed values).
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion half dozen"
).split()
UNITS = (
    "mm cm km m meter meters metre metres kilometer kilometers mile miles inch inches foot feet yard "
    "yards mg kg gram grams kilogram kilograms pound pounds ounce ounces ton tons ml liter liters "
    "litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month "
    "months year years dollar dollars cent cents euro euros percent degrees celsius mph kmh watt "
    "watts volt volts"
).split()
NAMES = (
    "james mary robert patricia john jennifer michael linda david elizabeth william barbara richard "
    "susan joseph jessica thomas sarah charles karen daniel lisa matthew nancy anthony betty steven "
    "margaret paul sandra andrew ashley joshua kimberly kenneth emily kevin donna brian michelle "
    "george carol edward amanda jason melissa ryan deborah jacob stephanie alice bob tom anna emma "
    "olivia sophia liam noah lucas peter hans marie pierre juan carlos maria jose luis sofia"
).split()
# Number words by what may follow them in one number, and their values.
_UNIT, _TEEN, _TENS, _SCALE, _DIGITS, _AND = range(1, 7)
_VALUES = {w: (_UNIT if 0 < n < 10 else _TEEN, n) for n, w in enumerate(NUMBERS[:20])}
_VALUES |= {w: (_TENS, 20 + 10 * n) for n, w in enumerate(NUMBERS[20:28])}
_VALUES |= dict(hundred=(_SCALE, 100), thousand=(_SCALE, 10**3), million=(_SCALE, 10**6))
_VALUES |= dict(billion=(_SCALE, 10**9), dozen=(_SCALE, 12))
# "half" is a number of its own.
_PARTS = {"and": _AND, "half": 0} | {w: kind for w, (kind, _) in _VALUES.items()}
_FOLLOWS = np.zeros((7, 7), bool)
_FOLLOWS[_TENS, _UNIT] = True
_FOLLOWS[[_UNIT, _TEEN, _TENS, _SCALE, _DIGITS], _SCALE] = True
_FOLLOWS[_SCALE, [_UNIT, _TEEN, _TENS, _AND]] = True
_FOLLOWS[_AND, [_UNIT, _TEEN, _TENS]] = True
_KINDS = {**dict.fromkeys(NUMBERS, 1), **dict.fromkeys(UNITS, 2), **dict.fromkeys(NAMES, 3)}
# Words, and what ends a sentence or begins a new one: the word after it says nothing by its capital.
_ENDS = '.!?:;\n\r"“”„«»…'
# Latin letters are tried first, as they are found faster than letters in general.
_LATIN = r"[A-Za-zÀ-ÖØ-öø-ɏ]++(?![^\W\d_])"
_TOKENS = re.compile(rf"{_LATIN}|[^\W\d_]+|[0-9]+(?:[.,:/][0-9]+)*|[^\W_]|[{_ENDS}]")
_END_TOKENS = frozenset(_ENDS)
_SPECIAL = _END_TOKENS.union(_KINDS, _PARTS)
_GROUPED = re.compile(r"[0-9]{1,3}(?:,[0-9]{3})+")
_CACHED_WORDS = 200_000
# Rows that leave a task at once, about.
_ROWS = 10_000
# Readings of a text; one row stands for both if they are equal. Formulas are a reading of their own.
BOTH, LOWER, BY_CASE, FORMULA = -1, 0, 1, 2
_TERMS = re.compile(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+|[-+*/×÷^=%()]")
_OPERATORS = frozenset("-+*/×÷^")
_OPERATION = re.compile(r"[0-9)]\s*[-+*/×÷^]\s*[0-9(]")

WINDOWS = "id long, content long, position int, window long, slots array<string>, telling boolean, length int, reading int"


def _value(words: list[str]) -> str:
    """The number that a run of number words or digits says, in digits where that is clear."""
    first = words[0]
    if len(words) == 1 and first not in _VALUES:
        return first.replace(",", "") if _GROUPED.fullmatch(first) else first
    total, part = 0, 0
    for word in words:
        if word == "and":
            continue
        if word not in _VALUES:
            digits = _value([word])
            if not digits.isascii() or not digits.isdigit() or len(digits) > 18:
                return " ".join(words)
            part = int(digits)
            continue
        kind, value = _VALUES[word]
        if kind != _SCALE:
            part += value
        elif value in (12, 100):
            part = (part or 1) * value
        else:
            total, part = total + (part or 1) * value, 0
    return str(total + part)


@dataclass(frozen=True)
class Reading:
    """The words of a text, their hashes, those of their placeholders, and the kinds.

    The words are tokens at the given places in lower case, but for numbers in digits.
    """

    tokens: list[str]
    places: np.ndarray
    exact: np.ndarray
    template: np.ndarray
    kinds: np.ndarray
    numbers: dict[int, str]

    def word(self, at: int) -> str:
        return self.numbers.get(at) or self.tokens[self.places[at]].lower()


class Templates:
    """Hashes of the template words and windows of texts."""

    def __init__(self, size: int):
        self._size = size
        self._cache: dict[str, int] = {}
        # Of each word in the cache: hashes of the word and of its placeholder, kind, part of a
        # number, whether it is capitalised and whether it ends a sentence.
        self._exact, self._template = np.zeros((2, 1024), np.uint64)
        self._kind, self._number, self._capital, self._end = np.zeros((4, 1024), np.int8)
        self._placeholders = [xxhash.xxh64_intdigest(f"<{kind}>") for kind in range(4)]
        generator = np.random.default_rng(20)
        self._factors = generator.integers(1, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def _add(self, tokens: set[str]) -> None:
        if len(self._cache) + len(tokens) > len(self._exact):
            for name in ("_exact", "_template", "_kind", "_number", "_capital", "_end"):
                old = getattr(self, name)
                new = np.zeros(2 * (len(old) + len(tokens)), old.dtype)
                new[: len(old)] = old
                setattr(self, name, new)
        tokens = list(tokens)
        words = list(map(str.lower, tokens))
        at = slice(len(self._cache), len(self._cache) + len(tokens))
        exact = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        self._exact[at] = self._template[at] = exact
        self._kind[at] = self._number[at] = self._end[at] = 0
        self._capital[at] = [t != w and len(t) > 1 and t[0].isupper() for t, w in zip(tokens, words, strict=True)]
        # Few words are more than letters.
        for i, w in enumerate(words, at.start):
            if w in _SPECIAL or w[0].isdigit():
                kind = 1 if w[0].isdigit() else _KINDS.get(w, 0)
                self._kind[i], self._end[i] = kind, w in _END_TOKENS
                self._number[i] = _PARTS.get(w, _DIGITS if kind == 1 else 0)
                if kind:
                    self._template[i], self._capital[i] = self._placeholders[kind], False
        self._cache.update(zip(tokens, range(at.start, at.stop), strict=True))

    def _places(self, tokens: list[str]) -> np.ndarray:
        """The number of each token in the cache."""
        try:
            return np.fromiter(map(self._cache.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            if len(self._cache) > _CACHED_WORDS:
                self._cache.clear()
            self._add(set(tokens).difference(self._cache))
            return np.fromiter(map(self._cache.__getitem__, tokens), np.int64, len(tokens))

    def readings(self, text: str) -> list[Reading]:
        """The text in lower case with listed names, and by its case if that differs."""
        tokens = _TOKENS.findall(text.replace("İ", "i̇"))
        at = self._places(tokens)
        ends = self._end[at]
        places = np.flatnonzero(ends == 0)
        at = at[places]
        kinds = self._kind[at]
        plain = Reading(tokens, places, self._exact[at], self._template[at], kinds, {})
        capitals = np.flatnonzero(self._capital[at])
        starts = (places[capitals] == 0) | (ends[places[capitals] - 1] == 1)
        names = capitals[~starts]
        if len(names) and len(names) < len(capitals):
            names = capitals[np.isin(at[capitals], at[names])]
        numbers = np.flatnonzero(kinds == 1)
        if not len(names) and not any(
            tokens[i].lower() in _VALUES or _GROUPED.fullmatch(tokens[i]) for i in places[numbers].tolist()
        ):
            return [plain]
        kinds, template = kinds.copy(), plain.template.copy()
        kinds[names], template[names] = 3, self._placeholders[3]
        first = np.arange(len(at))
        if len(numbers):
            first = np.flatnonzero(~self._joined(self._number[at], np.diff(places) > 1))
        exact, template, kinds = plain.exact[first], template[first], kinds[first]
        last = np.append(first[1:], len(at))
        values = {}
        for i in np.flatnonzero(kinds == 1).tolist():
            values[i] = _value([tokens[j].lower() for j in places[first[i] : last[i]].tolist()])
            exact[i] = xxhash.xxh64_intdigest(values[i])
        return [plain, Reading(tokens, places[first], exact, template, kinds, values)]

    def _joined(self, numbers: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Which words belong to the number that the word before them is part of."""
        joined = np.append(False, _FOLLOWS[numbers[:-1], numbers[1:]] & ~apart)
        # "and" only joins a number on both sides of it.
        ands = np.flatnonzero(numbers == _AND)
        loose = ands[~(joined[ands] & np.append(joined, False)[ands + 1])]
        joined[loose] = False
        joined[loose[loose + 1 < len(joined)] + 1] = False
        return joined

    def _hashes(self, words: np.ndarray, size: int) -> np.ndarray:
        """The hashes of the windows of `size` words."""
        count = len(words) - size + 1
        total = np.zeros(count, np.uint64)
        for k in range(size):
            total += words[k : k + count] * self._factors[k]
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(32)
        return total

    def windows(self, read: Reading) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the windows, of their exact words if they are not telling, and which are."""
        count = len(read.kinds) - self._size + 1
        if count < 1:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        hashes = self._hashes(read.template, self._size)
        if not read.kinds.any():
            return hashes, np.ones(count, bool)
        literals = np.zeros(count, np.int8)
        for k in range(self._size):
            literals += read.kinds[k : k + count] == 0
        telling = literals >= min(LEAST_LITERALS, self._size)
        if not telling.all():
            hashes = np.where(telling, hashes, self._hashes(read.exact, self._size))
        return hashes, telling

    def formulas(self, text: str, lengths=None) -> list[tuple[int, int, int, list[str]]]:
        """(length, position, hash, numbers) of windows of so many terms with enough operators.

        Without lengths there is one window, of all terms of the text.
        """
        if lengths == () or not _OPERATION.search(text):
            return []
        terms = _TERMS.findall(text.lower())
        operators = np.cumsum([0, *(t in _OPERATORS for t in terms)])
        words = np.array(
            [self._placeholders[1] if t[0].isdigit() else xxhash.xxh64_intdigest(t) for t in terms], np.uint64
        )
        found = []
        for length in [len(terms)] if lengths is None else lengths:
            count = len(terms) - length + 1
            if count < 1:
                continue
            # A polynomial of the words, so that any length costs one pass; the inverse of the factor takes
            # a window's place in the text out again.
            factor = int(self._factors[0])
            up = np.cumprod(np.full(len(terms), factor, np.uint64), dtype=np.uint64)
            down = np.cumprod(np.full(count, pow(factor, -1, 1 << 64), np.uint64), dtype=np.uint64)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up, dtype=np.uint64)])
            hashes = (sums[length:] - sums[:count]) * down
            for i in np.flatnonzero(operators[length:] - operators[:count] >= LEAST_OPERATORS).tolist():
                numbers = [t for t in terms[i : i + length] if t[0].isdigit()]
                mark = xxhash.xxh64_intdigest(f"{length}:{hashes[i]}")
                found.append((length, i, mark, numbers))
        return found

    def short_windows(self, read: Reading, lengths=None) -> list[tuple[int, np.ndarray]]:
        """Hashes of the exact words of windows of the given lengths, all below `size`.

        Without lengths there is one window, of all words of a text shorter than `size`.
        """
        count = len(read.kinds)
        if lengths is None:
            lengths = [count] if 0 < count < self._size else []
        return [(n, self._hashes(read.exact, n)) for n in lengths if n <= count]


def _bit(windows: np.ndarray) -> np.ndarray:
    return windows & np.uint64(MAP_BITS - 1)


def _windows(size: int, bitmap=None, lengths=None, terms=None):
    """Rows of `WINDOWS` for each text; with a bitmap only for windows that are in it.

    `lengths` and `terms` are the lengths of short items and of formulas, for texts that are not items.
    """

    def as_batch(rows):
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(8)]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()))
        types += (pa.bool_(), pa.int32(), pa.int32())
        names = ["id", "content", "position", "window", "slots", "telling", "length", "reading"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def rows_of(batches):
        templates = Templates(size)
        bits = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            ids, contents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for row, text in enumerate(batch.column(2)):
                if len(rows) >= _ROWS:
                    yield as_batch(rows)
                    rows = []
                readings = templates.readings(text.as_py())
                numbers = (LOWER, BY_CASE) if len(readings) > 1 else (BOTH,)
                made = [(size, n, r, *templates.windows(r)) for n, r in zip(numbers, readings, strict=True)]
                for length, windows in templates.short_windows(readings[0], lengths):
                    made.append((length, numbers[0], readings[0], windows, np.zeros(len(windows), bool)))
                for length, at, mark, slots in templates.formulas(text.as_py(), terms):
                    if bits is None or bits[(mark & MAP_BITS - 1) >> 3] >> (mark & 7) & 1:
                        window = mark - (1 << 64) if mark >> 63 else mark
                        rows.append((ids[row], contents[row], at, window, slots, True, length, FORMULA))
                for length, number, read, windows, telling in made:
                    places = range(len(windows))
                    if bits is not None:
                        at = _bit(windows)
                        known = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                        places = np.flatnonzero(known).tolist()
                    for i in places:
                        slots = [read.word(j) for j in range(i, i + length) if read.kinds[j]]
                        window = int(windows[i].view(np.int64))
                        rows.append(
                            (ids[row], contents[row], i, window, slots, bool(telling[i]), length, number)
                        )
            yield as_batch(rows)

    return rows_of


def _keyed_texts(rows: DataFrame, key: str) -> DataFrame:
    """The id, a hash of the text, and the text."""
    text = text_of(rows)
    return rows.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("content"), text.alias("text"))


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """The windows of each item, whether many items have them, and how many it has of which sort."""
    found = saved(_keyed_texts(benchmark, "item_id").mapInArrow(_windows(size), WINDOWS), "items")
    # Equal texts are one item here, whatever their ids.
    owners = found.select("window", F.col("content").alias("owner")).distinct().groupBy("window")
    common = owners.agg(F.count(F.lit(1)).alias("owners")).filter(F.col("owners") > COMMON_ITEMS)
    found = found.join(common, "window", "left").withColumn("common", F.col("owners").isNotNull())
    windows = found.select(
        F.col("id").alias("item_id"),
        F.col("content").alias("item"),
        F.col("position").alias("item_position"),
        F.col("window").alias("item_window"),
        F.col("slots").alias("item_slots"),
        F.col("telling").alias("item_tells"),
        F.col("length").alias("item_length"),
        F.col("reading").alias("item_reading"),
        F.col("common").alias("item_common"),
    )
    keys = (F.col("id").alias("_id"), F.col("content").alias("_item"), F.col("reading").alias("_reading"))
    counts = found.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("item_windows"),
        F.count_if("telling").alias("item_telling"),
        F.count_if(~F.col("common")).alias("item_own"),
        F.count_if(~F.col("common") & F.col("telling")).alias("item_own_telling"),
    )
    same = F.col("item_id").eqNullSafe(F.col("_id")) & (F.col("item") == F.col("_item"))
    same &= F.col("item_reading") == F.col("_reading")
    return windows.join(counts, same).drop("_id", "_item", "_reading")


def _bitmap(items: DataFrame) -> bytes:
    """The map of the items' windows: combined to 64-bit words before it reaches the driver."""
    bit = F.col("item_window").bitwiseAND(MAP_BITS - 1)
    words = (
        items.select(
            F.shiftright(bit, 6).cast("int").alias("word"),
            F.expr("shiftleft(1L, cast(item_window & 63 as int))").alias("mask"),
        )
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
    )
    found = np.zeros(MAP_BITS // 64, np.int64)
    for row in words.toLocalIterator():
        found[row["word"]] = row["mask"]
    return found.astype("<i8").tobytes()


def _longest_run(places: Column) -> Column:
    """The most places that follow one another in a sorted list of different ones."""
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def longer(state: Column, place: Column) -> Column:
        run = F.when(place == state["last"] + 1, state["run"] + 1).otherwise(F.lit(1))
        return F.struct(place.alias("last"), run.alias("run"), F.greatest(state["best"], run).alias("best"))

    return F.aggregate(places, start, longer, lambda state: state["best"])


def held_items(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, share: float = SHARE
) -> DataFrame:
    """(doc_id, content, item_id, ...) for each document text that holds a benchmark item, by reading.

    A text is looked at as a whole. Of all its windows only those in the bounded map of benchmark
    windows leave the task; the join then drops the map's accidental ones. An item with fewer than
    `size` words is held by each text that has its words one after another. NULL and empty texts hold
    nothing and are in nothing. Equal texts have equal findings, repeated rows one for each id. Items
    with equal id and text count once. Windows that are not telling are of no use where values were
    changed, so the share is taken of the telling windows too. The share must also hold for the item's
    own windows, those that at most `COMMON_ITEMS` items have, and only these count in an alignment; an
    item without any is judged by all. Texts and items meet on own windows; the common ones are then
    looked up for the pairs that have met, so that a common passage pairs nothing.
    """
    spark = docs.sparkSession
    items = saved(benchmark_windows(benchmark.select("item_id", "text").distinct(), size), "item_windows")
    bitmap = spark.sparkContext.broadcast(_bitmap(items))
    texts = _keyed_texts(docs, "doc_id")
    # Lengths of the items that are shorter than a window, at most `size` - 1 numbers.
    is_formula = F.col("item_reading") == FORMULA
    short = items.filter((F.col("item_length") < size) & ~is_formula).select("item_length").distinct()
    lengths = sorted(r["item_length"] for r in short.collect())
    # Lengths of formulas: as many as the benchmark has different ones.
    formulas = items.filter(is_formula).select("item_length").distinct()
    terms = tuple(sorted(r["item_length"] for r in formulas.collect()))
    hits = saved(texts.mapInArrow(_windows(size, bitmap, lengths, terms), WINDOWS).distinct(), "hits")
    either = (F.col("reading") == BOTH) | (F.col("item_reading") == BOTH)
    same = (F.col("window") == F.col("item_window")) & (either | (F.col("reading") == F.col("item_reading")))
    by_common = F.col("item_common") & (F.col("item_own") > 0)
    own = hits.join(items.filter(~by_common), same)
    # The common windows of the pairs of a text and an item that have met already.
    pairs = own.select("id", "content", "item_id", "item").distinct().withColumnsRenamed(
        {"id": "_id", "content": "_content", "item_id": "_item_id", "item": "_item"}
    )
    asked = items.filter(by_common).join(
        pairs, (F.col("item") == F.col("_item")) & F.col("item_id").eqNullSafe(F.col("_item_id"))
    )
    text = (F.col("content") == F.col("_content")) & F.col("id").eqNullSafe(F.col("_id"))
    more = hits.join(asked, same & text).drop("_id", "_content", "_item_id", "_item")
    met = own.unionByName(more).withColumn("reading", F.greatest("reading", "item_reading"))
    pair = lambda a, b: F.struct(a.alias("item"), b.alias("doc"))
    # Windows that are not telling on both sides met by their exact words, whatever the kinds of those.
    pairs = F.when(
        F.col("item_tells") & F.col("telling"), F.zip_with("item_slots", "slots", pair)
    ).otherwise(F.transform("item_slots", lambda a: pair(a, a)))
    one_met = F.struct(
        F.col("item_position").alias("place"),
        pairs.alias("pairs"),
        F.col("item_tells").alias("tells"),
        (~by_common).alias("own"),
    )
    # In one alignment each place of the item meets one place of the text, so lists are short.
    aligned = (
        met.withColumn("shift", F.col("position") - F.col("item_position"))
        .groupBy("id", "content", "item_id", "item", "reading", "item_windows", "item_telling", "item_own", "item_own_telling", "shift")
        .agg(F.sort_array(F.collect_set(one_met)).alias("met"))
        .withColumn("values", F.sort_array(F.array_distinct(F.flatten("met.pairs"))))
        # Values of the item that meet several values; equal ones are neighbours.
        .withColumn(
            "torn",
            F.array_distinct(
                F.filter(
                    F.transform(
                        "values",
                        lambda v, i: F.when((i > 0) & (F.get("values", i - 1)["item"] == v["item"]), v["item"]),
                    ),
                    lambda v: v.isNotNull(),
                )
            ),
        )
    )
    unchanged = lambda v: v["item"] == v["doc"]
    agrees = lambda v: unchanged(v) | ~F.array_contains("torn", v["item"])
    aligned = (
        aligned.withColumn("met", F.filter("met", lambda m: F.forall(m["pairs"], agrees)))
        .withColumn("evidence", F.filter("met", lambda m: m["own"]))
        .withColumn("places", F.col("evidence.place"))
        .withColumn("kept", F.size(F.filter("evidence", lambda m: F.forall(m["pairs"], unchanged))))
    )
    # Where values disagree, unchanged windows are evidence, and changed ones that follow one another.
    per_item = (
        aligned.select(
            "*",
            F.when(F.size("torn") == 0, F.size("places"))
            .otherwise(F.greatest("kept", _longest_run(F.col("places"))))
            .alias("aligned"),
            F.exists("values", lambda v: ~unchanged(v)).alias("changed"),
        )
        .withColumn("one", F.explode(F.transform("met", lambda m: F.struct(m["place"], m["tells"], m["own"]))))
        .groupBy("id", "content", "item_id", "item", "reading", "item_windows", "item_telling", "item_own", "item_own_telling")
        .agg(
            F.collect_set("one").alias("found"),
            F.max("aligned").alias("aligned"),
            F.max("changed").alias("other_values"),
        )
    )
    per_item = (
        per_item.withColumn("windows", F.size("found"))
        .withColumn("telling", F.size(F.filter("found", lambda w: w["tells"])))
        .withColumn("own", F.size(F.filter("found", lambda w: w["own"])))
        .withColumn("own_telling", F.size(F.filter("found", lambda w: w["own"] & w["tells"])))
    )
    # By case, an item with capitals all over has few telling windows, which alone say little.
    least = F.when(F.col("reading") != BY_CASE, F.lit(1)).otherwise(F.col("item_windows") / 2)
    # Of an item without windows of its own all count as such.
    found = (
        ((F.col("windows") >= share * F.col("item_windows")) & (F.col("own") >= share * F.col("item_own")))
        | (
            (F.col("item_telling") >= least)
            & (F.col("telling") >= share * F.col("item_telling"))
            & (F.col("own_telling") >= share * F.col("item_own_telling"))
        )
        | (F.col("aligned") >= ALIGNED_WINDOWS)
    )
    return per_item.filter(found).select(
        F.col("id").alias("doc_id"),
        "content",
        "item_id",
        "windows",
        F.col("item_windows").cast("int").alias("item_windows"),
        "other_values",
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, windows found, windows of the item, and whether values were changed.

    A row for each document and item in it; documents without any have none. The windows are those of
    the reading that finds the larger share. NULL and empty texts hold nothing; without documents or
    items there are no rows.
    """
    found = held_items(docs, benchmark)
    best = F.struct(F.col("windows") / F.col("item_windows"), "windows", "item_windows")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"), F.max("other_values").alias("other_values"))
        .select("doc_id", "item_id", "best.windows", "best.item_windows", "other_values")
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text holds no benchmark item, with all their columns.

    Rows with NULL or empty text stay, repeated rows stay or go together, an empty benchmark keeps all.
    """
    found = saved(held_items(docs, benchmark).select("content").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(text_of(docs)).alias("content"))
    return rows.join(found, "content", "left_anti").select("row.*")
