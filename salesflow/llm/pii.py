"""Personal data by weak supervision, in built-in column functions.

Patterns find candidate spans. Six labelers vote on each (+1 personal, -1 not, 0 no opinion): the
strict pattern, a checksum or plausible length, a gazetteer of known values, words before the span
that speak for it, words that speak against it, and uniform digits. Expectation maximisation over
the counted vote patterns estimates how reliable each labeler is and how likely each pattern is
personal data; a logistic span classifier is trained on that and adds the candidates it accepts to
the base spans, which always stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.spans import chunks_of, cut, let, matches, scan
from salesflow.llm.tables import id_and_text
from salesflow.sources.workspace import saved

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(len(KINDS))
BASE_KINDS = KINDS[:4]

# Base patterns. Possessive repeats and the conditions in front change no match: what follows a
# repeated class is never in the class, and a match can begin only where a run of the class begins
# or the previous match ended. They keep long runs from being scanned again at each character.
_EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Looser patterns for further candidates.
_SPELT_EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++"
    r"(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]++)++"
)
_LOCAL_PHONE = (
    r"(?<![0-9A-Za-z.+-])(?<![0-9] )(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])"
    r"[0-9]{3,4}[ .-][0-9]{3,4}(?! ?[0-9A-Za-z.-]?[0-9])(?![A-Za-z-])"
)
_SECRET = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"

_IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_STRICT_IP = rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$"

# Gazetteers (fixed values): what known values of a kind look like.
KNOWN = {
    EMAIL: r"(?i)[.)\]] ?(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    IP: r"^(?!0|255\.)[0-9]",
    CARD: r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    PHONE: r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])(?![0-9]{12})",
    SECRET: r"^(?:sk|pk|rk|ghp|gho|xox[abp]|AKIA|AIza|eyJ)[A-Za-z0-9_-]",
}
# Words (fixed values) whose presence shortly before a span speaks for its kind.
SPEAKING_FOR = {
    EMAIL: r"(?i)(?:e-?mail|contact|write to|courriel|correo)",
    IP: r"(?i)(?:\bip\b|address|host|server|adresse)",
    CARD: r"(?i)(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)",
    PHONE: r"(?i)(?:phone|\btel\b|call|mobile|fax|telefon|t[eé]l[eé]phone|tel[eé]fono)",
    SECRET: r"(?i)(?:token|secret|passw|api.?key|bearer|credential)",
}
SPEAKING_AGAINST = r"(?i)(?:version|\bv|isbn|page|order|\bno\.|#|year|figure|section|chapter)\s*$"
_BEFORE = 32

VOTES = ("pattern", "checksum", "known", "context", "against", "uniform")
# Assumed beforehand for each labeler: the chances of the votes -1, 0 and +1 on a span that is not
# and that is personal data, as strong as so many observed spans.
_ASSUMED = ((0.6, 0.3, 0.1), (0.1, 0.3, 0.6))
_STRENGTH = 5.0
_ROUNDS = 40
_RIDGE = 0.1


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""

    def doubled(value: Column, even: Column) -> Column:
        return F.when(even, 2 * value - F.when(value > 4, 9).otherwise(0)).otherwise(value)

    def total(text: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
        return F.aggregate(
            places,
            F.lit(0),
            lambda sum_, i: sum_
            + let(text.substr(i, F.lit(1)).cast("int"), lambda v: doubled(v, i % 2 == 0)),
        )

    return let(F.reverse(digits), total) % 10 == 0


def _vote(for_: Column, against: Column) -> Column:
    vote = F.when(for_, 1).when(against, -1).otherwise(0)
    return F.coalesce(vote, F.lit(0)).cast("int")


def _candidate(kind: int, hit: Column, strict: Column, checked: Column) -> Column:
    """A span with the labelers' votes; `strict` and `checked` are true, false or NULL."""
    match, before = hit["match"], hit["before"]
    known, context = match.rlike(KNOWN[kind]), before.rlike(SPEAKING_FOR[kind])
    nothing = F.lit(False)
    alike = _digits(match).rlike(r"^(.)\1{5,}$")
    return F.struct(
        F.lit(kind).alias("kind"),
        hit["start"].alias("start"),
        hit["end"].alias("end"),
        F.coalesce(strict, F.lit(False) if kind != SECRET else nothing).alias("base"),
        _vote(strict, ~strict).alias("pattern"),
        _vote(checked, ~checked).alias("checksum"),
        _vote(known, ~known if kind == CARD else nothing).alias("known"),
        _vote(context, nothing).alias("context"),
        _vote(nothing, before.rlike(SPEAKING_AGAINST)).alias("against"),
        _vote(nothing, alike).alias("uniform"),
        (match.rlike("[ -]").cast("int") if kind == CARD else F.lit(0)).alias("parted"),
    )


def _between(value: Column, low: int, high: int) -> Column:
    return (value >= low) & (value <= high)


def candidates(text: Column) -> Column:
    """An array of candidate spans of a whole text, with votes; base spans are marked."""
    unknown = F.lit(None).cast("boolean")
    none = F.array().cast(
        "array<struct<kind:int,start:bigint,end:bigint,base:boolean,pattern:int,checksum:int,"
        "known:int,context:int,against:int,uniform:int,parted:int>>"
    )

    def found(guard: Column, kind: int, pattern: str, strict, checked, keep=None) -> Column:
        hits = matches(text, pattern, _BEFORE)
        if keep is not None:
            hits = F.filter(hits, lambda h: keep(h["match"]))
        spans = F.transform(
            hits, lambda h: _candidate(kind, h, strict(h["match"]), checked(h["match"]))
        )
        return F.when(guard, spans).otherwise(none)

    digit = text.rlike("[0-9]")
    count = lambda m: F.length(_digits(m))
    card = lambda m: let(_digits(m), lambda d: _between(F.length(d), 16, 19) & luhn(d))
    dotted = lambda m: m.rlike(_STRICT_IP)
    opaque = lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    return F.concat(
        found(text.contains("@"), EMAIL, _EMAIL, lambda m: F.lit(True), lambda m: unknown),
        found(text.rlike(r"[\[(]at[\])]"), EMAIL, _SPELT_EMAIL, lambda m: unknown, lambda m: unknown),
        found(digit, IP, _IP, dotted, dotted),
        found(digit, CARD, _CARD, card, lambda m: luhn(_digits(m)), lambda m: _between(count(m), 13, 19)),
        found(
            text.contains("+"),
            PHONE,
            _PHONE,
            lambda m: _between(count(m), 8, 15),
            lambda m: _between(count(m), 10, 13),
        ),
        found(
            digit, PHONE, _LOCAL_PHONE, lambda m: unknown, lambda m: _between(count(m), 9, 11)
        ),
        found(
            digit,
            SECRET,
            _SECRET,
            lambda m: unknown,
            lambda m: _between(count(m), 5, 10_000_000),
            opaque,
        ),
    )


@dataclass(frozen=True)
class SpanClassifier:
    """Weights of a logistic model: one for each kind, each vote, and separators within a card number."""

    kinds: tuple[float, ...]
    votes: tuple[float, ...]
    parted: float

    def accepts(self, span: Column) -> Column:
        total = F.get(F.array(*map(F.lit, self.kinds)), span["kind"]) + span["parted"] * self.parted
        for name, weight in zip(VOTES, self.votes, strict=True):
            total = total + span[name] * weight
        return total >= 0


def estimate(patterns: list[tuple[int, tuple[int, ...], float]]) -> list[float]:
    """The chance of each vote pattern (kind, votes, count) to be personal data.

    Two-class expectation maximisation; each labeler has its own chances of a vote in each kind and
    class, with the assumed ones as prior counts, so that few candidates give sensible results too.
    """
    belief = [0.5] * len(patterns)
    kinds = sorted({kind for kind, _, _ in patterns})
    chance = {(k, j, y): _ASSUMED[y] for k in kinds for j in range(len(VOTES)) for y in (0, 1)}
    share = dict.fromkeys(kinds, 0.5)
    for _ in range(_ROUNDS):
        for i, (kind, votes, _) in enumerate(patterns):
            logs = [math.log(1 - share[kind]), math.log(share[kind])]
            for y in (0, 1):
                logs[y] += sum(math.log(chance[kind, j, y][v + 1]) for j, v in enumerate(votes))
            belief[i] = 1 / (1 + math.exp(max(-700.0, min(700.0, logs[0] - logs[1]))))
        for kind in kinds:
            own = [(v, n, b) for (k, v, n), b in zip(patterns, belief, strict=True) if k == kind]
            total, positive = sum(n for _, n, _ in own), sum(n * b for _, n, b in own)
            share[kind] = (positive + 1) / (total + 2)
            for j in range(len(VOTES)):
                for y in (0, 1):
                    seen = [_STRENGTH * p for p in _ASSUMED[y]]
                    for votes, n, b in own:
                        seen[votes[j] + 1] += n * (b if y else 1 - b)
                    chance[kind, j, y] = tuple(s / sum(seen) for s in seen)
    return belief


def train(patterns: list[tuple[int, tuple[int, ...], int, float]]) -> SpanClassifier:
    """A logistic model of the estimated chances, from (kind, votes, parted, count)."""
    belief = estimate([(kind, votes, n) for kind, votes, _, n in patterns])
    width = len(KINDS) + len(VOTES) + 1
    # A span of each kind without any vote counts once as not personal.
    inputs = np.zeros((len(patterns) + len(KINDS), width))
    target, weight = np.zeros(len(inputs)), np.ones(len(inputs))
    inputs[len(patterns) :, : len(KINDS)] = np.eye(len(KINDS))
    for i, (kind, votes, parted, n) in enumerate(patterns):
        inputs[i, kind] = 1
        inputs[i, len(KINDS) : -1] = votes
        inputs[i, -1] = parted
        target[i], weight[i] = belief[i], n
    weights = np.zeros(width)
    weight = weight / weight.sum() * min(weight.sum(), 1000.0)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (weight * (chance - target)) + _RIDGE * weights
        bend = (inputs.T * (weight * chance * (1 - chance))) @ inputs + _RIDGE * np.eye(width)
        step = np.linalg.solve(bend, slope)
        weights -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
    numbers = [float(w) for w in weights]
    return SpanClassifier(
        tuple(numbers[: len(KINDS)]), tuple(numbers[len(KINDS) : -1]), numbers[-1]
    )


def learn(found: DataFrame) -> SpanClassifier:
    """The classifier from a column `found` of candidates.

    What reaches the driver is a count for each combination of kind, votes and separators: at most
    5 * 2 * 3 ** 6 rows, whatever the corpus.
    """
    spans = found.select(F.explode("found").alias("s")).select("s.*")
    counted = spans.groupBy("kind", *VOTES, "parted").agg(F.count(F.lit(1)).alias("n"))
    rows = sorted(
        (r["kind"], tuple(r[v] for v in VOTES), r["parted"], float(r["n"])) for r in counted.collect()
    )
    return train(rows)


def _all_spans(found: Column, model: SpanClassifier) -> Column:
    """Base spans and the accepted candidates that overlap neither them nor one that begins earlier.

    Two scans over the spans by their start: backwards for the next base span, forwards for the ends
    of base spans and of candidates taken so far.
    """

    def spans(all_found: Column) -> Column:
        usable = F.filter(all_found, lambda s: s["base"] | model.accepts(s))
        # Of equal starts the base span comes first.
        ordered = F.sort_array(
            F.transform(
                usable,
                lambda s: F.struct(
                    s["start"].alias("start"), (~s["base"]).alias("added"), s["kind"].alias("kind"), s["end"].alias("end")
                ),
            )
        )
        return let(ordered, apart)

    def apart(ordered: Column) -> Column:
        none = F.lit((1 << 63) - 1)
        next_base = F.reverse(
            scan(
                F.reverse(ordered),
                none,
                lambda base, s: F.when(s["added"], base).otherwise(s["start"]),
                lambda base, s: base,
            )
        )
        known = F.zip_with(ordered, next_base, lambda s, base: F.struct(s.alias("s"), base.alias("next_base")))

        def stays(end: Column, k: Column) -> Column:
            return ~k["s"]["added"] | ((k["s"]["start"] >= end) & (k["next_base"] >= k["s"]["end"]))

        flags = scan(
            known,
            F.lit(0).cast("long"),
            lambda end, k: F.when(stays(end, k), F.greatest(end, k["s"]["end"])).otherwise(end),
            stays,
        )
        chosen = F.filter(
            F.zip_with(ordered, flags, lambda s, flag: F.struct(s.alias("s"), flag.alias("stays"))), lambda x: x["stays"]
        )
        bare = F.transform(
            chosen,
            lambda x: F.struct(x["s"]["kind"].alias("kind"), x["s"]["start"].alias("start"), x["s"]["end"].alias("end")),
        )
        return F.sort_array(bare)

    return let(found, spans)


def _written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts of base spans, their digest, and all spans, for each row of documents.

    NULL and empty texts have no spans. Candidates are found once and written; texts are not.
    Repeated rows have their spans each; a NULL doc_id stays NULL.
    """
    texts = id_and_text(docs)
    found = saved(texts.select("doc_id", candidates(F.col("text")).alias("found")), "spans")
    model = learn(found)
    base = F.sort_array(
        F.transform(
            F.filter("found", lambda s: s["base"]),
            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
        )
    )

    def count(kind: int) -> Column:
        own = F.filter("found", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(own).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id",
        *map(count, range(len(BASE_KINDS))),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(_all_spans(F.col("found"), model)).alias("spans"),
    )


def _replaced(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; what overlaps goes under the first one's name."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    by_start = F.sort_array(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )

    def written(chunks: Column, ordered: Column) -> Column:
        # Where the text goes on in front of each span: behind all spans before it.
        begins = scan(ordered, F.lit(0).cast("long"), lambda at, s: F.greatest(at, s["end"]), lambda at, s: at)
        parts = F.zip_with(
            ordered,
            begins,
            lambda s, at: F.when(s["start"] < at, "").otherwise(
                F.concat(cut(chunks, at, s["start"]), F.get(names, s["kind"]))
            ),
        )
        end = F.array_max(F.transform(ordered, lambda s: s["end"]))
        return F.concat(F.array_join(parts, ""), cut(chunks, end, F.length(text).cast("long")))

    return let(chunks_of(text), lambda chunks: let(by_start, lambda ordered: written(chunks, ordered)))


def masked(docs: DataFrame) -> DataFrame:
    """Documents whose text has each span replaced by its kind in brackets, such as [EMAIL].

    Overlapping spans are replaced together, under the name of the first. All columns are kept;
    a NULL text stays NULL, and n_chars, where there is such a column, is the new text's length. An
    empty table stays empty. Candidates are found once and written beside the documents.
    """
    rows = docs.select(F.struct("*").alias("row"), docs["text"].alias("text"))
    rows = rows.select("row", candidates(F.coalesce("text", F.lit(""))).alias("found"))
    rows = saved(rows, "candidates")
    model = learn(rows)
    text = F.col("row.text")
    clean = F.when(
        text.isNotNull(),
        let(_all_spans(F.col("found"), model), lambda s: F.when(F.size(s) == 0, text).otherwise(_replaced(text, s))),
    )
    result = rows.select("row", clean.alias("_clean"))
    columns = []
    for name in docs.columns:
        value = F.col("row").getField(name)
        if name == "text":
            value = F.col("_clean")
        elif name == "n_chars":
            same = F.col("_clean").eqNullSafe(F.col("row.text"))
            value = F.when(same, value).otherwise(F.length("_clean")).cast(docs.schema[name].dataType)
        columns.append(value.alias(name))
    return result.select(*columns)
