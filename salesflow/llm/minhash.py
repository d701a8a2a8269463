"""Near duplicates by fast similarity sketches, banding and exact verification.

A sketch has t coordinates. In each round every shingle of a text is hashed to one coordinate and to
a value that begins with the number of the round; a coordinate keeps the smallest. Rounds go on
until all are filled: t of them place shingles at random, t more fill one coordinate each, so none can
stay empty. Two sketches agree in a coordinate with the probability of their Jaccard similarity, with
concentration as for independent samples, in time t log t + shingles instead of t * shingles.

Texts with equal sets are one class. Classes with a band of equal coordinates share a bucket. In
each bucket all classes are first compared with its pivot, the class that shares the most buckets, which
takes no pairs. What then still lies in different components is compared pair by pair, on the same full
sets, but only where sketches, the overlaps of both with the pivot, and the shingles that they share with
anybody leave the required similarity possible.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.graph import connected_components
from salesflow.llm.tables import id_and_text
from salesflow.sources.workspace import saved

SHINGLE_WORDS = 5
LEAST_PERCENT = 85
COORDINATES = 240
# At 85 % a pair shares no band of 6 in 40 with a probability of 6e-9.
BAND_COORDINATES = 6
BANDS = COORDINATES // BAND_COORDINATES
SEED = 13
# A pair's sketches may differ by so many standard deviations more than expected.
DEVIATIONS = 6.5
# Shingles that are sketched at once, and words whose hashes a worker keeps.
_CHUNK = 200_000
_CACHED = 500_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well spread number for each number (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd_numbers(count: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)


class Shingles:
    """The distinct shingles of texts as sorted 64-bit hashes; hashes of words are remembered."""

    def __init__(self, size: int = SHINGLE_WORDS):
        self._size = size
        self._weights = _odd_numbers(size + 1)
        self._words: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self._words
        if len(known) > _CACHED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word, SEED)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def of(self, text: str) -> np.ndarray:
        """bytes.lower() folds A-Z only and bytes.split() cuts at space and 0x09 to 0x0D only."""
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        hashes, size = self._hashes(words), min(self._size, len(words))
        count = len(words) - size + 1
        total = np.full(count, int(self._weights[-1]) * size & _MASK, np.uint64)
        for i in range(size):
            total += hashes[i : i + count] * self._weights[i]
        return np.unique(_mixed(total))


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """A row of coordinates for each set, none of which may be empty."""
    filled = np.full((len(sets), coordinates), _EMPTY)
    flat = filled.reshape(-1)
    shingles = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for turn in range(2 * coordinates):
        x = _mixed(shingles + np.uint64((turn + 1) * _GOLDEN & _MASK))
        if turn < coordinates:
            place = ((x >> np.uint64(40)) * np.uint64(coordinates) >> np.uint64(24)).astype(np.int64)
        else:
            place = turn - coordinates
        value = (x & np.uint64((1 << 40) - 1)) | np.uint64(turn << 40)
        np.minimum.at(flat, owner * coordinates + place, value)
        left = (filled == _EMPTY).any(axis=1)
        if not left.any():
            break
        still = left[owner]
        shingles, owner = shingles[still], owner[still]
    return filled


def bands_of(filled: np.ndarray) -> np.ndarray:
    """The bucket of each band of each sketch, as signed longs that differ between bands."""
    parts = filled.reshape(len(filled), -1, BAND_COORDINATES)
    weights = _odd_numbers(BAND_COORDINATES)
    number = np.arange(parts.shape[1], dtype=np.uint64) * np.uint64(_GOLDEN)
    return _mixed((_mixed(parts) * weights).sum(axis=2, dtype=np.uint64) + number).view(np.int64)


def bits_of(filled: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, as signed longs: bits of unequal coordinates differ in half the cases."""
    bits = (_mixed(filled) >> np.uint64(63)).astype(np.uint8)
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


_PRINT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
        ("bands", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())),
    ]
)


def _prints(size: int):
    def batch_of(rows):
        full = [(i, s) for i, (_, s) in enumerate(rows) if len(s)]
        bands, bits = [None] * len(rows), [None] * len(rows)
        if full:
            filled = sketches([s for _, s in full])
            for (i, _), band, bit in zip(full, bands_of(filled), bits_of(filled), strict=True):
                bands[i], bits[i] = band, bit
        digests = [digest_of(s) if len(s) else None for _, s in rows]
        columns = [[i for i, _ in rows], [len(s) for _, s in rows], digests, bands, bits]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _PRINT, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=_PRINT)

    def printed(batches):
        shingles, rows, held = Shingles(size), [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows.append((doc_id, shingles.of(text.as_py())))
                held += len(rows[-1][1]) + COORDINATES
                if held >= _CHUNK:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return printed


def digest_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


def prints_of(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n, digest, bands and bits of each row; the last three are NULL without any word."""
    schema = "doc_id long, n long, digest binary, bands array<long>, bits array<long>"
    return id_and_text(docs).mapInArrow(_prints(size), schema)


def _sets(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("digest", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def found(batches):
        shingles = Shingles(size)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = [shingles.of(t) for t in part.column(1).to_pylist()]
                arrays = [
                    part.column(0), part.column(2), pa.array(map(digest_of, sets), pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return found


def _node(first_id: Column, tie: Column) -> Column:
    """Classes are ordered by their smallest doc_id, those without any last; `tie` tells apart classes
    of one repeated id."""
    return F.struct(first_id.isNull().alias("nameless"), first_id.alias("first_id"), tie.alias("tie"))


def _sets_of(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of classes, from a text of each; only texts with their ids are dealt."""
    wanted = nodes.select(
        "node.nameless", F.coalesce("node.first_id", F.lit(0)).alias("first_id"), "node.tie"
    ).hint("shuffle_hash")
    rows = id_and_text(docs).withColumn("nameless", F.col("doc_id").isNull())
    rows = rows.withColumn("first_id", F.coalesce("doc_id", F.lit(0)))
    texts = rows.join(wanted, ["nameless", "first_id"]).select("doc_id", "text", "tie")
    found = texts.mapInArrow(_sets(size), "doc_id long, tie long, digest binary, shingles array<long>")
    # An id can be that of several texts, and a row can be there several times.
    own = found.filter(F.xxhash64("digest") == F.col("tie"))
    return own.groupBy("doc_id", "tie").agg(F.first("shingles").alias("shingles")).select(
        _node(F.col("doc_id"), F.col("tie")).alias("node"), "shingles"
    )


def _similar(common: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * common >= percent * (n + m - common)


def _plausible(a: str, b: str, percent: int) -> Column:
    """Sizes and sketches of two classes leave the required similarity possible."""
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    words = -(-COORDINATES // 64)
    differing = sum(F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])) for i in range(words))
    share = (1 - percent / 100) / 2
    most = COORDINATES * share + DEVIATIONS * math.sqrt(COORDINATES * share * (1 - share))
    return (100 * small >= percent * large) & (differing <= math.ceil(most))


def _with_common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes with the number of shingles of their full sets: n, m and common."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(right, "b").join(left, "a")
    return both.select(
        "a", "b", F.size("of_a").alias("n"), F.size("of_b").alias("m"),
        F.size(F.array_intersect("of_a", "of_b")).alias("common"),
    )


def _links_of(counted: DataFrame, percent: int) -> DataFrame:
    similar = counted.filter(_similar(F.col("common"), F.col("n"), F.col("m"), percent))
    return similar.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _with_shared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members with `shared`: how many of their shingles another member has as well."""
    nodes = members.select("member.node").distinct()
    own = sets.join(nodes, "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
    alone = own.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.first("node").alias("node"))
    alone = alone.filter("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    return members.join(alone, F.col("member.node") == alone["node"], "left").select(
        *members.columns, (F.col("member.n") - F.coalesce("alone", F.lit(0))).alias("shared")
    )


def _most_common(x: str, y: str) -> Column:
    """No more shingles can be common: of the pivot's not more than either has, and of all others
    not more than either shares with anybody."""
    outside = [F.col(f"{z}.shared") - F.col(f"{z}.of_pivot") for z in (x, y)]
    return F.least(f"{x}.of_pivot", f"{y}.of_pivot") + F.least(*outside)


def links(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) that connect all similar classes; every one is verified on full sets."""
    keyed = classes.select("node", F.explode("bands").alias("key"))
    met = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = saved(keyed.join(met, "key").select("key", "size", "node"), "buckets")
    scores = members.groupBy("node").agg(F.sum("size").alias("score"))
    nodes = saved(
        classes.select("node", "n", "bits").join(scores, "node").select(
            "node", F.struct("node", "n", "bits").alias("member"), "score"
        ),
        "members",
    )
    sets = saved(_sets_of(docs, nodes, size), "sets")
    members = members.join(nodes, "node").select("key", "member", "score")
    pivots = members.groupBy("key").agg(F.max_by("member.node", F.struct("score", "member.node")).alias("pivot"))
    members = saved(members.join(pivots, "key").select("key", "member", "pivot"), "bucket_members")
    star = members.select(F.col("member.node").alias("a"), F.col("pivot").alias("b")).filter("a != b").distinct()
    star = saved(_with_common(saved(star, "star_pairs"), sets), "star")
    found = saved(_links_of(star, percent), "star_links")

    # What is in one component already needs no more comparing. Of other pairs in a bucket, the
    # overlaps with its pivot exclude most.
    roots = connected_components(found).withColumnRenamed("node", "of")
    placed = members.join(roots, F.col("member.node") == F.col("of"), "left").select(
        "key", "member", "pivot", F.coalesce("root", "member.node").alias("root")
    )
    placed = saved(placed, "placed")
    several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    several = several.filter("low != high").select("key")
    # Pivots count among those who share a shingle, so that all of a member's shingles in one are shared.
    unsure = _with_shared(placed.join(several, "key", "left_semi"), sets)
    overlaps = star.select(F.col("a").alias("of"), F.col("b").alias("with"), F.col("common").alias("of_pivot"))
    known = (F.col("member.node") == F.col("of")) & (F.col("pivot") == F.col("with"))
    unsure = saved(unsure.join(overlaps, known).select("key", "member", "root", "of_pivot", "shared"), "unsure")
    left, right = (
        unsure.select("key", F.struct("member.*", "root", "of_pivot", "shared").alias(n)) for n in "xy"
    )
    rest = left.join(right, "key").filter(
        (F.col("x.root") < F.col("y.root"))
        & _plausible("x", "y", percent)
        & _similar(_most_common("x", "y"), F.col("x.n"), F.col("y.n"), percent)
    )
    rest = rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    return found.unionByName(_links_of(_with_common(saved(rest, "pairs"), sets), percent))


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = LEAST_PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of documents.

    Two texts are linked if their sets of `size`-word shingles have at least `percent` % in common; of
    fewer words the whole sequence is the only shingle. NULL, empty and blank texts have no shingle and
    are linked with nothing: their component is their own doc_id. Repeated rows and ids keep a row
    each; a NULL doc_id belongs to a component but never names it and is never kept. An empty table
    gives an empty one; columns other than doc_id and text play no part. Shingles are compared by
    64-bit hashes, classes by 128 bits of a digest of all of them.
    """
    prints = saved(prints_of(docs, size), "prints")
    classes = prints.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), *(F.first(c).alias(c) for c in ("n", "bands", "bits"))
    )
    classes = classes.withColumn("node", _node(F.col("first_id"), F.xxhash64("digest")))
    classes = saved(classes.drop("first_id"), "classes")
    roots = connected_components(saved(links(docs, classes, size, percent), "verified"))
    groups = classes.select("digest", "node").join(roots, "node", "left")
    groups = groups.select("digest", F.coalesce("root", "node").alias("root"))
    rows = prints.select("doc_id", "n", "digest").join(groups, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("root.first_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


# An independent way: all pairs of texts with a common shingle, and the closure of their links.
ORACLE_SQL = f"""
with recursive worded as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words from documents),
shingles as (
  select distinct doc_id, unnest(list_transform(
    range(1, greatest(length(words) - {SHINGLE_WORDS - 1}, least(length(words), 1)) + 1),
    lambda i: array_to_string(words[i : i + {SHINGLE_WORDS - 1}], ' '))) as shingle
  from worded),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as k
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
linked as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * k >= {LEAST_PERCENT} * (x.n + y.n - k)),
reached as (
  select doc_id as a, doc_id as b from documents
  union select r.a, l.b from reached r join linked l on r.b = l.a),
lowest as (select a as doc_id, min(b) as component_id from reached group by a)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join lowest using (doc_id) left join sizes s using (doc_id)
"""
