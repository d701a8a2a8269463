"""Near duplicates by SimHash fingerprints, linked with the pigeonring filter.

A fingerprint is a ring of 16 segments of 4 bits. If two of them differ in at most 4 bits, some
segment starts a chain whose first n segments differ in at most floor(n * 4 / 16) bits, for every
n: nothing in the first 3 segments, at most one bit in the first 7, and so on. One bit in segments
4 to 7 leaves either the first or the second half of them equal, so the first 3 segments and one
half are a key on which each linked pair meets. Pairs that meet must keep the whole chain within its
budgets before their Hamming distance is compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salesflow.llm.graph import connected_components
from salesflow.llm.tables import id_and_text
from salesflow.sources.workspace import saved

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
SEGMENTS = 16
SEGMENT_BITS = 64 // SEGMENTS
# Fingerprints with one key beyond which they are linked by common midpoints, not pair by pair.
HOT_KEY = 32_768
# Shingles whose bits are counted at once: 64 bytes each.
_CHUNK = 200_000


def _shingles(words: list[bytes], size: int):
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def fingerprint_of(text: str, size: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of one text; 0 without words.

    bytes.lower() folds A-Z only and bytes.split() cuts at space and 0x09 to 0x0D only.
    """
    shingles = _shingles(text.encode("utf-8", "surrogatepass").lower().split(), size)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(shingles), _CHUNK):
        hashes = [xxhash.xxh64_intdigest(s, SEED) for s in shingles[start : start + _CHUNK]]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(shingles)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a signed long; NULL counts as empty."""

    @F.pandas_udf(T.LongType())
    def column(texts: pd.Series) -> pd.Series:
        found = [fingerprint_of(t or "", size) for t in texts]
        return pd.Series(np.array(found, dtype=np.uint64).view(np.int64))

    return column(text)


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint) for each row of documents."""
    return id_and_text(docs).select("doc_id", fingerprint(F.col("text"), size).alias("fingerprint"))


def _rotated(value: Column, bits: int) -> Column:
    bits %= 64
    if not bits:
        return value
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def _top(value: Column, skip: int, take: int) -> Column:
    """`take` bits after the first `skip` ones."""
    return F.shiftrightunsigned(F.shiftleft(value, skip), 64 - take)


def _keyed(nodes: DataFrame, distance: int) -> DataFrame:
    """A row for each chain start and half: the ring turned to that start, and its key."""
    free = next(n for n in range(1, SEGMENTS + 1) if n * distance // SEGMENTS >= 1) - 1
    once = next((n for n in range(1, SEGMENTS) if n * distance // SEGMENTS >= 2), SEGMENTS) - 1
    equal, loose = free * SEGMENT_BITS, (once - free) * SEGMENT_BITS
    half = loose // 2
    turned = []
    for start in range(SEGMENTS):
        ring = _rotated(F.col("fingerprint"), start * SEGMENT_BITS)
        for part, (skip, take) in enumerate(((equal, half), (equal + half, loose - half))):
            key = F.shiftleft(_top(ring, 0, equal), take).bitwiseOR(_top(ring, skip, take))
            tag = F.lit((2 * start + part) << 56)
            turned.append(F.struct(key.bitwiseOR(tag).alias("key"), ring.alias("ring")))
    return nodes.select(F.explode(F.array(*turned)).alias("k")).select("k.key", "k.ring")


def _chain_holds(difference: Column, distance: int) -> Column:
    """Each prefix of the chain stays within its share of the distance; the last is the whole."""
    held = F.lit(True)
    for n in range(1, SEGMENTS + 1):
        budget, next_budget = n * distance // SEGMENTS, (n + 1) * distance // SEGMENTS
        if n == SEGMENTS or next_budget > budget:  # the longest prefix with this budget decides
            bits = F.shiftrightunsigned(difference, 64 - n * SEGMENT_BITS)
            held = held & (F.bit_count(bits) <= budget)
    return held


def _midpoint_links(keyed: DataFrame) -> DataFrame:
    """Links among fingerprints of hot keys, by a row per point within half the distance.

    Two fingerprints at most 4 bits apart have a common point at most 2 bits from both, and no
    two with such a point are further apart. A point has at most 2,081 fingerprints around it, so
    linking all of them to the smallest takes neither pairs nor large groups.
    """
    members = _unturned(keyed, "ring").select(F.col("node").alias("fingerprint")).distinct()
    single = [1 << i for i in range(64)]
    flips = [0, *single, *(a | b for i, a in enumerate(single) for b in single[:i])]
    flips = [f - (1 << 64) if f >> 63 else f for f in flips]
    points = members.select(
        "fingerprint", F.explode(F.transform(F.lit(flips), lambda f: f.bitwiseXOR(F.col("fingerprint")))).alias("point")
    )
    low = F.min("fingerprint").over(Window.partitionBy("point"))
    return (
        points.select(low.alias("a"), F.col("fingerprint").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )


def _unturned(keyed: DataFrame, name: str) -> DataFrame:
    """The fingerprint behind a turned ring; its start is in the key's tag."""
    turn = f"({SEGMENT_BITS} * cast(shiftrightunsigned(key, 57) as int))"
    back = f"shiftrightunsigned({name}, {turn}) | shiftleft({name}, 64 - {turn})"
    return keyed.withColumn("node", F.expr(back))


def links(nodes: DataFrame, distance: int = MAX_DISTANCE, hot_key: int = HOT_KEY) -> DataFrame:
    """Links (a, b) between distinct fingerprints at most `distance` bits apart.

    Below hot keys every such pair is given; fingerprints with a hot key in common get links that
    connect the same ones. Only narrow rows of distinct fingerprints are shuffled, 32 each.
    """
    if distance != MAX_DISTANCE:
        raise ValueError("the chain key and the midpoints are laid out for 4 bits")
    keyed = saved(_keyed(nodes, distance), "keys")
    hot = saved(
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_key).select("key"),
        "hot_keys",
    )
    has_hot = not hot.isEmpty()
    cold = keyed.join(hot, "key", "left_anti") if has_hot else keyed
    left = cold.select("key", F.col("ring").alias("ring_a"))
    right = cold.select(F.col("key").alias("key_b"), F.col("ring").alias("ring_b"))
    difference = F.col("ring_a").bitwiseXOR(F.col("ring_b"))
    met = left.join(
        right,
        (F.col("key") == F.col("key_b"))
        & (F.col("ring_a") < F.col("ring_b"))
        & _chain_holds(difference, distance)
        & (F.bit_count(difference) <= distance),
    )
    met = _unturned(met, "ring_a").withColumnRenamed("node", "a")
    met = _unturned(met, "ring_b").withColumnRenamed("node", "b")
    found = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    if has_hot:
        found = found.unionByName(_midpoint_links(keyed.join(hot, "key", "left_semi"))).distinct()
    return found


def components(prints: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """(fingerprint, root, component_id): the smallest fingerprint and doc_id that can be reached.

    `prints` holds (doc_id, fingerprint). Equal fingerprints are one node, so any number of copies
    costs one row. The component of documents without any doc_id has the id NULL.
    """
    nodes = saved(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "fingerprints"
    )
    roots = connected_components(links(nodes, hot_key=hot_key)).withColumnRenamed("node", "fingerprint")
    rooted = saved(nodes.join(roots, "fingerprint", "left"), "roots")
    linked = rooted.filter(F.col("root").isNotNull())
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    alone = rooted.filter(F.col("root").isNull())
    return (
        linked.join(lowest, "root")
        .select("fingerprint", "root", "component_id")
        .unionByName(
            alone.select(
                "fingerprint",
                F.col("fingerprint").alias("root"),
                F.col("first_id").alias("component_id"),
            )
        )
    )


def near_duplicates(docs: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id for each row of documents.

    NULL and empty texts have the fingerprint zero and are linked like others; repeated rows and
    repeated ids keep a row each; a NULL doc_id belongs to a component but never names it. An
    empty table gives an empty one; columns other than doc_id and text play no part.
    """
    prints = saved(fingerprints(docs), "prints")
    found = prints.join(components(prints, hot_key), "fingerprint")
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """Documents without near duplicates: of each group the row with the smallest doc_id stays.

    Among rows of a group that share this id, and in a group without any doc_id, the first by
    fingerprint and JSON text stays. All columns are kept; rows with NULL or empty text are one
    group. An empty table stays empty.
    """
    prints = saved(fingerprints(docs), "prints")
    groups = saved(components(prints, hot_key), "groups")
    ids = (
        prints.join(groups, "fingerprint")
        .groupBy("doc_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.col("doc_id") == F.col("component_id")).alias("first"),
        )
        .filter("first")
    )
    ids = saved(ids.select(F.col("doc_id").alias("_id"), "n"), "kept_ids")
    rows = docs.select(F.struct("*").alias("row"))
    with_id = F.col("row.doc_id").cast("long") == F.col("_id")
    # Ids are hashed per partition, so that texts are dealt by id once but not sorted.
    kept = rows.join(ids.filter("n = 1").hint("shuffle_hash"), with_id, "left_semi")
    repeated = ids.filter("n > 1")
    nameless = rows.filter(F.col("row.doc_id").isNull())
    if not (repeated.isEmpty() and nameless.isEmpty()):
        unsure = rows.join(repeated, with_id, "left_semi").unionByName(nameless)
        printed = unsure.withColumn("_print", fingerprint(F.coalesce("row.text", F.lit(""))))
        of_group = groups.withColumnRenamed("fingerprint", "_print")
        first = F.min_by("row", F.struct("_print", F.to_json("row")))
        chosen = (
            printed.join(of_group, "_print")
            .filter(F.col("row.doc_id").cast("long").eqNullSafe(F.col("component_id")))
            .groupBy("root")
            .agg(first.alias("row"))
        )
        kept = kept.unionByName(chosen.select("row"))
    return kept.select("row.*")
