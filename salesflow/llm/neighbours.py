"""Nearest neighbours of a stated query set by a block matrix join.

Vectors are quantised to signed bytes once, which leaves an error of known length. Queries and
candidates are laid out in tiles of bytes; each pair of tiles is one integer matrix product, which bounds
every distance from both sides. Pairs whose lower bound is above the query's k-th upper bound are done
with; the few others meet their original vectors and are computed again in double precision, and
the k best are merged for each query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesflow.sources.workspace import saved

NEIGHBOURS = 10
QUERY_SHARE = 100
# Vectors of a query tile and of a candidate tile.
QUERY_TILE = 4_096
CANDIDATE_TILE = 4_096
# Columns into which the candidates of a query tile are dealt, and so the tasks that share it.
GRID = 32
# Rows of a query tile that are compared at once.
_STRIP = 256
# Distances below this are lost in the squares of double precision, and no bound may rely on them.
_TINY = 1e-150

_TILE = "size int, tile long, ids binary, ties binary, codes binary, scale binary, error binary"
_PARTS = ("ids", "ties", "codes", "scale", "error")


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, tie, vector): the vectors of doubles that can take part.

    Left out are NULL and empty vectors, those with a NULL, infinite or undefined component, zero
    vectors, and rows without an id. `tie` tells different vectors of one id apart.
    """
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)
    return (
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("vector"),
        )
        .filter(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
        .select("vec_id", F.xxhash64("vector").alias("tie"), "vector")
    )


def candidates(good: DataFrame, k: int) -> DataFrame:
    """Of the ids with one and the same vector the k + 1 smallest, equal rows once.

    As ties go to smaller ids, no other copy can be among the k nearest of any query, which may be one
    of them itself. The limit is applied before the shuffle too, so a very common vector is a few rows.
    """
    place = F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id"))
    return good.withColumn("place", place).filter(F.col("place") <= k + 1).drop("place").distinct()


def _tiles(rows_per_tile: int):
    """Packs rows (vec_id, tie, vector) into tiles of quantised vectors of as many components."""

    def tiles(batches):
        waiting: dict[int, tuple[list, list, list]] = {}
        number = 0

        def tile(size: int):
            nonlocal number
            ids, ties, vectors = waiting.pop(size)
            number += 1
            codes, scale, error = quantised(np.array(vectors, np.float64))
            parts = (np.array(ids, "<i8"), np.array(ties, "<i8"), codes, scale.astype("<f8"), error.astype("<f8"))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([size], pa.int32()),
                    pa.array([number], pa.int64()),
                    *(pa.array([p.tobytes()], pa.binary()) for p in parts),
                ],
                ["size", "tile", *_PARTS],
            )

        for batch in batches:
            columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
            for vec_id, tie, vector in zip(*columns, strict=True):
                values = vector.values.to_numpy(zero_copy_only=False)
                ids, ties, vectors = waiting.setdefault(len(values), ([], [], []))
                ids.append(vec_id)
                ties.append(tie)
                vectors.append(values)
                if len(ids) == rows_per_tile:
                    yield tile(len(values))
        for size in sorted(waiting):
            yield tile(size)

    return tiles


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signed bytes, the scale of each vector, and the length of its quantisation error."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    scale = np.where(scale > 0, scale, 1.0)
    # Errors are measured in units of the scale, so that no square leaves the range of doubles.
    units = vectors / scale[:, None]
    codes = np.rint(units)
    return codes.astype(np.int8), scale, np.linalg.norm(units - codes, axis=1) * scale


class Tile:
    """Quantised vectors of one size with their ids, as bytes that travel and as arrays."""

    def __init__(self, size: int, ids: bytes, ties: bytes, codes: bytes, scale: bytes, error: bytes):
        self.ids = np.frombuffer(ids, "<i8")
        self.ties = np.frombuffer(ties, "<i8")
        self.codes = np.frombuffer(codes, np.int8).reshape(-1, size)
        self.scale = np.frombuffer(scale, "<f8")
        self.error = np.frombuffer(error, "<f8")
        with np.errstate(over="ignore", under="ignore"):
            self.squares = (self.codes.astype(np.float64) ** 2).sum(axis=1) * self.scale**2


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The integer products of byte vectors; single precision holds 1,000 components exactly."""
    total = np.zeros((len(a), len(b)))
    for start in range(0, a.shape[1], 1000):
        part = slice(start, start + 1000)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


def bounds(queries: Tile, rows: slice, tile: Tile) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances of some queries to a tile; none where they overflow."""
    with np.errstate(all="ignore"):
        products = _products(queries.codes[rows], tile.codes) * queries.scale[rows, None] * tile.scale
        both = queries.squares[rows, None] + tile.squares
        middle = np.sqrt(np.maximum(both - 2 * products, 0.0))
        # Rounding of these sums is covered by a small share of the lengths.
        reach = queries.error[rows, None] + tile.error + 1e-6 * np.sqrt(both) + _TINY
        low, high = middle - reach, middle + reach
    return np.where(np.isfinite(low), low, -np.inf), np.where(np.isfinite(high), high, np.inf)


class Survivors:
    """Candidates of one query that may be among its k nearest, as far as tiles have been seen."""

    def __init__(self, k: int):
        self._k = k
        self._best: dict[int, float] = {}
        self._rows: list[tuple[np.ndarray, ...]] = []
        self._held = 0
        self.limit = np.inf

    def add(self, ids: np.ndarray, ties: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Candidates none of which is the query itself; an id can come with several vectors."""
        near = np.flatnonzero(low <= self.limit)
        closer = near[high[near] < self.limit]
        if len(closer) > 4 * self._k:
            # The k-th smallest bound of different ids: each id counts with its smallest one.
            order = np.lexsort((high[closer], ids[closer]))
            first = np.r_[True, np.diff(ids[closer][order]) != 0]
            own = closer[order][first]
            closer = own[np.argsort(high[own], kind="stable")[: self._k]]
        for vec_id, bound in zip(ids[closer].tolist(), high[closer].tolist(), strict=True):
            self._best[vec_id] = min(bound, self._best.get(vec_id, np.inf))
        if len(self._best) >= self._k:
            kept = sorted(self._best.items(), key=lambda item: item[1])[: self._k]
            self._best, self.limit = dict(kept), kept[-1][1]
        near = near[low[near] <= self.limit]
        self._rows.append((ids[near], ties[near], low[near], high[near]))
        self._held += len(near)
        if self._held > 1_000 + 50 * self._k:
            self._rows = [self.rows()]
            self._held = len(self._rows[0][0])

    def rows(self) -> tuple[np.ndarray, ...]:
        """ids, ties, lower and upper bounds of those that are still possible."""
        columns = [np.concatenate(c) for c in zip(*self._rows, strict=True)]
        possible = columns[2] <= self.limit
        return tuple(c[possible] for c in columns)


_PAIR = "query_id long, query_tie long, vec_id long, tie long, low double, high double"


def _search(k: int):
    """The surviving candidates of each query among the tiles of this task, for pairs of tiles."""

    def search(batches):
        found: dict[tuple[int, int], Survivors] = {}
        names = ["size", *(f"query_{n}" for n in _PARTS), *_PARTS]
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                queries, tile = Tile(row[0], *row[1:6]), Tile(row[0], *row[6:])
                for start in range(0, len(queries.ids), _STRIP):
                    rows = slice(start, start + _STRIP)
                    low, high = bounds(queries, rows, tile)
                    own = zip(queries.ids[rows].tolist(), queries.ties[rows].tolist(), strict=True)
                    for place, query in enumerate(own):
                        other = tile.ids != query[0]
                        survivors = found.setdefault(query, Survivors(k))
                        survivors.add(tile.ids[other], tile.ties[other], low[place][other], high[place][other])
        for (query_id, query_tie), survivors in found.items():
            ids, ties, low, high = survivors.rows()
            same = [np.full(len(ids), x) for x in (query_id, query_tie)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in (*same, ids, ties)), pa.array(low), pa.array(high)],
                ["query_id", "query_tie", "vec_id", "tie", "low", "high"],
            )

    return search


def distance(a: str, b: str) -> Column:
    """The Euclidean distance of two vectors, without losing those whose squares are out of range."""
    gaps = F.zip_with(a, b, lambda x, y: x - y)

    def length(values: Column) -> Column:
        return F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))

    largest = F.array_max(F.transform(gaps, F.abs))
    scaled = F.when(largest == 0, 0.0).otherwise(largest * length(F.transform(gaps, lambda x: x / largest)))
    plain = length(gaps)
    return F.when((plain > 1e-140) & (plain < 1e150), plain).otherwise(scaled)


def _pairs(queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Pairs of queries and candidates that no bound excludes, as a written table."""
    query_tiles = saved(
        queries.mapInArrow(_tiles(QUERY_TILE), _TILE)
        .withColumn("query_tile", F.monotonically_increasing_id()),
        "query_tiles",
    )
    tiles = saved(found.mapInArrow(_tiles(CANDIDATE_TILE), _TILE).drop("tile"), "tiles")
    numbers = query_tiles.groupBy("size").agg(F.collect_list("query_tile").alias("numbers"))
    copies = tiles.join(numbers, "size").select(
        F.explode("numbers").alias("query_tile"),
        F.pmod(F.xxhash64("ids", "ties"), F.lit(GRID)).alias("column"),
        *_PARTS,
    )
    asked = query_tiles.select(
        "query_tile",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(GRID - 1).cast("long"))).alias("column"),
        "size",
        *(F.col(n).alias(f"query_{n}") for n in _PARTS),
    )
    pairs = copies.join(asked, ["query_tile", "column"])
    return saved(
        pairs.select("size", *(f"query_{n}" for n in _PARTS), *_PARTS).mapInArrow(_search(k), _PAIR), "pairs"
    )


def nearest(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest of each query, by Euclidean distance.

    Exact: every candidate is compared, and only proven losers are not computed again. Vectors
    are compared with those of as many components. Ties go to the smaller vec_id. A query with
    fewer candidates has them all, one without any no row. What `usable` leaves out takes no part.
    An id with several different vectors is as near as the nearest of them, as a query and as a candidate;
    vectors with the query's own id are no candidates. Components whose squares leave the range of
    doubles have no bounds, so such pairs are all computed.

    Every tile of queries meets every tile of candidates: candidates are copied to each query tile,
    query tiles to each column of a grid, and both are joined on that, as bytes. A task holds a few
    pairs of tiles and the survivors of its queries. Original vectors move for survivors only.
    """
    good = usable(vectors)
    queries = saved(good.filter(is_query).distinct(), "queries")
    found = saved(candidates(good, k), "candidates")
    pairs = _pairs(queries, found, k)
    # The k-th upper bound of each query over all tiles; a query has a few rows of each grid column.
    by_bound = Window.partitionBy("query_id").orderBy("high", "vec_id")
    upper = pairs.groupBy("query_id", "vec_id").agg(F.min("high").alias("high"))
    ranked = upper.withColumn("place", F.row_number().over(by_bound))
    limits = ranked.filter(F.col("place") <= k).groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) == k, F.max("high")).otherwise(float("inf")).alias("limit")
    )
    left = pairs.join(limits, "query_id").filter(F.col("low") <= F.col("limit"))
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("tie").alias("query_tie"), F.col("vector").alias("a"))
    found = found.select("vec_id", "tie", F.col("vector").alias("b"))
    exact = (
        left.select("query_id", "query_tie", "vec_id", "tie")
        .join(asked, ["query_id", "query_tie"])
        .join(found, ["vec_id", "tie"])
        .groupBy("query_id", "vec_id")
        .agg(F.min(distance("a", "b")).alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        exact.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
