"""Nearest neighbours against all distances in double precision."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesflow.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k, step, single):
    """All distances; vectors of other lengths and the query's own id are no candidates."""
    good = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good.setdefault(i, set()).add(tuple(single(x) for x in v))
    result = {}
    for q, own in good.items():
        if q % step == 0:
            near = [
                (min(math.dist(a, b) for a in own for b in others if len(a) == len(b)), i)
                for i, others in good.items()
                if i != q and {len(a) for a in own} & {len(b) for b in others}
            ]
            result[q] = sorted(near)[:k]
    return result


def check(spark, rows, k=10, step=5, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    found = {}
    for r in neighbours.nearest(df, F.col("vec_id") % step == 0, k).orderBy("rank").collect():
        near = found.setdefault(r["query_id"], [])
        near.append((r["score"], r["vec_id"]))
        assert r["rank"] == len(near)
    expected = {q: near for q, near in plain(rows, k, step, float if 'double' in schema else lambda x: float(np.float32(x))).items() if near}
    assert found.keys() == expected.keys()
    for query, near in expected.items():
        assert [i for _, i in found[query]] == [i for _, i in near]
        assert [d for d, _ in found[query]] == pytest.approx([d for d, _ in near], rel=1e-12, abs=0)


def vectors(count, size, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, v) for i, v in enumerate(rng.normal(size=(count, size)).astype(np.float32).tolist())]


def test_random_vectors(spark):
    check(spark, vectors(700, 16))


def test_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_TILE", 16)
    monkeypatch.setattr(neighbours, "CANDIDATE_TILE", 32)
    monkeypatch.setattr(neighbours, "_STRIP", 7)
    check(spark, vectors(500, 8))


def test_ties_and_copies(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(100)]
    check(spark, rows)
    check(spark, rows + rows[:40] + [(5, [9.0, 9.0]), (5, [-9.0, 9.0])])


def test_close_to_each_other(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=32)
    check(spark, [(i, (base + rng.normal(size=32) * 1e-4).astype(np.float32).tolist()) for i in range(300)])


def test_unusable_and_uneven_vectors(spark):
    odd = [
        (None, [1.0, 2.0]),
        (1000, None),
        (1005, []),
        (1010, [0.0, 0.0]),
        (1015, [1.0, None]),
        (1020, [float("nan"), 1.0]),
        (1025, [float("inf"), 1.0]),
        (1030, [1e30, 1.0]),
        (1035, [1e-30, 0.0]),
        (1040, [1.0, 2.0, 3.0]),
        (1045, [1.0]),
    ]
    check(spark, vectors(30, 2) + odd)


WIDE = "vec_id long, embedding array<double>"


def test_components_whose_squares_are_out_of_range(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        power = [0, 200, -200, 150, -160, 300, -300, 77][i % 8]
        rows.append((i, (rng.normal(size=6) * 10.0**power).tolist()))
    check(spark, rows, schema=WIDE)
    check(spark, [(100, [1e200, 1.0]), *((i, [float(i), 2.0]) for i in range(1, 40))], schema=WIDE)
    check(spark, [(i, [1e-200 * i, 1e-201]) for i in range(1, 60)], schema=WIDE)


def test_ids_with_many_different_vectors(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i % 12 if i % 3 else 7, rng.normal(size=5).tolist()) for i in range(900)]
    check(spark, rows, k=4, schema=WIDE)
    monkeypatch.setattr(neighbours, "CANDIDATE_TILE", 50)
    check(spark, rows, k=4, schema=WIDE)


def test_copies_of_one_vector_are_a_few_rows(spark):
    rng = np.random.default_rng(9)
    others = [(i, rng.normal(size=4).tolist()) for i in range(1000, 1060)]
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(600)] + others + [(5, [1.0, 2.0, 3.0, 4.0])] * 20
    check(spark, rows, k=7, schema=WIDE)
    good = neighbours.usable(spark.createDataFrame(rows, WIDE))
    assert neighbours.candidates(good, 7).count() == 8 + len(others)


def test_tiles_travel_as_bytes(spark):
    df = spark.createDataFrame(vectors(300, 64), SCHEMA)
    tiles = neighbours.usable(df).mapInArrow(neighbours._tiles(100), neighbours._TILE)
    sizes = tiles.select(*(F.length(n).alias(n) for n in neighbours._PARTS)).groupBy().sum().first()
    assert sum(sizes) == 300 * (64 + 4 * 8)


def test_few_or_no_candidates(spark):
    check(spark, vectors(4, 3))
    check(spark, vectors(1, 3))
    check(spark, vectors(0, 3) + [(None, None)])


def test_other_columns_play_no_part(spark):
    df = spark.createDataFrame(vectors(50, 4), SCHEMA)
    named = df.select("*", *(F.lit(1).alias(n) for n in ("size", "tile", "tie", "ids", "vector", "rank", "score", "column", "low")))
    is_query = F.col("vec_id") % 5 == 0
    assert sorted(neighbours.nearest(named, is_query).collect()) == sorted(neighbours.nearest(df, is_query).collect())


def test_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(50, 40)), rng.normal(size=(60, 40)) * 100
    (ca, sa, ea), (cb, sb, eb) = neighbours.quantised(a), neighbours.quantised(b)
    approximate = np.linalg.norm((ca * sa[:, None])[:, None] - (cb * sb[:, None])[None], axis=2)
    exact = np.linalg.norm(a[:, None] - b[None], axis=2)
    assert (np.abs(approximate - exact) <= ea[:, None] + eb + 1e-9).all()
    assert (neighbours._products(ca, cb) == ca.astype(int) @ cb.astype(int).T).all()
