"""Versions of attributes over days, and facts as of their day, against plain Python."""

import random

import pytest

from salesflow.operators import history
from tests.rows import FILLED, raw_rows

KEY, ATTRIBUTES = "countryid", ["country", "category"]


def rows_of(spark, rows):
    names = ("orderid", "countryid", "dateid", "country", "category")
    return raw_rows(spark, [{**FILLED, **dict(zip(names, r, strict=True))} for r in rows])


def generated(seed, n=400):
    rng = random.Random(seed)
    return [
        (i, rng.choice([1, 2, 3, None]), rng.choice([*range(12), None]), rng.choice(["a", "b", None]), rng.choice("xy"))
        for i in rng.sample(range(5 * n), n)
    ]


def plain_versions(rows):
    first = {}
    for order, key, day, *values in sorted(rows, key=lambda r: r[0]):
        if key is not None and day is not None:
            first.setdefault((key, day), tuple(values))
    found = []
    for key in sorted({k for k, _ in first}):
        last = ()
        for day in sorted(d for k, d in first if k == key):
            if first[key, day] != last:
                found.append([key, *first[key, day], day, None])
                if last:
                    found[-2][-1] = day
                last = first[key, day]
    return [tuple(v) for v in found]


def plain_as_of(rows, versions):
    for order, key, day, *_ in rows:
        valid = [
            v for v in versions if v[0] == key and day is not None and v[-2] <= day and (v[-1] is None or day < v[-1])
        ]
        yield (order, key, day, *(valid[0][1:-2] if valid else (None, None)))


def collected(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect() if columns else df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_versions_of_random_rows(spark, seed):
    rows = generated(seed)
    seen = history.observed(rows_of(spark, rows), KEY, ATTRIBUTES)
    assert collected(history.versions(seen, KEY, ATTRIBUTES)) == sorted(plain_versions(rows), key=str)


def test_parts_merge_in_any_order(spark):
    rows = generated(5)
    parts = [history.observed(rows_of(spark, rows[i::3]), KEY, ATTRIBUTES) for i in range(3)]
    whole = collected(history.observed(rows_of(spark, rows), KEY, ATTRIBUTES))
    for order in ([0, 1, 2], [2, 0, 1]):
        seen = parts[order[0]]
        for i in order[1:]:
            seen = history.merged(seen, parts[i], KEY, ATTRIBUTES)
        assert collected(seen) == whole
    again = history.merged(seen, parts[1], KEY, ATTRIBUTES)
    assert collected(again) == whole


def test_late_rows_split_a_version(spark):
    rows = [(1, 1, 10, "a", "x"), (2, 1, 30, "a", "x")]
    seen = history.observed(rows_of(spark, rows), KEY, ATTRIBUTES)
    assert collected(history.versions(seen, KEY, ATTRIBUTES)) == [(1, "a", "x", 10, None)]
    late = history.observed(rows_of(spark, [(3, 1, 20, "b", "x"), (4, 1, 30, "c", "x")]), KEY, ATTRIBUTES)
    seen = history.merged(seen, late, KEY, ATTRIBUTES)
    assert collected(history.versions(seen, KEY, ATTRIBUTES)) == [
        (1, "a", "x", 10, 20), (1, "a", "x", 30, None), (1, "b", "x", 20, 30),
    ]


def test_facts_as_of_their_day(spark):
    rows = generated(7)
    facts = rows_of(spark, rows).select("orderid", "countryid", "dateid")
    some = [r for r in rows if r[2] is None or r[2] > 2]  # no version for the first days
    seen = history.observed(rows_of(spark, some), KEY, ATTRIBUTES)
    found = history.as_of(facts, history.versions(seen, KEY, ATTRIBUTES), KEY, ATTRIBUTES)
    assert found.columns == ["orderid", "countryid", "dateid", *ATTRIBUTES]
    assert collected(found) == sorted(plain_as_of(rows, plain_versions(some)), key=str)


def test_no_rows(spark):
    seen = history.observed(rows_of(spark, []), KEY, ATTRIBUTES)
    versions = history.versions(seen, KEY, ATTRIBUTES)
    assert collected(versions) == []
    facts = rows_of(spark, [(1, 1, 1, "a", "x")]).select("orderid", "countryid", "dateid")
    assert collected(history.as_of(facts, versions, KEY, ATTRIBUTES)) == [(1, 1, 1, None, None)]
