"""Positions of pattern matches in texts, with built-in column functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values whose running sums are built in one go; longer arrays are handled block by block.
_BLOCK = 256
# Characters of a part of a text that is cut at many places.
CHUNK = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan(values: Column, state: Column, step: Callable[[Column, Column], Column], output: Callable) -> Column:
    """`output(state, value)` for each value from left to right, the state being changed by `step`.

    Outputs are appended in blocks, so that a long array costs about as much for each value as a
    short one. States must not be arrays.
    """

    def block(carried: Column, part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(carried.alias("state"), F.transform(F.slice(part, 1, F.lit(0)), lambda v: output(carried, v)).alias("out")),
            lambda held, v: F.struct(
                step(held["state"], v).alias("state"),
                F.array_append(held["out"], output(held["state"], v)).alias("out"),
            ),
        )

    def over(all_values: Column) -> Column:
        nothing = F.transform(F.slice(all_values, 1, F.lit(0)), lambda v: output(state, v))
        starts = F.when(
            F.size(all_values) > 0, F.sequence(F.lit(1), F.size(all_values), F.lit(_BLOCK))
        ).otherwise(F.array().cast("array<int>"))
        return F.aggregate(
            starts,
            F.struct(state.alias("state"), F.slice(F.array(nothing), 1, F.lit(0)).alias("out")),
            lambda held, start: let(
                block(held["state"], F.slice(all_values, start, F.lit(_BLOCK))),
                lambda done: F.struct(
                    done["state"].alias("state"), F.array_append(held["out"], done["out"]).alias("out")
                ),
            ),
            lambda held: F.flatten(held["out"]),
        )

    return let(values, over)


def chunks_of(text: Column) -> Column:
    """A text in parts of `CHUNK` characters; only the last can be shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(chunks: Column, start: Column, end: Column) -> Column:
    """The characters from `start` to `end`, exclusive, of a text in chunks, without walking through all of it."""

    def part(number: Column) -> Column:
        return F.coalesce(F.get(chunks, number), F.lit(""))

    first, last = (F.floor(at / CHUNK).cast("int") for at in (start, end))
    from_, to = ((at % CHUNK).cast("int") for at in (start, end))
    return F.when(first == last, part(first).substr(from_ + 1, (end - start).cast("int"))).otherwise(
        F.concat(
            part(first).substr(from_ + 1, F.lit(CHUNK)),
            F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
            part(last).substr(F.lit(1), to),
        )
    )


def _sums(values: Column) -> Column:
    """The running sums of a short array, by appending."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<long>").alias("sums"))
    return F.aggregate(
        values,
        start,
        lambda state, v: F.struct(
            (state["total"] + v).alias("total"),
            F.array_append(state["sums"], state["total"] + v).alias("sums"),
        ),
        lambda state: state["sums"],
    )


def running_sums(values: Column) -> Column:
    """The running sums of an array of longs; appending in blocks keeps long arrays cheap."""

    def by_block(all_values: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_values) - 1) / _BLOCK).cast("int")),
            lambda b: _sums(F.slice(all_values, b * _BLOCK + 1, F.lit(_BLOCK))),
        )

        def joined(sums: Column) -> Column:
            totals = _sums(F.transform(sums, lambda block: F.element_at(block, -1)))
            return let(
                totals,
                lambda ends: F.flatten(
                    F.transform(
                        sums,
                        lambda block, i: F.transform(
                            block,
                            lambda v: v + F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(0)),
                        ),
                    )
                ),
            )

        return let(blocks, joined)

    return let(
        values,
        lambda v: F.when(F.size(v) == 0, F.array().cast("array<long>")).otherwise(by_block(v)),
    )


def matches(text: Column, pattern: str, before: int = 0) -> Column:
    """An array of (start, end, match, before) for each match, left to right.

    Positions count code points and ends are exclusive. `before` is up to so many characters
    between the previous match and this one. The pattern must not match the empty string.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def located(hits: Column) -> Column:
        def placed(gaps: Column) -> Column:
            steps = F.zip_with(
                F.slice(gaps, 1, F.size(hits)),
                hits,
                lambda gap, hit: (F.length(gap) + F.length(hit)).cast("long"),
            )
            pairs = F.zip_with(
                F.slice(gaps, 1, F.size(hits)),
                hits,
                lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")),
            )
            return F.zip_with(
                pairs,
                running_sums(steps),
                lambda pair, end: F.struct(
                    (end - F.length(pair["hit"])).alias("start"),
                    end.alias("end"),
                    pair["hit"].alias("match"),
                    F.right(pair["gap"], F.lit(before)).alias("before"),
                ),
            )

        return F.when(F.size(hits) > 0, let(F.split(text, pattern, -1), placed))

    empty = F.array().cast("array<struct<start:long,end:long,match:string,before:string>>")
    return F.coalesce(let(found, located), empty)
