"""Spelling variants: words one edit apart, found on sorted rotations.

A word of L letters is marked with a terminator and written in its L + 1 rotations. Turning it so
that letter i comes last puts an edit at that letter behind the prefix of all the others: words that
differ in this letter share the prefix, and the word without the letter has it as a whole rotation.
Rotations sorted by prefix therefore lie in groups of neighbours, one edited letter each, and a group
has no more members than the alphabet has letters. One scan of a group tells each member how many
neighbours it has there and which one is the most frequent, without writing the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.sql_parts import crc32_sql
from salesflow.llm.tables import id_and_text
from salesflow.sources.workspace import saved

LEAST_LETTERS = 6
LEAST_OCCURRENCES = 5
# How much more frequent a word must be to stand as the form of another one.
FORM_RATIO = 5
# One run of letters in so many loses a letter, in the query's table of words.
DAMAGED_SHARE = 199
TERMINATOR = "$"
# Different words that a worker counts before it hands them on.
_COUNTED = 200_000
_WORDS = "word string, n long"


def lowered(text: str) -> str:
    """A-Z in lower case, all other letters as they are."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def damaged(run: str, salt: int, share: int) -> str:
    """The run, or for one in `share` of (salt, run) the run without one of its letters."""
    h = zlib.crc32(run.encode(), salt)
    if h % share:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _word_counts(least: int, share: int | None):
    # Runs that are too short already cannot be words; greedy, so that a match is a maximal run.
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def batch_of(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )

    def counted(batches):
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = runs.findall(lowered(text.as_py()))
                if share is None:
                    total.update(found)
                else:
                    salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for run, n in Counter(found).items():
                        total[damaged(run, salt, share)] += n
                if len(total) >= _COUNTED:
                    yield batch_of(total)
                    total = Counter()
        if total:
            yield batch_of(total)

    return counted


def word_counts(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least: int = LEAST_OCCURRENCES,
    damaged_share: int | None = None,
) -> DataFrame:
    """(word, n): the runs of letters of all whole texts, in lower case, and how often each occurs.

    Letters are A-Z, a-z and U+00C0 to U+00FF; only A-Z are lowered. Words of fewer than
    `least_letters` letters or `least` occurrences are left out. With `damaged_share`, one run in so
    many loses a letter, by the crc32 of `<doc_id>:<run>` (a NULL doc_id counts as empty). NULL and
    empty texts have no words; repeated rows count each; an empty table gives an empty one.
    Words are counted per worker first, so that a frequent one is a few rows.
    """
    counted = id_and_text(docs).mapInArrow(_word_counts(least_letters, damaged_share), _WORDS)
    return (
        counted.filter(F.length("word") >= least_letters)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
    )


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, edited, indel): the rotations of every word, 2 L + 1 narrow rows.

    A rotation whose last letter is skipped is `edited`; the whole ones are not. Of several equal
    letters in a row, dropping any gives the same word, so only the first one is an `indel`.
    """
    length = F.length("word")
    marked = F.concat("word", F.lit(TERMINATOR))

    def letter(at: Column) -> Column:
        return F.substr("word", at, F.lit(1))

    def turned(at: Column, skipped: int) -> Column:
        return F.concat(
            F.substr(marked, at + skipped, length + 1), F.substr("word", F.lit(1), at - 1)
        )

    edited = F.transform(
        F.sequence(F.lit(1), length),
        lambda at: F.struct(
            turned(at, 1).alias("prefix"),
            F.lit(True).alias("edited"),
            ((at == 1) | (letter(at) != letter(at - 1))).alias("indel"),
        ),
    )
    whole = F.transform(
        F.sequence(F.lit(1), length + 1),
        lambda at: F.struct(
            turned(at, 0).alias("prefix"), F.lit(False).alias("edited"), F.lit(False).alias("indel")
        ),
    )
    return words.select("word", "n", F.explode(F.concat(edited, whole)).alias("r")).select(
        "r.prefix", "word", "n", "r.edited", "r.indel"
    )


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): the near words' number and the most frequent one.

    Words without a near word are left out. Every pair of near words meets in exactly one group;
    a group is what differs in one letter, so it is no larger than the alphabet plus one.
    """
    order = Window.partitionBy("prefix").orderBy(F.desc("n"), "word")
    group = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Sorted ascending, the most frequent word comes first, and among equals the smallest.
    own = F.struct((-F.col("n")).alias("minus_n"), "word")
    edited = F.when(F.col("edited"), own)
    scanned = rotations(words).select(
        "word",
        "edited",
        "indel",
        F.count_if("edited").over(group).alias("replaced"),
        F.count_if("indel").over(group).alias("longer"),
        F.first(edited, ignorenulls=True).over(group).alias("first"),
        F.nth_value(edited, 2, ignoreNulls=True).over(group).alias("second"),
        F.first(F.when(F.col("indel"), own), ignorenulls=True).over(group).alias("first_longer"),
        F.first(F.when(~F.col("edited"), own), ignorenulls=True).over(group).alias("shorter"),
    )
    other = F.when(F.col("first.word") == F.col("word"), F.col("second")).otherwise(F.col("first"))
    shorter = F.when(F.col("indel"), F.col("shorter"))
    near = scanned.select(
        "word",
        F.when(F.col("edited"), F.col("replaced") - 1 + shorter.isNotNull().cast("long"))
        .otherwise(F.col("longer"))
        .alias("near"),
        F.when(F.col("edited"), F.least(other, shorter)).otherwise(F.col("first_longer")).alias("best"),
    ).filter("near > 0")
    return near.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")).select(
        "word", "n_near", (-F.col("best.minus_n")).alias("best_n"), F.col("best.word").alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form, by doubling: each round follows twice as many forms.

    Frequencies grow by `FORM_RATIO` with each form, so that there are no rings and few rounds.
    """
    paths = saved(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = paths.join(onward, "root", "left")
        paths = saved(
            followed.select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "paths",
        )
        if paths.filter("moved").isEmpty():
            return paths.select("word", "root")
        paths = paths.select("word", "root")


def variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of (word, n); words must be distinct.

    The form is the near word (one letter inserted, deleted or replaced) of largest n, of equal ones
    the first in code-point order, if that n is at least `ratio` times the word's; root is the last
    form that can be followed to, the word itself without any. A NULL word is left out; the
    terminator must not occur in words; an empty table gives an empty one.
    """
    words = words.filter(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n"))
    best = F.col("best_n") >= ratio * F.col("n")
    formed = saved(
        words.join(neighbours(words), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(best, F.col("best")).alias("form"),
            F.when(best, F.col("best_n")).alias("form_n"),
        ),
        "formed",
    )
    return formed.join(_roots(formed.filter("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variant_groups(docs: DataFrame, damaged_share: int | None = None) -> DataFrame:
    """The spelling variants among the words of documents; see `word_counts` and `variants`."""
    return variants(saved(word_counts(docs, damaged_share=damaged_share), "words"))


# An independent way to the same rows: words meet on what is left after deleting a letter.
ORACLE_SQL = f"""
with recursive runs as (
  select doc_id, run, count(*) as k from (
    select doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) as run from documents)
  where length(run) >= {LEAST_LETTERS} group by all),
hashed as (
  select run, k, {crc32_sql("h")} as c
  from (select *, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as h from runs)),
words as (
  select word, sum(k)::bigint as n from (
    select k, case when c % {DAMAGED_SHARE} = 0
      then substr(run, 1, (c % length(run))::bigint) || substr(run, (c % length(run))::bigint + 2)
      else run end as word from hashed)
  where length(word) >= {LEAST_LETTERS} group by word having sum(k) >= {LEAST_OCCURRENCES}),
shorter as (
  select distinct word, n, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as pos from words)),
near as (
  select a.word, b.word as other, b.n as other_n from shorter a join shorter b
    on a.rest = b.rest and a.pos = b.pos and a.word <> b.word
  union select a.word, b.word, b.n from shorter a join words b on a.rest = b.word
  union select b.word, a.word, a.n from shorter a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near,
    min(struct_pack(minus := -other_n, other := other)) as top from near group by word),
formed as (
  select w.word, w.n, coalesce(b.n_near, 0)::bigint as n_near,
    case when -b.top.minus >= {FORM_RATIO} * w.n then b.top.other end as form,
    case when -b.top.minus >= {FORM_RATIO} * w.n then -b.top.minus end as form_n
  from words w left join best b on w.word = b.word),
walk as (
  select word, word as last from formed
  union all select walk.word, formed.form from walk join formed on walk.last = formed.word
  where formed.form is not null),
ends as (
  select walk.word, walk.last from walk join formed on walk.last = formed.word
  where formed.form is null)
select f.word, f.form, e.last as root, f.n, f.n_near, f.form_n
from formed f join ends e on f.word = e.word
"""
