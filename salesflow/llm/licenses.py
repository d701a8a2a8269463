"""Licence scan by canonical digests, in built-in column functions.

Texts are normalised in case, punctuation, comment marks, copyright statements and equivalent
spellings, so that copies of a licence that differ only there have one digest; all other words, of any
script, belong to the text. Whole texts are hash-joined to known digests.
Lines that say under which licence a text is are looked up in the same way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm.license_texts import DIGESTS, NOTICES, SPELLINGS, TEXTS
from salesflow.llm.tables import id_and_text, rows_of

# Marks that may stand before a line's first word, such as those of comments.
_MARKS = r"(?:^|\n)[^\p{L}\p{N}\n©(]*"
# A copyright statement: a mark or the word, a year (or both marks), and a holder to the end of the line
# or of the sentence; a point inside a number or after a usual abbreviation ends none. In lower case.
_YEAR = r"[<\[{]?(?:[0-9]{4}|yyyy|year)"
COPYRIGHT = (
    _MARKS
    + rf"(?:(?:copyright|\(c\)|©)[ \t:,]*{_YEAR}|copyright[ \t]*(?:\(c\)|©)|(?:\(c\)|©)[ \t]*copyright)"
    + r"(?:(?:inc|ltd|co|corp|llc|gmbh|jr|dr|al)\.|[.!?][^\s]|[^\n.!?]){0,300}[.!?]?"
)
RIGHTS = _MARKS + r"all rights reserved[.!]?"
# Words are letters, their marks and digits of any script.
NO_WORD = r"[^\p{L}\p{M}\p{N}]+"
# Every known notice has one of these words; other lines need no digest.
NOTICE_WORD = "licen|released"
assert all(any(w in notice.lower() for w in NOTICE_WORD.split("|")) for _, notice in NOTICES)


def canonical(text: Column) -> Column:
    """The words of a text that matter for telling licences apart: all but copyright statements."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT, "\n"), RIGHTS, "\n")
    words = F.trim(F.regexp_replace(plain, NO_WORD, " "))
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, words)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known(spark: SparkSession, texts=TEXTS, ready=DIGESTS) -> DataFrame:
    """(license, digest) of the given texts and of digests made before: one row for each digest."""
    found = digests(rows_of(spark, "license string, text string", list(texts)))
    if not ready:
        return found
    more = rows_of(spark, "license string, digest string", list(ready))
    return found.unionByName(more).groupBy("digest").agg(F.min("license").alias("license"))


def digests(texts: DataFrame) -> DataFrame:
    """(license, digest) of a table (license, text): one row for each digest."""
    rows = texts.select("license", "text").filter(canonical(F.col("text")) != "")
    return rows.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license"))


def scanned(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """doc_id, canonical_sha256, license and notices for each row of documents.

    `license` is the licence whose text the whole document is, else NULL; `notices` lists the
    licences named by lines of their own, sorted, comma-joined, else empty. A text without words,
    NULL included, has the digest of the empty text and is no licence. Repeated rows are
    scanned alike. The known digests are a fixed few, so they are broadcast. A table (license, text)
    of other known texts takes their place, of any size.
    """
    spark = docs.sparkSession
    notices = known(spark, NOTICES, ()).collect()
    by_digest = F.create_map(*(F.lit(x) for r in notices for x in (r["digest"], r["license"])))
    lines = F.filter(
        F.split("text", "\n"), lambda line: F.lower(line).rlike(NOTICE_WORD)
    )
    named = F.filter(
        F.transform(lines, lambda line: F.element_at(by_digest, digest(line))), lambda n: n.isNotNull()
    )
    rows = id_and_text(docs).select(
        "doc_id",
        digest(F.col("text")).alias("canonical_sha256"),
        F.when(
            F.lower("text").rlike(NOTICE_WORD),
            F.array_join(F.sort_array(F.array_distinct(named)), ","),
        )
        .otherwise("")
        .alias("notices"),
    )
    whole = F.broadcast(known(spark)) if texts is None else digests(texts)
    return rows.join(whole.withColumnRenamed("digest", "canonical_sha256"), "canonical_sha256", "left").select(
        "doc_id", "canonical_sha256", "license", "notices"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    """The same form, made line by line: marks go first, then statements at the start of a line."""
    year = "[<\\[{]?([0-9]{4}|yyyy|year)"
    begin = f"((copyright|[(]c[)]|©)[ \\t:,]*{year}|copyright[ \\t]*([(]c[)]|©)|([(]c[)]|©)[ \\t]*copyright)"
    rest = "((inc|ltd|co|corp|llc|gmbh|jr|dr|al)[.]|[.!?][^ \\t\\n\\r\\f\\v]|[^.!?]){0,300}[.!?]?"
    line = "regexp_replace(line, '^[^\\p{L}\\p{N}©(]+', '')"
    line = f"regexp_replace({line}, '^{begin}{rest}', '')"
    line = f"regexp_replace({line}, '^[^\\p{{L}}\\p{{N}}©(]*all rights reserved[.!]?', '')"
    lines = f"list_transform(string_split(lower({text}), chr(10)), lambda line: {line})"
    words = f"list_filter(regexp_split_to_array(array_to_string({lines}, ' '), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda w: w <> '')"
    joined = f"array_to_string({words}, ' ')"
    return reduce(lambda t, pair: f"replace({t}, '{pair[0]}', '{pair[1]}')", SPELLINGS, joined)


def oracle_sql() -> str:
    def values(rows) -> str:
        return ", ".join(f"({_quoted(license)}, {_quoted(text)})" for license, text in rows)

    return f"""
with texts as (
  select digest, min(l) as license from (
    select sha256({_canonical_sql("t")}) as digest, l from (values {values(TEXTS)}) v(l, t)
    union all select t, l from (values {values(DIGESTS)}) v(l, t)) group by digest
), notices as (
  select sha256({_canonical_sql("t")}) as digest, min(l) as license
  from (values {values(NOTICES)}) v(l, t) group by 1
), docs as (select row_number() over () as n, doc_id, coalesce(text, '') as text from documents),
lines as (
  select n, unnest(string_split(text, chr(10))) as line from docs
), named as (
  select n, string_agg(distinct license, ',' order by license) as notices
  from lines join notices on notices.digest = sha256({_canonical_sql("line")})
  where regexp_matches(lower(line), '{NOTICE_WORD}') group by n
)
select doc_id, sha256({_canonical_sql("text")}) as canonical_sha256, license,
  coalesce(notices, '') as notices
from docs left join texts on digest = sha256({_canonical_sql("text")}) left join named on named.n = docs.n
"""
