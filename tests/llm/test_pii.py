"""Base spans against Python's patterns; further spans and masking on given sentences."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from salesflow.llm import pii, spans
from salesflow.llm.tables import table

from .samples import SF, documents, no_documents, odd_documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HARD = [
    "a@b.c_d@e.fg x",
    "a@b.cd@e.fg",
    "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.255",
    "+1 (234) 567-8901+44 20 7946 0958 +1((((((2",
    "4111 1111 1111 1111 4111-1111-1111-1111 12",
    "4111111111111111 4111-1111 1111-1111, 4111111111111112 x",
    "é😀 x@y.zz 😀 4111111111111111😀 10.0.0.1",
    " +12345678 +1234567 +1234567890123456",
    ".@a.b @a.b a@.b a@b. a@b..c",
    "a.b%" * 2000 + "@x.y",
    "10.0.0.1 " * 1000,
    "+" * 2000 + "1 2 3 4 5 6 7 8",
    "",
    None,
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def base_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        if kind != "email" or "@" in (text or "")
        for m in re.finditer(pattern, text or "")
        if holds(kind, m.group())
    ]


def check(docs):
    key = lambda r: (str(r["doc_id"]), r["base_sha256"])
    expected = []
    for row in docs.select("doc_id", "text").collect():
        found = base_spans(row["text"])
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in found)
        counts = {f"n_{kind}": sum(k == kind for k, _, _ in found) for kind in PATTERNS}
        digest = hashlib.sha256(written.encode()).hexdigest()
        expected.append({"doc_id": row["doc_id"], "base_sha256": digest, "written": written, **counts})
    result = [r.asDict() for r in pii.personal_data(docs).collect()]
    for got, want in zip(sorted(result, key=key), sorted(expected, key=key), strict=True):
        assert set(filter(None, want.pop("written").split(","))) <= set(got["spans"].split(","))
        assert {k: got[k] for k in want} == want


def test_hard_texts(spark):
    check(documents(spark, HARD))


def test_given_documents(spark):
    check(table(spark, SF, "documents"))


def test_odd_documents(spark):
    check(odd_documents(spark))
    assert pii.personal_data(no_documents(spark)).isEmpty()


@pytest.mark.parametrize("count", [0, 1, 255, 256, 257, 1000])
def test_running_sums(spark, count):
    row = spark.range(1).select(
        spans.running_sums(F.lit(list(range(count))).cast("array<long>")).alias("s")
    )
    assert row.first()["s"] == [i * (i + 1) // 2 for i in range(count)]


@pytest.mark.parametrize("count", [0, 1, 255, 256, 257, 1000])
def test_scan(spark, count):
    values = [(7 * i) % 11 - 3 for i in range(count)]
    states = spans.scan(
        F.lit(values).cast("array<long>"), F.lit(5).cast("long"), lambda s, v: F.greatest(s, v) + 1, lambda s, v: s + v
    )
    state, expected = 5, []
    for v in values:
        expected.append(state + v)
        state = max(state, v) + 1
    assert spark.range(1).select(states.alias("s")).first()["s"] == expected


def test_cutting_a_text(spark):
    text = "é😀\nab" * 900
    places = [(0, 0), (0, 4500), (3, 1024), (1023, 1025), (1024, 2048), (2047, 4097), (4500, 4500), (4499, 4500)]
    for given, wanted in ((text, places), ("", [(0, 0)]), ("x", [(0, 1), (1, 1)])):
        chunks = spans.chunks_of(F.col("t"))
        found = F.array(*(spans.cut(chunks, F.lit(a).cast("long"), F.lit(b).cast("long")) for a, b in wanted))
        row = spark.createDataFrame([(given,)], "t string").select(found.alias("f")).first()
        assert row["f"] == [given[a:b] for a, b in wanted]


def test_spans_of_random_candidates(spark):
    """Base spans stay, the others if they touch neither those nor one taken that begins earlier."""
    rng = random.Random(5)
    model = pii.SpanClassifier((0.0,) * 5, (1.0, 0.0, 0.0, 0.0, 0.0, 0.0), 0.0)
    rows = []
    for size in [0, 1, 2, 5, 40, 700]:
        found = []
        for _ in range(size):
            start = rng.randrange(0, 6 * size)
            base, vote = rng.random() < 0.3, rng.choice([-1, 0, 1])
            found.append((rng.randrange(5), start, start + rng.randint(1, 9), base, vote, 0, 0, 0, 0, 0, 0))
        rows.append((size, found))
    fields = "kind:int,start:bigint,end:bigint,base:boolean,pattern:int,checksum:int,known:int,context:int,against:int,uniform:int,parted:int"
    given = spark.createDataFrame(rows, f"size int, found array<struct<{fields}>>")
    result = given.select("size", pii._all_spans(F.col("found"), model).alias("s")).collect()
    for (_, found), row in zip(rows, result, strict=True):
        taken = [s[:3] for s in found if s[3]]
        ends = 0
        for s in sorted((s for s in found if not s[3] and s[4] >= 0), key=lambda s: (s[1], s[0], s[2])):
            if s[1] >= ends and not any(a < s[2] and s[1] < b for k, a, b, base, *_ in found if base):
                taken.append(s[:3])
                ends = s[2]
        assert [tuple(s) for s in row["s"]] == sorted(taken)


def test_masking_of_very_many_spans(spark):
    line = "call 0151 234 5678 or a{}@b.cd, 10.0.0.{}\n"
    text = "".join(line.format(i, i % 256) for i in range(4000))
    (row,) = pii.masked(documents(spark, [text])).collect()
    wanted = re.sub(r"a[0-9]+@b\.cd", "[EMAIL]", re.sub(r"10\.0\.0\.[0-9]+", "[IP]", text))
    assert row["text"] in (wanted, wanted.replace("0151 234 5678", "[PHONE]"))


def test_labelers_are_weighed(spark):
    texts = [
        "call me, tel: (974) 555-3436 today",
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"',
        "john (at) mail (dot) com",
        "version 1234567890123456 page 12 of 2024",
        "Rindfleischetikettierungsueberwachungsaufgaben uebertragungsgesetz",
        "in 1984 there were 300 of 4000 left, 12 by 15",
    ]
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(documents(spark, texts)).collect()}
    assert found[0] == "phone:14:28"
    assert found[1].startswith("secret:9:")
    assert found[2] == "email:0:24"
    assert [found[i] for i in (3, 4, 5)] == ["", "", ""]


def test_spans_do_not_overlap(spark):
    for row in pii.personal_data(table(spark, SF, "documents")).collect():
        added = [tuple(s.split(":")) for s in row["spans"].split(",") if s.startswith("secret")]
        base = [tuple(s.split(":")) for s in row["spans"].split(",") if s and not s.startswith("secret")]
        for _, start, end in added:
            assert not any(int(s) < int(end) and int(start) < int(e) for _, s, e in base)


def test_estimates_follow_agreement():
    agree = (pii.PHONE, (1, 1, 1, 1, 0, 0), 50.0)
    deny = (pii.PHONE, (-1, -1, 0, 0, -1, 0), 50.0)
    belief = pii.estimate([agree, deny])
    assert belief[0] > 0.95 and belief[1] < 0.05
    assert pii.train([]).kinds == pii.train([]).kinds


def test_masking(spark):
    docs = documents(spark, ["é a@b.cd, 10.0.0.1!", "+1 (234) 567-8901", "nothing", None, "", "4111111111111111"])
    kept = {r["doc_id"]: r for r in pii.masked(docs).collect()}
    assert kept[0]["text"] == "é [EMAIL], [IP]!"
    assert kept[0]["n_chars"] == len(kept[0]["text"])
    assert [kept[i]["text"] for i in (1, 2, 3, 4, 5)] == ["[PHONE]", "nothing", None, "", "[CARD]"]
    assert pii.masked(docs).schema == docs.schema
    odd = odd_documents(spark)
    assert pii.masked(odd).columns == odd.columns
    assert pii.masked(odd).count() == odd.count()
    assert pii.masked(no_documents(spark)).isEmpty()


def test_overlapping_spans_are_masked_together(spark):
    text = "see 4111111111111111@mail.example.com, or not"
    (row,) = pii.masked(documents(spark, [text])).collect()
    assert row["text"] == "see [CARD], or not"


def test_no_python_in_the_plan(spark, capsys):
    pii.masked(table(spark, SF, "documents")).explain()
    pii.personal_data(table(spark, SF, "documents")).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
