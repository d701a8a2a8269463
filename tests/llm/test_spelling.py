"""Words, their neighbours and forms against all pairs."""

import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from salesflow.llm import spelling

from .samples import documents, no_documents, odd_documents, with_clashing


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows, share=None, letters=6, least=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if share and h % share == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= letters and n >= least}


def plain_variants(words):
    forms, found = {}, []
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None
    for w, form in forms.items():
        root = w
        while forms[root]:
            root = forms[root]
        found.append((w, form, root, words[w], len(near[w]), words[form] if form else None))
    return sorted(found)


def collected(df):
    return sorted(map(tuple, df.collect()))


def check(spark, words):
    given = spark.createDataFrame(list(words.items()), "word string, n long")
    assert collected(spelling.variants(given)) == plain_variants(words)


def test_edits_of_every_kind(spark):
    words = {
        "letter": 600, "leter": 100, "lettter": 100, "lettteré": 20, "lettar": 3, "lattar": 1,
        "bbbbbb": 9, "bbbbbbb": 50, "bbbbbbbb": 300, "banana": 7, "anana": 35, "bananan": 35, "bannana": 35,
        "étéété": 5, "étééte": 25, "zzzzzz": 1,
    }
    check(spark, words)


def test_random_words_over_a_small_alphabet(spark):
    state, words = 7, {}
    for _ in range(400):
        state = state * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
        length = 3 + (state >> 33) % 4
        words["".join("abÿc"[(state >> (35 + 3 * i)) % 4] for i in range(length))] = 1 + (state >> 50) % 3000
    check(spark, words)


def test_rings_of_equal_letters_meet_once(spark):
    given = spark.createDataFrame([("aaaaaa", 5), ("aaaaa", 5)], "word string, n long")
    assert collected(spelling.neighbours(given)) == [("aaaaa", 1, 5, "aaaaaa"), ("aaaaaa", 1, 5, "aaaaa")]


def test_no_group_is_larger_than_the_alphabet(spark):
    letters = "abcdefghij"
    given = spark.createDataFrame([(a + "xxxxxx" + b, 5) for a in letters for b in letters], "word string, n long")
    groups = spelling.rotations(given).groupBy("prefix").count()
    assert groups.agg(F.max("count")).first()[0] == len(letters)


def test_words_of_documents(spark):
    texts = ["Variant variants VARIANT, Àÿ×÷êë İvariant " * 3, None, "", "variamt " * 9, "short " * 9]
    rows = [*enumerate(texts), (None, "variant nameless " * 60), (0, texts[0]), (9, "variant " * 400)]
    docs = with_clashing(documents(spark, [t for _, t in rows], [i for i, _ in rows]))
    for share in (None, 2, 199):
        words = plain_words(rows, share)
        assert collected(spelling.word_counts(docs, damaged_share=share)) == sorted(words.items())
        assert collected(spelling.variant_groups(docs, share)) == plain_variants(words)


def test_workers_hand_on_before_they_hold_too_much(spark, monkeypatch):
    rows = [(i, f"wordnumber{'abcdefg'[i % 7]} other") for i in range(70)]
    docs = documents(spark, [t for _, t in rows])
    monkeypatch.setattr(spelling, "_COUNTED", 2)
    assert collected(spelling.word_counts(docs)) == sorted(plain_words(rows).items())


def test_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert collected(spelling.variant_groups(odd, 199)) == plain_variants(plain_words(rows, 199))
    assert spelling.variant_groups(no_documents(spark)).collect() == []
    nothing = spark.createDataFrame([(None, 4)], "word string, n long")
    assert spelling.variants(nothing).collect() == []
