"""Canonical digests of whole texts and notice lines."""

import hashlib
import re
import unicodedata
from pathlib import Path

import pytest

from salesflow.llm import licenses
from salesflow.llm.license_texts import DIGESTS, NOTICES, SPELLINGS, TEXTS

from .samples import documents, no_documents, odd_documents


def scanned(spark, texts):
    return [
        (r["license"], r["notices"])
        for r in licenses.scanned(documents(spark, texts)).orderBy("doc_id").collect()
    ]


def test_known_texts(spark):
    assert [name for name, _ in scanned(spark, [t for _, t in TEXTS])] == [n for n, _ in TEXTS]


@pytest.mark.parametrize(
    "change",
    [
        str.upper,
        lambda t: t.replace("\n", "  \r\n"),
        lambda t: "Copyright (c) 2024 Somebody Else\nAll rights reserved.\n\n" + t,
        lambda t: "© 2020 A\n(C) 2021 B\n" + t.replace('"', "“").replace(",", " ,"),
        lambda t: t.replace("license", "licence").replace("NONINFRINGEMENT", "NON-INFRINGEMENT"),
    ],
)
def test_equal_but_for_form(spark, change):
    assert [name for name, _ in scanned(spark, [change(t) for _, t in TEXTS])] == [n for n, _ in TEXTS]


MIT = TEXTS[0][1]


@pytest.mark.parametrize(
    "text",
    [
        "Copyright (c) 2020 A. " + MIT,
        "// Copyright 2019-2021 Foo Inc. All rights reserved.\n" + "\n".join(f"// {x}" for x in MIT.split("\n")),
        "/*\n" + "\n".join(f" * {x}" for x in ["Copyright (c) 2020 A", "", *MIT.split("\n")]) + "\n */",
        "# (c) Copyright Some GmbH. and others\n" + MIT.replace("\n", "\n# "),
        "Copyright (c) <year> <copyright holders>\n" + MIT,
        "Copyright [yyyy] [name of copyright owner]\n\n" + MIT,
    ],
)
def test_statements_and_comment_marks_play_no_part(spark, text):
    assert scanned(spark, [text, text.upper()]) == [("MIT", "")] * 2


@pytest.mark.parametrize(
    "text",
    [
        "Коммерческое использование запрещено.\n\n" + MIT,
        MIT + "\n只有中文",
        MIT + "\nΔεν επιτρέπεται",
        "Copyright (c) 2020 A. Commercial use is forbidden.\n" + MIT,
        "Copyright notice: no commercial use.\n" + MIT,
        "All rights reserved, and none are granted.\n" + MIT,
        "Copyright 2020 A",
        "只有中文",
    ],
)
def test_other_words_of_any_script_make_another_text(spark, text):
    assert scanned(spark, [text]) == [(None, "")]


def test_texts_without_words_alone_have_the_digest_of_none(spark):
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    rows = licenses.scanned(documents(spark, ["只有中文", "Только русский", "-- // !", "© 2020 Somebody"]))
    assert [r["canonical_sha256"] == empty for r in rows.orderBy("doc_id").collect()] == [False, False, True, True]


def test_digests_made_before(spark):
    assert dict(DIGESTS) and all(re.fullmatch("[0-9a-f]{64}", d) for _, d in DIGESTS)
    path = Path("/usr/share/common-licenses")
    kept = {"Apache-2.0": "Apache-2.0", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    there = {name: (path / file).read_text() for name, file in kept.items() if (path / file).exists()}
    if not there:
        pytest.skip("the texts are not on this machine")
    assert scanned(spark, list(there.values())) == [(name, n) for name, (_, n) in zip(there, scanned(spark, list(there.values())))]
    changed = [t.replace("\n", "\r\n  ").upper() for t in there.values()]
    assert [name for name, _ in scanned(spark, changed)] == list(there)


def canonical(text):
    """The canonical form, restated letter by letter."""
    kept = []
    for line in text.lower().split("\n"):
        line = line.lstrip("".join({c for c in line if not (c.isalpha() or c.isdigit() or c in "©(")}))
        kept.append(line)
    words = "".join(c if unicodedata.category(c)[0] in "LMN" else " " for c in " ".join(kept)).split()
    joined = " ".join(words)
    for old, new in SPELLINGS:
        joined = joined.replace(old, new)
    return joined


def test_canonical_form_restated(spark):
    texts = ["", "a-b_c D9 é!", "हिन्दी में — №5 ½", "ſtraße\tİ", *(t for _, t in TEXTS), *(t for _, t in NOTICES)]
    rows = licenses.scanned(documents(spark, texts)).orderBy("doc_id").collect()
    wanted = [hashlib.sha256(canonical(t).encode()).hexdigest() for t in texts]
    assert [r["canonical_sha256"] for r in rows] == wanted


def test_whole_texts_only(spark):
    mit = TEXTS[0][1]
    assert scanned(spark, [mit + " And more.", mit[:-20], "MIT"]) == [(None, "")] * 3


def test_other_known_texts(spark):
    own = [("Own-1.0", "You may do\nas you like."), ("Own-0", ""), ("Own-0", None)]
    texts = spark.createDataFrame(own, "license string, text string")
    docs = documents(spark, ["YOU MAY DO, as you like!", "You may not.", "", TEXTS[0][1]])
    rows = licenses.scanned(docs, texts).orderBy("doc_id").collect()
    assert [r["license"] for r in rows] == ["Own-1.0", None, None, None]


def test_notice_lines(spark):
    lines = [f"Some text.\n{line}\nMore." for _, line in NOTICES]
    assert [n for _, n in scanned(spark, lines)] == [n for n, _ in NOTICES]
    both = "released under the mit licence\n\nLICENSED UNDER CC-BY NC 4.0!!"
    within = "It was said to be Released under the MIT License. Or not."
    assert [n for _, n in scanned(spark, [both, within])] == ["CC-BY-NC-4.0,MIT", ""]


def test_odd_documents(spark):
    odd = odd_documents(spark)
    found = licenses.scanned(odd)
    assert found.columns == ["doc_id", "canonical_sha256", "license", "notices"]
    assert found.count() == odd.count()
    empty = {r["canonical_sha256"] for r in found.filter("doc_id in (3, 4, 5)").collect()}
    assert empty == {"e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"}
    assert licenses.scanned(no_documents(spark)).isEmpty()


def test_no_python_in_the_plan(spark, capsys):
    licenses.scanned(documents(spark, ["a"]).select("doc_id", "text")).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
