"""Benchmark passages against plain five-word windows, and re-parameterised questions."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from salesflow.llm import decontam
from salesflow.llm.tables import table

from .samples import documents, no_documents, odd_documents, with_clashing, words

SF = "/root/testdata/sf0.01"
QUESTION = (
    "If James has 3 apples and gives 2 apples to Mary after 5 hours, how many apples does James keep "
    "in the red basket?"
)


def benchmark(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def held(spark, texts, items=(QUESTION,)):
    rows = decontam.contaminated(documents(spark, texts), benchmark(spark, items)).collect()
    return {(r["doc_id"], r["item_id"]): r["other_values"] for r in rows}


def test_given_documents_hold_what_plain_windows_find(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    split = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    of_item = {}
    for r in items.collect():
        w = split(r["text"])
        of_item[r["item_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    expected = set()
    for r in docs.collect():
        w = split(r["text"])
        windows = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        for item, own in of_item.items():
            if len(own & windows) >= 0.8 * len(own):
                expected.add((r["doc_id"], item))
    found = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()}
    assert found == expected
    kept = decontam.without_benchmark(docs, items)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {
        r["doc_id"] for r in docs.select("doc_id").collect()
    } - {d for d, _ in expected}


def test_other_values(spark):
    other = QUESTION.replace("James", "Peter").replace("Mary", "Anna").replace("3", "seven").replace("2", "41")
    texts = [
        QUESTION,
        f"{words(1, 20)} {other.upper()} {words(2, 20)}",
        other.replace("does Peter", "does Robert"),  # another name where the same one must be
        other.replace("hours", "minutes"),
        "If James has apples",
        words(3, 50),
    ]
    assert held(spark, texts) == {(0, 0): False, (1, 0): True, (3, 0): True}


def test_one_conflict_costs_only_its_windows(spark):
    w = words(11, 160).split()
    w[2] = w[80] = "1990"
    copy = [*w[:2], "1991", *w[3:]]
    bag = (
        "A bag holds 12 red marbles from the old shop and the other bag holds 30 blue marbles "
        "that the children found there"
    )
    both = "The first box weighs 3 stones while the second large box weighs three stones when it is empty"
    texts = [
        " ".join(copy),
        bag.replace("12", "14").replace("30", "14"),
        both.replace("3", "5").replace("three", "5"),
    ]
    rows = decontam.contaminated(documents(spark, texts), benchmark(spark, [" ".join(w), bag, both])).collect()
    found = {(r["doc_id"], r["item_id"]): (r["windows"], r["item_windows"]) for r in rows}
    assert found.keys() == {(0, 0), (1, 1), (2, 2)}
    assert found[0, 0] == (153, 156)
    assert found[1, 1][0] == found[1, 1][1] and found[2, 2][0] == found[2, 2][1]


def test_numbers_alone_are_no_evidence(spark):
    items = ["1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16", QUESTION]
    assert held(spark, ["21 22 23 24 25 26 27 28 29 30 31 32 33 34 35 36"], items) == {}


def test_number_heavy_and_short_items_are_found_verbatim(spark):
    items = [
        "What is 17 * 23 + 5 * 8 - 4?",
        "Compute 12 + 7, then 19 * 4, then 76 - 30, then 46 / 2.",
        "Compute 81 / 9",
        "Name the capital",
    ]
    changed = [re.sub("[0-9]+", lambda m: str(int(m[0]) + 1), t) for t in items[:3]]
    texts = [*items, *(f"{words(i, 30)} {t} {words(9 - i, 30)}" for i, t in enumerate(items)), *changed]
    texts += ["Compute 81", "Name a capital", words(5, 30)]
    # The two items of several operators are formulas as well, with other numbers too.
    wanted = {(i, i % 4): False for i in range(8)} | {(8, 0): True, (9, 1): True}
    assert held(spark, texts, items) == wanted
    row = decontam.contaminated(documents(spark, items[:1]), benchmark(spark, items[:1])).first()
    assert (row["windows"], row["item_windows"]) == (3, 3)


def test_arithmetic_with_other_numbers(spark):
    item = "What is 17 * 23 + 17 * 8 - 4?"
    same = "What is 18 * 29 + 18 * 9 - 5?"
    texts = [
        same,
        f"{words(1, 30)} 3 - 4 * 5 + {same} and 7 * 8 * 9 {words(2, 30)}",
        same.replace("+ 18", "+ 19"),  # one number became two
        same.replace("*", "/"),
        same.replace("What", "How"),
        "18 29 18 9 5 what is",
        "call 555-343-212-1 - 4",
    ]
    assert held(spark, texts, [item, "2 + 2"]) == {(0, 0): True, (1, 0): True}


def test_a_common_instruction_is_no_evidence(spark):
    stem = words(40, 18)
    items = [f"{stem} {words(100 + i, 2 + i % 9)}" for i in range(60)]
    texts = [f"{words(200 + i, 10)} {stem} {words(300 + i, 10)}" for i in range(40)]
    assert held(spark, [*texts, stem, *items], items) == {(41 + i, i): False for i in range(60)}


def test_a_family_of_items_with_one_template_is_found(spark):
    items = [QUESTION.replace("3", str(100 + i)).replace("James", "Tom") for i in range(15)]
    found = held(spark, [QUESTION, items[4], words(1, 30)], items)
    assert found == {(0, i): True for i in range(15)} | {(1, i): i != 4 for i in range(15)}


def terms_of(text):
    return re.findall(r"[0-9]+|[a-z]+", text)


def windows_of(text):
    """(key, slots, telling) of each window: the template if three words are letters, else all words."""
    w = terms_of(text)
    for i in range(len(w) - 4):
        part = w[i : i + 5]
        telling = sum(x.isalpha() for x in part) >= 3
        key = tuple("<1>" if x.isdigit() and telling else x for x in part)
        yield (telling, key), [x for x in part if x.isdigit()], telling


def plain_finding(text, item, owners):
    """Whether a text holds an item, by the rule as the module states it, and whether values were changed."""
    theirs, own = list(windows_of(text)), list(windows_of(item))
    mine = [len(owners[k]) <= decontam.COMMON_ITEMS for k, _, _ in own]
    mine = mine if any(mine) else [True] * len(own)
    found, best, changed = set(), 0, False
    for shift in range(-len(own), len(theirs)):
        met = {
            i: list(zip(slots, theirs[i + shift][1]))
            for i, (key, slots, _) in enumerate(own)
            if 0 <= i + shift < len(theirs) and theirs[i + shift][0] == key
        }
        values = {}
        for pairs in met.values():
            for a, b in pairs:
                values.setdefault(a, set()).add(b)
        torn = {a for a, b in values.items() if len(b) > 1}
        met = {i: p for i, p in met.items() if all(a == b or a not in torn for a, b in p)}
        places = [i for i in met if mine[i]]
        kept = sum(all(a == b for a, b in met[i]) for i in places)
        run = longest = 0
        for i in range(len(own)):
            run = run + 1 if i in places else 0
            longest = max(longest, run)
        best = max(best, max(kept, longest) if torn else len(places))
        found |= set(met)
        changed |= bool(met) and any(a != b for a, bs in values.items() for b in bs)
    share = lambda places: sum(i in found for i in places) >= 0.8 * len(places)
    all_, tells = range(len(own)), [i for i in range(len(own)) if own[i][2]]
    enough = share(all_) and share([i for i in all_ if mine[i]])
    enough |= bool(tells) and share(tells) and share([i for i in tells if mine[i]])
    return (enough and bool(found)) or best >= decontam.ALIGNED_WINDOWS, changed


def test_findings_against_the_whole_rule(spark):
    rng = random.Random(8)
    vocabulary = [f"word{a}{b}" for a in "abcdefgh" for b in "ijklmnop"]
    some = lambda n: [rng.choice(vocabulary) if rng.random() < 0.75 else str(rng.randint(1, 9)) for _ in range(n)]
    stem = some(12)
    items = [some(rng.randint(5, 30)) for _ in range(25)] + [stem + some(rng.randint(1, 12)) for _ in range(14)]
    texts = []
    for _ in range(150):
        item = rng.choice(items)
        start = rng.randint(0, max(0, len(item) - 8)) if rng.random() < 0.4 else 0
        part = item[start : rng.choice([len(item), len(item), start + 13])]
        mapped = {str(n): str(rng.randint(1, 9)) for n in range(10)} if rng.random() < 0.5 else {}
        part = [mapped.get(x, x) for x in part]
        for _ in range(rng.choice([0, 0, 1, 2])):
            part[rng.randrange(len(part))] = str(rng.randint(1, 9))
        texts.append(" ".join([*some(rng.randint(0, 12)), *part, *some(rng.randint(0, 12))]))
    items = [" ".join(x) for x in items]
    owners = {}
    for item in set(items):
        for key, _, _ in windows_of(item):
            owners.setdefault(key, set()).add(item)
    expected = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            finding, changed = plain_finding(text, item, owners)
            if finding:
                expected[d, i] = changed
    assert 60 < len(expected) < 1000
    assert held(spark, texts, items) == expected


def test_windows_of_numbers_cost_a_changed_item_nothing(spark):
    item = "A large old wooden box weighs 12 kg and 14 kg with 3 5 7 cm sides"
    text = re.sub("[0-9]+", lambda m: str(int(m[0]) + 100), item)
    assert held(spark, [item, text], [item]) == {(0, 0): False, (1, 0): True}


def test_names_that_are_not_listed_and_numbers_of_several_words(spark):
    arjun = (
        "Arjun has 12 small marbles in the box. Arjun gives Meera 5 of them. How many marbles does Arjun "
        "still have?"
    )
    train = (
        "The train carries twenty-five boxes, and every box weighs one hundred and five kg, so the whole "
        "load is heavy"
    )
    kofi = arjun.replace("Arjun", "Kofi").replace("Meera", "Ines").replace("12", "9")
    texts = [
        kofi,
        f"{words(1, 20)}. {kofi} {words(2, 20)}",
        arjun.lower(),
        kofi.replace("does Kofi", "does Wanjiru").replace("How many", "What"),
        train.replace("twenty-five", "25").replace("one hundred and five", "105"),
        train.replace("twenty-five", "1,200").replace("one hundred and five", "7"),
        train.upper(),
    ]
    assert held(spark, texts, [arjun, train]) == {
        (0, 0): True, (1, 0): True, (2, 0): False, (4, 1): False, (5, 1): True, (6, 1): False
    }


def test_values_of_numbers():
    for said, value in {
        "twenty five": "25", "one hundred and five": "105", "five million": "5000000", "two dozen": "24",
        "3 thousand two hundred": "3200", "5,000": "5000", "3.5": "3.5", "3.5 million": "3.5 million",
        "hundred": "100", "half": "half",
    }.items():
        assert decontam._value(said.split()) == value
    templates = decontam.Templates(5)
    said = lambda text: [[r.word(i) for i in range(len(r.kinds))] for r in templates.readings(text)]
    assert said("one two three and four")[1] == ["1", "2", "3", "and", "4"]
    assert said("a hundred and many")[1] == ["a", "100", "and", "many"]
    assert said("a hundred. Five")[1] == ["a", "100", "5"]
    assert said("") == [[]] and len(said("no capitals. None")) == 1


def test_part_of_an_item(spark):
    item = words(9, 40)
    w = item.split()
    texts = [" ".join(w[:12]), " ".join(w[10:25]), " ".join([*w[:20], "inserted", *w[20:]])]
    # 8 windows, 11 windows in one alignment, 32 of 36 windows in two
    assert set(held(spark, texts, [item])) == {(1, 0), (2, 0)}


def test_windows_outside_the_map_are_dropped_by_the_join(spark, monkeypatch):
    monkeypatch.setattr(decontam, "MAP_BITS", 64)
    texts = [words(i, 60) for i in range(20)] + [QUESTION]
    assert held(spark, texts) == {(20, 0): False}


def test_copies_of_one_passage_are_one_finding(spark):
    docs = documents(spark, [QUESTION] * 300 + [f"{QUESTION} {QUESTION}"])
    rows = decontam.contaminated(docs, benchmark(spark, [QUESTION, QUESTION])).collect()
    assert Counter(r["item_id"] for r in rows) == {0: 301, 1: 301}
    assert {r["windows"] for r in rows} == {r["item_windows"] for r in rows}


def test_odd_documents_and_items(spark):
    odd = odd_documents(spark)
    items = with_clashing(benchmark(spark, [None, "", "too short", words(1, 40)]))
    items = items.unionByName(items.withColumn("item_id", F.lit(None).cast("long")))
    found = decontam.contaminated(odd, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 3), (2, 3), (1, None), (2, None)}
    kept = decontam.without_benchmark(odd, items)
    assert kept.columns == odd.columns
    assert kept.count() == odd.count() - 3
    assert decontam.contaminated(no_documents(spark), items).isEmpty()
    assert decontam.without_benchmark(odd, items.limit(0)).count() == odd.count()
