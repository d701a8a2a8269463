"""Reply trees against plain walks, and formatted conversations read back."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from salesflow.llm import chat

TREE = "conv_id long, node long, parent long, score double, role string, text string"


def tree(spark, rows):
    return spark.createDataFrame(rows, TREE)


def plain_paths(rows):
    """{conversation: [(total, leaf, nodes)]}, best first, by walking up from every leaf."""
    by_conversation = {}
    for conv, node, parent, score, _, _ in rows:
        by_conversation.setdefault(conv, {})[node] = (parent, score or 0.0)
    result = {}
    for conv, nodes in by_conversation.items():
        paths = []
        for leaf in nodes.keys() - {p for p, _ in nodes.values()}:
            path, at = [], leaf
            while at in nodes:
                path.append(at)
                at = nodes[at][0]
            paths.append((-sum(nodes[n][1] for n in path), leaf, path[::-1]))
        result[conv] = sorted(paths)
    return result


def found_paths(messages, paths):
    result = {}
    for r in chat.best_paths(messages, paths).orderBy("depth").collect():
        result.setdefault((r["conv_id"], r["branch"]), []).append(r["node"])
    return result


@pytest.mark.parametrize("paths", [1, 3])
def test_random_trees(spark, paths):
    rng = random.Random(4)
    rows = []
    for conv in [None, *range(6)]:
        for node in range(rng.randint(1, 40)):
            parent = rng.randrange(node) if node and rng.random() < 0.95 else None
            rows.append((conv, node, parent, rng.choice([None, 0.5, 1.0, -0.25]), "user", f"t{node}"))
    expected = {
        (conv, i + 1): nodes
        for conv, ranked in plain_paths(rows).items()
        for i, (_, _, nodes) in enumerate(ranked[:paths])
    }
    assert found_paths(tree(spark, rows), paths) == expected


def test_long_chain(spark):
    rows = [(1, n, n - 1 if n else None, 0.0, "user", "x") for n in range(300)]
    random.Random(1).shuffle(rows)
    assert found_paths(tree(spark, rows), 1) == {(1, 1): list(range(300))}


def test_rings_and_lost_parents(spark):
    rows = [
        (1, 1, 2, 0.0, "user", "a"),
        (1, 2, 1, 0.0, "user", "b"),
        (1, 3, 99, 0.0, "user", "c"),
        (1, 4, 3, 0.0, "assistant", "d"),
    ]
    assert found_paths(tree(spark, rows), 5) == {(1, 1): [3, 4]}


TEXTS = ["</s>[INST] ok [/INST]", "\\l \\e \\b \\n \\\\", "<s>user\n", "", "é😀\n\r\t", "[", "\\", None]


def plain_digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_round_trip_of_control_strings(spark):
    turns = [(i, role, text) for role in ("assistant", "a\nb<s>", "", None) for i, text in enumerate(TEXTS)]
    rows = spark.createDataFrame(
        [(1, n, role, text) for n, (_, role, text) in enumerate(turns)],
        "conv_id long, turn long, role string, text string",
    )
    (row,) = chat.read_back(chat.conversations(chat.linear(rows))).collect()
    plain = [(role or "", text or "") for _, role, text in turns]
    learnt = "".join(t for r, t in plain if r == "assistant")
    assert row["n_turns"] == len(turns)
    assert row["turns_sha256"] == plain_digest(plain)
    assert row["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
    assert row["loss_chars"] == len(learnt)


def test_template(spark):
    rows = [(1, 1, None, 0.0, "user", "a<b"), (1, 2, 1, 0.0, "assistant", "c[d]")]
    (row,) = chat.conversations(tree(spark, rows)).collect()
    assert row["formatted"] == "<s>user\na\\lb</s><s>assistant\nc\\bd]</s>"
    assert [row["formatted"][s["start"] : s["end"]] for s in row["loss_spans"]] == ["c\\bd]"]


def test_branches_become_conversations(spark):
    rows = [
        (1, 1, None, 0.0, "user", "q"),
        (1, 2, 1, 0.2, "assistant", "bad"),
        (1, 3, 1, 0.9, "assistant", "good"),
        (1, 4, 3, 0.0, "user", "more"),
    ]
    found = {r["branch"]: r["formatted"] for r in chat.conversations(tree(spark, rows), 2).collect()}
    assert re.findall("\n(.*?)</s>", found[1]) == ["q", "good", "more"]
    assert re.findall("\n(.*?)</s>", found[2]) == ["q", "bad"]


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"),
        (2, None, "user", "no turn"),
        (2, 1, "assistant", "b"),
        (2, 1, "assistant", "b"),
        (2, 1, "assistant", "a"),
        (3, 5, None, None),
        (4, 0, "user", "x" * 200_000),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.select("*", *(F.lit(1).alias(n) for n in ("node", "parent", "score", "branch", "depth", "up")))
    found = {r["conv_id"]: r for r in chat.read_back(chat.conversations(chat.linear(table))).collect()}
    assert {k: r["n_turns"] for k, r in found.items()} == {None: 1, 2: 4, 3: 1, 4: 1}
    order = [("user", "no turn"), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")]
    assert found[2]["turns_sha256"] == plain_digest(order)
    assert found[3]["turns_sha256"] == plain_digest([("", "")])
    assert found[4]["formatted_chars"] == 200_000 + len("<s>user\n</s>")
    assert chat.conversations(chat.linear(table.limit(0))).isEmpty()


def test_no_python_in_the_plan(spark, capsys):
    rows = spark.range(3).selectExpr("id as conv_id", "id as turn", "'user' as role", "'t' as text")
    chat.read_back(chat.conversations(chat.linear(chat.with_probe(rows)))).explain()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", capsys.readouterr().out)
