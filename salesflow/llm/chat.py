"""Conversations from reply trees, in built-in column functions.

A message answers its parent. Iterative self-joins double the known stretch of every message's way
to its root, which gives its depth and the score of the path so far in logarithmically many rounds;
the same stretches, taken from the longest to the shortest, enumerate the messages of a chosen path.
Branches are ranked by score, and each chosen path becomes one formatted conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesflow.llm.spans import chunks_of, cut, let, running_sums
from salesflow.llm.tables import rows_of
from salesflow.sources.workspace import saved

# The template: <s>ROLE, a line break, TEXT</s> for each turn.
OPEN, CLOSE, BREAK = "<s>", "</s>", "\n"
LEARNT_ROLE = "assistant"
# Characters that control strings begin with, and what stands for them inside texts (fixed values).
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
_ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))


def escaped(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, pairs=ESCAPES) -> Column:
    """Undoes `escaped`: every backslash in its result begins a code, so no two can be confused."""
    for plain, code in reversed(pairs):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def ways_up(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The depth and path score of each message, and the stretches of doubling length.

    `messages` has conv_id, node, parent and score, node being unique and not NULL within a
    conversation. A message without a parent, or whose parent is not there, is a root. Messages
    whose ways never reach a root, since their parents form a ring, are left out. Scores that are
    NULL count as 0.
    """
    nodes = messages.select("conv_id", "node")
    up = nodes.select(F.col("conv_id").alias("c"), F.col("node").alias("p"))
    linked = messages.join(
        up, messages["conv_id"].eqNullSafe(up["c"]) & (messages["parent"] == up["p"]), "left"
    )
    reach = saved(
        linked.select(
            "conv_id",
            "node",
            F.col("p").alias("up"),
            F.col("p").isNotNull().cast("long").alias("depth"),
            F.coalesce("score", F.lit(0.0)).cast("double").alias("total"),
        ),
        "replies",
    )
    stretches, before = [], None
    while True:
        pending = reach.filter(F.col("up").isNotNull())
        # While any message is on its way to a root, some arrive in each round: those whose
        # number is left at the end go round in rings.
        under_way = pending.count()
        if under_way in (0, before):
            break
        before = under_way
        stretches.append(pending.select("conv_id", "node", "up"))
        ahead = reach.select(
            F.col("conv_id").alias("c"),
            F.col("node").alias("n"),
            F.col("up").alias("next_up"),
            F.col("depth").alias("next_depth"),
            F.col("total").alias("next_total"),
        )
        # Only messages that are still on their way take part; the others are done.
        met = pending.join(
            ahead, pending["conv_id"].eqNullSafe(ahead["c"]) & (pending["up"] == ahead["n"])
        ).select(
            "conv_id",
            "node",
            F.col("next_up").alias("up"),
            (F.col("depth") + F.col("next_depth")).alias("depth"),
            (F.col("total") + F.col("next_total")).alias("total"),
        )
        reach = saved(reach.filter(F.col("up").isNull()).unionByName(met), "replies")
    return reach.filter(F.col("up").isNull()).select("conv_id", "node", "depth", "total"), stretches


def best_paths(messages: DataFrame, paths: int = 1) -> DataFrame:
    """conv_id, branch, depth, node: the messages of the best root-to-leaf paths.

    The score of a path is the sum over its messages. Branches are numbered from 1, the highest
    score first and the smaller leaf among equal ones. Only ids, depths and scores are joined here.
    """
    placed, stretches = ways_up(messages)
    placed = saved(placed, "placed")
    parents = messages.select(
        F.col("conv_id").alias("c"), F.col("parent").alias("p")
    ).filter(F.col("p").isNotNull()).distinct()
    leaves = placed.join(
        parents, placed["conv_id"].eqNullSafe(parents["c"]) & (placed["node"] == parents["p"]), "left_anti"
    )
    order = Window.partitionBy("conv_id").orderBy(F.desc("total"), "node")
    chosen = (
        leaves.withColumn("branch", F.row_number().over(order))
        .filter(F.col("branch") <= paths)
        .select("conv_id", "branch", "node")
    )
    for stretch in reversed(stretches):
        ups = stretch.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), "up")
        higher = chosen.join(
            ups, chosen["conv_id"].eqNullSafe(ups["c"]) & (chosen["node"] == ups["n"])
        ).select("conv_id", "branch", F.col("up").alias("node"))
        chosen = saved(chosen.unionByName(higher), "paths")
    depth = placed.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), "depth")
    return chosen.join(
        depth, chosen["conv_id"].eqNullSafe(depth["c"]) & (chosen["node"] == depth["n"])
    ).select("conv_id", "branch", "depth", "node")


def conversations(messages: DataFrame, paths: int = 1) -> DataFrame:
    """conv_id, branch, formatted and loss_spans for each of the best paths.

    `messages` has role and text besides what `ways_up` needs; NULL ones count as empty. The spans
    are the places (start, end) of the escaped assistant texts in `formatted`, in code points.
    A conversation is one text, so its messages come together in one row, however long it is.
    """
    # Read several times, most of them without the texts.
    messages = saved(messages.select("conv_id", "node", "parent", "score", "role", "text"), "messages")
    chosen = best_paths(messages, paths)
    texts = messages.select(
        F.col("conv_id").alias("c"),
        F.col("node").alias("n"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = (
        chosen.join(texts, chosen["conv_id"].eqNullSafe(texts["c"]) & (chosen["node"] == texts["n"]))
        .groupBy("conv_id", "branch")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    )

    def part(turn: Column) -> Column:
        return F.struct(
            F.concat(F.lit(OPEN), escaped(turn["role"], _ROLE_ESCAPES), F.lit(BREAK)).alias("head"),
            escaped(turn["text"]).alias("body"),
            (turn["role"] == LEARNT_ROLE).alias("learnt"),
        )

    def spans(parts: Column) -> Column:
        lengths = F.transform(
            parts,
            lambda p: (F.length(p["head"]) + F.length(p["body"]) + len(CLOSE)).cast("long"),
        )
        placed = F.zip_with(
            parts,
            running_sums(lengths),
            lambda p, end: F.struct(
                p["learnt"].alias("learnt"),
                (end - len(CLOSE) - F.length(p["body"])).alias("start"),
                (end - len(CLOSE)).alias("end"),
            ),
        )
        return F.transform(
            F.filter(placed, lambda p: p["learnt"]),
            lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")),
        )

    def written(parts: Column) -> Column:
        text = F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE)))
        return F.struct(F.array_join(text, "").alias("formatted"), spans(parts).alias("loss_spans"))

    result = let(F.transform("turns", part), written)
    return turns.select("conv_id", "branch", result.alias("r")).select("conv_id", "branch", "r.*")


def linear(rows: DataFrame) -> DataFrame:
    """Messages of conversations given turn by turn: each answers the one before.

    Rows are ordered by turn, role and text, so that repeated turns and NULLs have their places.
    Rows with a NULL conv_id are one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    numbered = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text"
    ).select("conv_id", node.alias("node"), "role", "text")
    return numbered.select(
        "conv_id",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"),
        "role",
        "text",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of the turns and the learnt text, from the formatted text alone."""

    def turn(part: Column) -> Column:
        def split(body: Column) -> Column:
            at = F.instr(body, BREAK)
            return F.concat(
                unescaped(body.substr(F.lit(1), at - 1), _ROLE_ESCAPES),
                F.lit("\n"),
                unescaped(body.substr(at + 1, F.length(body))),
                F.lit("\n"),
            )

        return let(part.substr(F.lit(len(OPEN) + 1), F.length(part)), split)

    def digests(parts: Column) -> Column:
        whole = F.array_join(F.transform(parts, turn), "")
        return F.struct(F.size(parts).cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"))

    text = F.col("formatted")
    parts = F.filter(F.split(text, CLOSE), lambda p: p != "")
    # Cut from parts of the text, so that a span costs the same wherever it lies.
    learnt = let(
        chunks_of(text),
        lambda chunks: F.array_join(
            F.transform("loss_spans", lambda s: unescaped(cut(chunks, s["start"], s["end"]))), ""
        ),
    )
    loss = let(
        learnt,
        lambda t: F.struct(F.length(t).cast("long").alias("loss_chars"), F.sha2(t, 256).alias("loss_sha256")),
    )
    return formatted.select(
        "conv_id",
        let(parts, digests).alias("turns"),
        loss.alias("loss"),
        F.length(text).cast("long").alias("formatted_chars"),
    ).select("conv_id", "turns.*", "loss.*", "formatted_chars")


# A conversation whose texts are made of control strings.
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def with_probe(rows: DataFrame) -> DataFrame:
    """The rows of conversations and, as one more, a conversation made of control strings."""
    probe = rows_of(
        rows.sparkSession,
        "conv_id long, turn long, role string, text string",
        [(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, LEARNT_ROLE, PROBE_TEXT)],
    )
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    ).unionByName(probe)


ORACLE_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), coded as (
  select *, replace(replace(replace(text, '\', '\e'), '<', '\l'), '[', '\b') as body,
    replace(replace(replace(replace(role, '\', '\e'), '<', '\l'), '[', '\b'), chr(10), '\n') as name
  from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(name) + length(body) + 8) as bigint) as formatted_chars
from coded group by conv_id
"""
