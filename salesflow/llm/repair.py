"""Conversation structure repair by a run-length dynamic programme.

A conversation is a sequence of role/fault symbols, and its repair the cheapest way through four
states: nothing said, system, user or assistant spoke last. One symbol is a min-plus matrix between
these states, a run of equal symbols a power of it, made of cached binary powers. Matrices multiply in
any grouping, so a conversation may be cut anywhere: rows are sorted over all partitions, each
collapses its part of a conversation into runs (a piece), costs are carried back over the pieces,
and a walk forward unrolls the choices, the first of equally cheap ones in ASCII order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.sql_parts import crc32_sql
from salesflow.sources.workspace import saved

# The costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED_KEPT = 0, 2, 3, 2, 1
WHITE = " \t\n\x0b\f\r"
# Faults of a row, of which the first counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
ROLES = "sua"
_OTHER = len(ROLES)
# States: nothing, system, user or assistant spoke last. A conversation may end in the first or last.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_INSERTED = (_USER, _USER, _ASSISTANT, _USER)
_KEPT = {
    (_NOTHING, 0): _SYSTEM,
    **{(state, 1): _USER for state in (_NOTHING, _SYSTEM, _ASSISTANT)},
    (_USER, 2): _ASSISTANT,
}
_NEVER = 1 << 60
_STATES = range(4)
# What the rest costs by state when all rows are done: inserts until an assistant has spoken.
_END = (0, 2 * INSERT, INSERT, 0)
# Runs of a piece: bounds what a worker holds of one conversation.
PIECE_RUNS = 65_536
# Edits of runs up to this power of two are remembered.
_REMEMBERED = 8
_LAST_PIECE = (1 << 63) - 1

Matrix = tuple[tuple[int, ...], ...]
Costs = tuple[int, ...]


def symbol(role: int, fault: int) -> int:
    return 4 * role + fault


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + row[j] for x, row in zip(line, b, strict=True)) for j in _STATES) for line in a)


def _before(matrix: Matrix, after: Costs) -> Costs:
    """Costs in front of what the matrix stands for, from the costs behind it."""
    return tuple(min(x + y for x, y in zip(line, after, strict=True)) for line in matrix)


_UNCHANGED: Matrix = tuple(tuple(0 if p == q else _NEVER for q in _STATES) for p in _STATES)


def _choices(state: int, role: int, fault: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row, in ASCII order."""
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED_KEPT if fault == TRUNCATED else 0
    if (state, role) in _KEPT:
        yield "K", KEEP + more, _KEPT[state, role]
    yield "R", REROLE + more, _INSERTED[state]


@lru_cache(maxsize=None)
def power(row: int, k: int) -> Matrix:
    """The transition of 2^k rows of one symbol: inserts before each row, then its edit."""
    if k:
        half = power(row, k - 1)
        return _times(half, half)
    edits = [[_NEVER] * 4 for _ in _STATES]
    for state in _STATES:
        for _, cost, after in _choices(state, row // 4, row % 4):
            edits[state][after] = min(edits[state][after], cost)
    inserts = [[_NEVER] * 4 for _ in _STATES]
    for state in _STATES:
        at = state
        for count in range(3):  # more would come back to a state
            inserts[state][at] = min(inserts[state][at], count * INSERT)
            at = _INSERTED[at]
    return _times(tuple(map(tuple, inserts)), tuple(map(tuple, edits)))


def _bits(n: int) -> list[int]:
    return [k for k in range(n.bit_length()) if n >> k & 1]


def before_run(row: int, n: int, after: Costs) -> Costs:
    for k in _bits(n):
        after = _before(power(row, k), after)
    return after


def matrix_of(runs: list[tuple[int, int]]) -> Matrix:
    whole = _UNCHANGED
    for row, n in runs:
        for k in _bits(n):
            whole = _times(whole, power(row, k))
    return whole


def _one_row(row: int, state: int, after: Costs) -> tuple[str, int]:
    """The edits at one row, inserts before it included, and the state behind it."""
    here, letters = _before(power(row, 0), after), ""
    while True:
        edits = list(_choices(state, row // 4, row % 4))
        # In ASCII order an insert stands between D and the others.
        edits.insert(1, ("I", INSERT, _INSERTED[state]))
        for letter, cost, then in edits:
            if cost + (here if letter == "I" else after)[then] == here[state]:
                break
        letters, state = letters + letter, then
        if letter != "I":
            return letters, state


def _block(row: int, k: int, state: int, after: Costs) -> tuple[str, int]:
    if k == 0:
        return _one_row(row, state, after)
    unrolled = _remembered if k <= _REMEMBERED + 1 else _block
    first, state = unrolled(row, k - 1, state, _before(power(row, k - 1), after))
    second, state = unrolled(row, k - 1, state, after)
    return first + second, state


@lru_cache(maxsize=8192)
def _relative_block(row: int, k: int, state: int, after: Costs) -> tuple[str, int]:
    return _block(row, k, state, after)


def _remembered(row: int, k: int, state: int, after: Costs) -> tuple[str, int]:
    """Only differences between the costs decide, so that the same ones come again and again."""
    least = min(after)
    return _relative_block(row, k, state, tuple(min(x - least, _NEVER) for x in after))


def unroll(runs: list[tuple[int, int]], state: int, after: Costs) -> tuple[str, int]:
    """The edits of a piece that is entered in a state, and the state it is left in."""
    behind = [after]
    for row, n in reversed(runs):
        behind.append(before_run(row, n, behind[-1]))
    letters = []
    for (row, n), end in zip(runs, reversed(behind[:-1]), strict=True):
        left = n
        for k in reversed(_bits(n)):
            left -= 1 << k
            found, state = _remembered(row, k, state, before_run(row, left, end))
            letters.append(found)
    return "".join(letters), state


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with damage by crc32(`conv_id:turn`) % 20; dropped rows stay with no copies.

    0 drops a row, 1 empties its text, 2 removes its `.!?`, 3 repeats it, 4 makes its role user.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind < 2, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def lines_of(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text, copies) with equal ones added up, as a written table.

    Lines of one turn are ordered by role and digest of the text. A hot conversation is spread, since
    rows are dealt by all of turn, role and text.
    """
    added = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    return saved(added.withColumn("digest", F.unhex(F.sha2("text", 256))), "lines")


def _symbols(lines: DataFrame) -> DataFrame:
    """The lines without their text: conv_id, turn, role, digest, copies, kind, fault."""
    initial = F.substr("role", F.lit(1), F.lit(1))
    kind = F.when(initial == "", _OTHER).otherwise(F.instr(F.lit(ROLES), initial) - 1)
    trimmed = F.rtrim("text", F.lit(WHITE))
    looked = lines.select(
        "conv_id", "turn", "role", "digest", "copies",
        F.when(kind < 0, _OTHER).otherwise(kind).alias("kind"),
        F.when(trimmed == "", BLANK)
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND).alias("fault"),
    )
    # Few texts come back in a later turn, so normally this is a small table.
    again = (
        looked.filter((F.col("fault") != BLANK) & (F.col("copies") > 0))
        .groupBy("conv_id", "role", "digest")
        .agg(
            F.count(F.lit(1)).alias("turns"),
            F.min("turn").alias("first_turn"),
            F.max(F.col("turn").isNull()).alias("without_turn"),
        )
        .filter("turns > 1")
        .select(F.struct("conv_id", "role", "digest").alias("k"), "first_turn", "without_turn")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("k.conv_id"))
        & (F.col("role") == F.col("k.role"))
        & (F.col("digest") == F.col("k.digest"))
        & (F.col("fault") != BLANK)
    )
    # A row without a turn comes first of all.
    later = F.col("k").isNotNull() & F.col("turn").isNotNull() & (
        F.col("without_turn") | (F.col("turn") > F.col("first_turn"))
    )
    return looked.join(again, same, "left").select(
        *looked.columns[:-1], F.when(later, DUPLICATE).otherwise(F.col("fault")).alias("fault")
    )


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        columns = zip(*held, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


_LONGS = pa.list_(pa.int64())
_PIECE = pa.schema(
    [
        ("conv_id", pa.int64()), ("piece", pa.int64()), ("symbols", _LONGS), ("lengths", _LONGS),
        ("matrix", _LONGS), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
    ]
)
_PIECE_DDL = (
    "conv_id long, piece long, symbols array<long>, lengths array<long>, matrix array<long>,"
    " first_turn long, last_turn long, turns long"
)


def _line_runs(kind: int, fault: int, copies: int) -> list[tuple[int, int]]:
    if fault in (BLANK, DUPLICATE) or copies < 2:
        return [(symbol(kind, fault), copies)]
    return [(symbol(kind, fault), 1), (symbol(kind, DUPLICATE), copies - 1)]


def _pieces(size: int):
    def cut(batches):
        first = TaskContext.get().partitionId() << 40
        return _batches(pieces(_rows(batches), first), _PIECE, 64)

    def pieces(rows, number):
        conv, runs, turns, started = None, [], [], False

        def piece():
            whole = [x for line in matrix_of(runs) for x in line]
            ends = (turns[0], turns[1], turns[2]) if turns else (None, None, 0)
            return conv, number, [s for s, _ in runs], [n for _, n in runs], whole, *ends

        for conv_id, turn, kind, fault, copies in rows:
            if started and (conv_id != conv or len(runs) >= size):
                yield piece()
                number, runs, turns = number + 1, [], []
            conv, started = conv_id, True
            if not copies:  # a dropped row only tells that there is such a conversation
                continue
            if turn is not None:
                if not turns:
                    turns = [turn, turn, 1]
                elif turn != turns[1]:
                    turns[1:] = [turn, turns[2] + 1]
            for row, n in _line_runs(kind, fault, copies):
                if runs and runs[-1][0] == row:
                    runs[-1] = (row, runs[-1][1] + n)
                else:
                    runs.append((row, n))
        if started:
            yield piece()

    return cut


def pieces_of(lines: DataFrame, size: int = PIECE_RUNS) -> DataFrame:
    """Pieces of conversations as runs, from rows sorted over all partitions."""
    order = ["conv_id", "turn", "role", "digest"]
    ordered = _symbols(lines).repartitionByRange(*order).sortWithinPartitions(*order)
    found = ordered.select("conv_id", "turn", "kind", "fault", "copies")
    return saved(found.mapInArrow(_pieces(size), _PIECE_DDL), "pieces")


def _with_costs_behind(batches):
    def priced(rows):
        conv, after = (), _END
        for row in rows:
            if row[0] != conv:
                conv, after = row[0], _END
            yield *row, list(after)
            m = row[4]
            after = _before(tuple(tuple(m[4 * p : 4 * p + 4]) for p in _STATES), after)

    return _batches(priced(_rows(batches)), _PIECE.append(pa.field("after", _LONGS)), 64)


_AUDIT = pa.schema(
    [("conv_id", pa.int64()), ("piece", pa.int64()), ("audit", pa.string())]
    + [(n, pa.int64()) for n in "blank duplicate truncated illegal cost first_turn last_turn turns".split()]
)
_AUDIT_DDL = "conv_id long, piece long, audit string, " + ", ".join(f"{f.name} long" for f in list(_AUDIT)[3:])


def _audits(batches):
    def unrolled(rows):
        conv, state, last_kind, last_turn = (), _NOTHING, None, None

        def ending():
            inserts = _END[state] // INSERT
            if inserts:
                yield conv, _LAST_PIECE, "I" * inserts, 0, 0, 0, 0, inserts * INSERT, None, None, 0

        for conv_id, piece, symbols, lengths, _, first, last, turns, after in rows:
            if conv_id != conv:
                if conv != ():
                    yield from ending()
                conv, state, last_kind, last_turn = conv_id, _NOTHING, None, None
            runs = list(zip(symbols, lengths, strict=True))
            entered = state
            here = tuple(after)
            for row, n in reversed(runs):
                here = before_run(row, n, here)
            letters, state = unroll(runs, state, tuple(after))
            faults, illegal = [0, 0, 0, 0], 0
            for row, n in runs:
                faults[row % 4] += n
                kind = row // 4
                illegal += n - 1  # nobody may speak twice
                if last_kind is not None and (last_kind, kind) not in ((0, 1), (1, 2), (2, 1)):
                    illegal += 1
                last_kind = kind
            repeated = turns and last_turn is not None and first == last_turn
            last_turn = last if turns else last_turn
            cost = here[entered] - after[state]
            yield conv, piece, letters, *faults[1:], illegal, cost, first, last, turns - bool(repeated)
        if conv != ():
            yield from ending()

    return _batches(unrolled(_rows(batches)), _AUDIT, 64)


def audits_of(pieces: DataFrame) -> DataFrame:
    """A row for each conversation: gaps, faults, illegal neighbours, cost and audit.

    The pieces of a conversation are read in order, one after the other, and never held together.
    """
    schema = f"{_PIECE_DDL}, after array<long>"
    backward = pieces.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("piece"))
    priced = backward.mapInArrow(_with_costs_behind, schema)
    forward = priced.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    parts = F.array_sort(F.collect_list(F.struct("piece", "audit")))
    total = forward.mapInArrow(_audits, _AUDIT_DDL).groupBy("conv_id").agg(
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - F.sum("turns"), F.lit(0)).alias("gaps"),
        *(F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.array_join(F.transform(parts, lambda p: p.audit), "").alias("audit"),
    )
    return saved(total, "audits")


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _apply(batches):
    """Rows after the audit of their conversation: what it keeps, with new roles and inserted rows."""

    def edited(rows):
        conv, audit, at, place, state = (), "", 0, 0, _NOTHING

        def spoken(role, text):
            nonlocal place
            place += 1
            return conv, place - 1, role, text

        def inserts():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                at, state = at + 1, _INSERTED[state]
                yield spoken("user" if state == _USER else "assistant", "")

        for conv_id, is_line, role, text, copies in rows:
            if not is_line:
                if conv != ():
                    yield from inserts()
                conv, audit, at, place, state = conv_id, text, 0, 0, _NOTHING
                continue
            for _ in range(copies):
                yield from inserts()
                letter, at = audit[at], at + 1
                if letter == "K":
                    state = _KEPT[state, ROLES.index(role[0])]
                    yield spoken(role, text)
                elif letter == "R":
                    state = _INSERTED[state]
                    yield spoken("user" if state == _USER else "assistant", text)
        if conv != ():
            yield from inserts()

    return _batches(edited(_rows(batches)), _REPAIRED)


def repaired_rows(lines: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the repaired conversations, each in order within one partition.

    An audit stands before the rows of its conversation in the sorted partition, and rows are read
    one after the other, so that a long conversation takes no more memory than its audit.
    """
    heads = audits.select(
        "conv_id", F.lit(False).alias("is_line"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"),
    )
    both = heads.unionByName(lines.filter("copies > 0").withColumn("is_line", F.lit(True)))
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "is_line", "turn", "role", "digest")
    rows = dealt.select("conv_id", "is_line", "role", "text", "copies")
    return rows.mapInArrow(_apply, "conv_id long, place long, role string, text string")


def _digests(batches):
    def hashed(rows):
        conv, digest = (), None
        for conv_id, place, role, text in rows:
            if place == 0:
                if digest:
                    yield conv, digest.hexdigest()
                conv, digest = conv_id, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        if digest:
            yield conv, digest.hexdigest()

    return _batches(hashed(_rows(batches)), pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())]))


def audited(rows: DataFrame, piece_runs: int = PIECE_RUNS) -> DataFrame:
    """A row for each conversation of (conv_id, turn, role, text, copies), with the digest of its repair.

    Rows are taken by turn, those without one first; rows of one turn by role and by the digest of the
    text. Role and text must not be NULL. A conversation whose rows have no copies has zeros, an empty
    audit and the digest of the empty text. All rows of conv_id NULL are one conversation. A role
    counts by its first letter; other columns play no part; an empty table gives an empty one. The
    digest is a chain over the whole text, so its rows pass through one task, one at a time.
    """
    lines = lines_of(rows)
    audits = audits_of(pieces_of(lines, piece_runs))
    digests = repaired_rows(lines, audits).mapInArrow(_digests, "conv_id long, sha256 string")
    digests = digests.withColumnRenamed("conv_id", "of")
    nothing = hashlib.sha256().hexdigest()
    return audits.join(digests, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


_STEP = "struct_pack(c := {c}, a := {a})"


def _oracle() -> str:
    def step(letter: str, cost: str, then: str) -> str:
        return _STEP.format(c=f"{then}.c + {cost}", a=f"'{letter}' || {then}.a")

    never = _STEP.format(c="1000000000", a="''")
    late = f"(fault = 't')::int * {TRUNCATED_KEPT}"

    def row(state: int) -> str:
        kept = [
            f"case when fault in ('', 't') and initial = '{ROLES[role]}' then {step('K', late, f'v{to}')} else {never} end"
            for (at, role), to in _KEPT.items()
            if at == state
        ]
        rerole = step("R", f"{REROLE} + {late}", f"v{_INSERTED[state]}")
        rerole = f"case when fault in ('', 't') then {rerole} else {never} end"
        return f"list_min([{', '.join([step('D', str(DELETE), f'v{state}'), *kept, rerole])}])"

    rows = ", ".join(f"{row(s)} as r{s}" for s in _STATES)
    end = ", ".join(f"{_STEP.format(c=f'{c}::bigint', a=repr('I' * (c // INSERT)))} as v{s}" for s, c in zip(_STATES, _END))
    return f"""
with recursive hashed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc32_sql("h")} % 20 as k
  from (select *, hex(encode(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))) as h
        from conversations)),
spoilt as (
  select conv_id, turn, case when k = 4 then 'user' else role end as role,
    case when k = 1 then '' when k = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when k = 3 then 2 else 1 end)) as copy
  from hashed where k <> 0),
numbered as (
  select *, substr(role, 1, 1) as initial, count(*) over (partition by conv_id) as m,
    row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i from spoilt),
faulty as (
  select *, case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'b'
    when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd'
    when regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then '' else 't' end as fault,
    lag(initial) over (partition by conv_id order by i) || initial as pair from numbered),
steps as (
  select conv_id, m + 1 as i, {end} from (select distinct conv_id, m from numbered)
  union all
  select conv_id, i, list_min([r0, {step("I", str(INSERT), "e2")}]) as v0,
    list_min([r1, {step("I", str(INSERT), "e2")}]) as v1, e2 as v2, e3 as v3 from (
    select *, list_min([r2, {step("I", str(INSERT), "r3")}]) as e2,
      list_min([r3, {step("I", str(INSERT), "r2")}]) as e3 from (
      select f.conv_id, f.i, {rows}
      from steps s join faulty f on f.conv_id is not distinct from s.conv_id and f.i = s.i - 1))),
best as (select conv_id, v0.c as cost, v0.a as audit from steps where i = 1),
letters as (
  select conv_id, place, audit[place] as letter, length(replace(audit[:place], 'I', '')) as i,
    length(replace(audit[:place], 'D', '')) as spoken, length(replace(audit, 'D', '')) as total
  from (select *, unnest(range(1, length(audit) + 1)) as place from best)),
texts as (
  select l.conv_id, sha256(string_agg(
    case when letter = 'K' then f.role when (spoken + total) % 2 = 0 then 'assistant' else 'user' end
      || ':' || case when letter = 'I' then '' else f.text end, chr(10) order by place)) as sha
  from letters l left join faulty f on f.conv_id is not distinct from l.conv_id and f.i = l.i
  where letter <> 'D' group by l.conv_id),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
    count(*) filter (fault = 't') as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au')) as illegal from faulty group by conv_id)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0)::bigint as cost,
  coalesce(audit, '') as audit, coalesce(sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) a
left join counts c on c.conv_id is not distinct from a.conv_id
left join best b on b.conv_id is not distinct from a.conv_id
left join texts t on t.conv_id is not distinct from a.conv_id
"""


# An independent way: one step for each row from the end, keeping each state's cheapest edits as text.
ORACLE_SQL = _oracle()
