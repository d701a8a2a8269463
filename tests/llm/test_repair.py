"""Repairs against a search over all edits, pieces of any size, and the SQL text on odd rows."""

import hashlib
import heapq
import random
import re
import zlib

import duckdb
import pytest

from salesflow.llm import repair

CONVERSATION = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        yield from [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def fault_of(role, text, seen):
    shown = text.strip(" \t\n\x0b\f\r")
    if not shown:
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return "" if shown[-1] in ".!?" else "truncated"


def cheapest(rows, faults):
    """(cost, audit, repaired): the first in order of cost and audit, by a search over edit scripts."""
    legal = re.compile("s?(ua)+|")
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, initials, kept = heapq.heappop(queue)
        tail = initials if len(initials) < 2 else initials[-1]
        if i == len(rows) and legal.fullmatch(initials):
            return cost, audit, kept
        if (i, tail, audit) in done:
            continue
        done.add((i, tail, audit))

        def push(letter, price, row, step):
            then = initials + row[0][:1] if row else initials
            if any(legal.fullmatch(then + end) for end in ("", "a", "ua")):
                heapq.heappush(queue, (cost + price, audit + letter, i + step, then, kept + ((row,) if row else ())))

        for role in ("user", "assistant"):
            push("I", 2, (role, ""), 0)
        if i < len(rows):
            role, text = rows[i]
            push("D", 3, None, 1)
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                if role[:1] in ("s", "u", "a"):
                    push("K", more, rows[i], 1)
                for other in ("user", "assistant"):
                    push("R", 2 + more, (other, text), 1)


def plain_audits(original):
    rows = list(plain_damage(original))
    found = []
    for conv in {r[0] for r in original}:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        spoken = [r[2:] for r in own]
        faults = [fault_of(*r, spoken[:i]) for i, r in enumerate(spoken)]
        initials = [r[:1] for r, _ in spoken]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = cheapest(spoken, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        counts = [faults.count(n) for n in ("blank", "duplicate", "truncated")]
        found.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(found, key=str)


def generated(seed, conversations, most=7):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "", " \t\n", "Why?", "so.\n ", "a!b", "é…", "Yes. ", None, "…? "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "Sam", None, "unknown"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(0, most)):
            turn = rng.choice([turn, turn, turn, turn + 3, None])
            role = roles[turn % 2] if turn is not None and rng.random() < 0.4 else rng.choice(roles)
            rows.append((conv if conv else None, turn, role, rng.choice(texts)))
            if rng.random() < 0.15:
                rows.append(rows[-1])
    return rows


def audited(spark, rows, **options):
    given = spark.createDataFrame([(*r, -1) for r in rows], CONVERSATION + ", audit int")
    return sorted(map(tuple, repair.audited(repair.damaged(given), **options).collect()), key=str)


@pytest.fixture(scope="module")
def odd_rows():
    return generated(3, 250)


def test_audits_equal_a_search(spark, odd_rows):
    assert audited(spark, odd_rows) == plain_audits(odd_rows)


def test_pieces_of_one_run_change_nothing(spark, odd_rows):
    assert audited(spark, odd_rows, piece_runs=1) == audited(spark, odd_rows)


def test_sql_on_odd_rows(spark, odd_rows):
    connection = duckdb.connect()
    connection.sql("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    connection.executemany("insert into conversations values (?, ?, ?, ?)", odd_rows)
    assert sorted(connection.sql(repair.ORACLE_SQL).fetchall(), key=str) == audited(spark, odd_rows)


def test_one_long_conversation_in_many_pieces(spark):
    rows = [(1, t, "user" if t % 7 else "assistant", f"Row {t % 40}{'.' if t % 3 else ''}") for t in range(3_000)]
    rows += [(2, None, "user", "same.")] * 500
    one = audited(spark, rows)
    assert audited(spark, rows, piece_runs=5) == one
    connection = duckdb.connect()
    connection.sql("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    connection.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert sorted(connection.sql(repair.ORACLE_SQL).fetchall(), key=str) == one


@pytest.mark.parametrize("n", [1, 2, 5, 64, 1000, 123_456])
@pytest.mark.parametrize("kind, fault", [(0, 0), (1, 0), (1, 3), (2, 0), (2, 3), (3, 0), (1, 1)])
def test_runs_by_powers_equal_row_by_row(n, kind, fault):
    row = repair.symbol(kind, fault)
    costs = repair._END
    for _ in range(n):
        costs = repair._before(repair.power(row, 0), costs)
    assert repair.before_run(row, n, repair._END) == costs
    assert repair._before(repair.matrix_of([(row, n)]), repair._END) == costs
    letters, state = repair.unroll([(row, n)], 0, repair._END)
    price = {"D": 3, "I": 2, "K": 0, "R": 2}
    total = sum(price[c] + (fault == 3 and c in "KR") for c in letters) + repair._END[state]
    assert total == costs[0] and len(letters.replace("I", "")) == n


def test_repaired_rows_alternate(spark, odd_rows):
    given = spark.createDataFrame(odd_rows, CONVERSATION)
    lines = repair.lines_of(repair.damaged(given))
    rows = repair.repaired_rows(lines, repair.audits_of(repair.pieces_of(lines))).collect()
    for conv in {r["conv_id"] for r in rows}:
        own = sorted((r["place"], r["role"][0]) for r in rows if r["conv_id"] == conv)
        assert [p for p, _ in own] == list(range(len(own)))
        assert re.fullmatch("s?(ua)+", "".join(r for _, r in own))


def test_dropped_and_empty_tables(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert audited(spark, [(5, dropped, "user", "Hello.")]) == [(5, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert audited(spark, []) == []
