"""Conversation repair against an exhaustive search over edits, and its twin in SQL."""

import hashlib
import heapq
import random
import zlib

import duckdb
import pytest

from tickframe.llm import conversation_repair as repair
from tickframe.llm import registry

from ..conftest import SMALL

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def cheapest(rows, faults):
    """Cost, audit and repaired lines by a search over (rows read, last initial), least cost and audit first."""
    heap, done = [(0, "", 0, "", ())], {}
    while True:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, list(lines)
        # Nothing that comes later can be better for the same place, but for audits of which one begins with the other.
        if done.setdefault((i, last), cost) < cost:
            continue
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        if len(audit) < 2 * len(rows) + 4:
            new = "user" if "u" in follows else "assistant"
            heapq.heappush(heap, (cost + 5, audit + "I", i, new[0], (*lines, f"{new}:")))
        if i < len(rows):
            (_, role, text), fault = rows[i], faults[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, lines))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role[:1] and role[:1] in follows:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
                new = "user" if "u" in follows else "assistant"
                heapq.heappush(heap, (cost + 1 + extra, audit + "R", i + 1, new[0], (*lines, f"{new}:{text}")))


def brute(conv_id, rows):
    """The result row of one conversation's rows (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(SPACES)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(rows, faults)
    return (conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    """{conv_id: rows in order} after the damage."""
    out = {}
    for conv_id, turn, role, text in rows:
        kept = out.setdefault(conv_id, [])
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        role, text, spot = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        text = "" if spot == 1 else "".join(c for c in text if c not in ".!?") if spot == 2 else text
        kept.extend([(turn, "user" if spot == 4 else role, text)] * (0 if spot == 0 else 2 if spot == 3 else 1))
    return {c: sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, kept in out.items()}


def as_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def in_sql(rows):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(connection.execute(repair.SQL).fetchall(), key=repr)


@pytest.fixture(scope="module")
def odd():
    r = random.Random(3)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u", "s"]
    texts = ["Yes.", "no", "", " \n", "why?", "a.b ", "Yes.", None, "ü!", "x\x85", "end.\r\n"]
    rows = [(c, t, r.choice(roles), r.choice(texts)) for c in range(300) for t in r.sample(range(12), r.randint(1, 7))]
    rows += [(None, t, "user", "hello.") for t in (0, 1, None)] + [(900, None, None, None)] * 3
    # Dropped as a whole: crc32 of the key leaves nothing.
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "hello.")]
    rows += [(2000, 0, "user", "word " * 20_000)] + [(2000, 1, "assistant", "long. " * 20_000)]
    r.shuffle(rows)
    return rows


def test_equals_the_search_and_sql(spark, odd):
    df = spark.createDataFrame(odd, SCHEMA)
    wanted = sorted((brute(c, rows) for c, rows in damaged(odd).items()), key=repr)
    assert as_rows(repair.repair_damaged(df)) == wanted
    assert in_sql(odd) == wanted
    spilled = repair.repairs(repair.streamed(repair.damaged(df.repartition(5))), memory_rows=2)
    assert as_rows(spilled) == wanted


def test_undamaged_conversations(spark, odd):
    plain = {}
    for c, t, role, text in odd:
        plain.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    wanted = [brute(c, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for c, rows in plain.items()]
    extra = spark.createDataFrame(odd, SCHEMA).selectExpr("*", "1 AS fault", "2 AS _at", "3 AS cost")
    assert as_rows(repair.repair(extra)) == sorted(wanted, key=repr)


def test_ties_go_to_the_least_audit(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c."),
            (2, 0, "assistant", "a."), (3, 0, "system", "s.")]
    got = {r.conv_id: (r.cost, r.audit) for r in repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (2, "DKK"), 2: (2, "D"), 3: (2, "D")}


def test_a_giant_conversation_is_not_held(spark):
    """Half of all rows are one conversation, over many Arrow batches and spilled blocks of pointers."""
    n = 60_000
    giant = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "CASE id % 5 WHEN 0 THEN 'tool' WHEN 1 THEN 'assistant' ELSE 'user' END AS role",
                                      "concat('text ', id, CASE id % 7 WHEN 0 THEN '' ELSE '.' END) AS text")
    others = spark.range(n).selectExpr("100 + id DIV 4 AS conv_id", "id % 4 AS turn", "CASE id % 2 WHEN 0 THEN 'user' ELSE 'assistant' END AS role", "'x.' AS text")
    got = {r.conv_id: r for r in repair.repair(giant.unionByName(others), memory_rows=1000).collect()}
    assert len(got) == 1 + n // 4 and got[7].n_rows == n
    audit = got[7].audit
    assert sum(c != "I" for c in audit) == n and got[7].n_repaired == len(audit) - audit.count("D")
    assert got[7].cost == sum({"I": 5, "D": 2, "R": 1, "K": 0}[c] for c in audit) + 5 * sum(
        c in "KR" and i % 7 == 0 for i, c in enumerate(audit.replace("I", "")))
    whole = {r.conv_id: r for r in repair.repair(giant).collect()}
    assert whole[7] == got[7]


def test_query_equals_sql_and_empty_tables(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    assert as_rows(registry.op12_conversation_repair(spark, SMALL)) == sorted(connection.execute(repair.SQL).fetchall(), key=repr)
    assert repair.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0 == len(in_sql([]))
