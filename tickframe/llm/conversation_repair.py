"""Repair of conversation structure by a streaming dynamic programme.

A conversation is well formed if its roles read system (or none), then user and
assistant in turns. Every row may be kept, given another role, or deleted, and
empty rows may be inserted; the cheapest edits are sought, ties to the audit that
is least in ASCII.

The rows are dealt by conversation and sorted by turn, and one pass over the
Arrow batches of a task carries the state from row to row and from batch to
batch: for each of the four states (nothing yet, system, user, assistant) the
cost of the best edits so far, their place in the order of audits, and the hash
of the repaired text. What a step does depends only on these small numbers and
the row's class, so steps are remembered and looked up. Back-pointers take four
bytes a row; beyond ``MEMORY_ROWS`` rows they go to the task's scratch file, as
the rows of a conversation of any length are never held together.

Inserted rows count with the row after them, so that the audits of two states
after the same row both end in a letter of that row. Neither can then begin with
the other, and their order stays what it is whatever follows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANK = r"[^\x20\x09-\x0D]"
ENDS = ".!?"
MEMORY_ROWS = 1 << 18
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
# States by the last role given out.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 30
# Rows are of a class: the state their role leads to if kept (none for other roles), and their fault.
CLASSES = [(state, fault) for state in (None, SYSTEM, USER, ASSISTANT) for fault in ("", "gone", "truncated")]
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string, n_rows long, n_repaired long")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as conv_id, turn, role, text, _at, with a fixed part of them damaged; dropped rows have a null ``_at``.

    What happens to a row follows from crc32 of ``conv_id:turn`` modulo 20: 0 drops
    it, 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it beside itself, 4
    makes it the user's. Nulls count as one space in key, role and text.
    """
    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    spot = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(spot == 1, "").when(spot == 2, F.translate(shown("text"), ENDS, "")).otherwise(shown("text"))
    copies = F.when(spot == 0, F.array(F.lit(None).cast("int"))).when(spot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select("conv_id", "turn", F.when(spot == 4, "user").otherwise(shown("role")).alias("role"),
                                text.alias("text"), F.explode(copies).alias("_at"))


def streamed(rows: DataFrame) -> DataFrame:
    """The rows by conversation and turn (nulls first; equal turns by role, text and ``_at``), each with ``fault``.

    One exchange brings a conversation together. Equal rows are found by a sort
    within it and put back in order by another; neither holds a conversation in
    memory. The fault is the first of blank, duplicate and truncated.
    """
    same = Window.partitionBy("conv_id", "role", "text", F.isnull("_at")).orderBy("turn", "_at")
    last = F.substring(F.btrim("text", F.lit("\x20\t\n\x0b\x0c\r")), -1, 1)
    fault = F.when(F.col("_at").isNull(), None).when(~F.col("text").rlike(BLANK), "blank") \
        .when(F.col("_nth") > 1, "duplicate").when(~last.isin(*ENDS), "truncated").otherwise("")
    return rows.repartition("conv_id").withColumn("_nth", F.row_number().over(same)).withColumn("fault", fault) \
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", F.col("_at").asc_nulls_first()) \
        .select("conv_id", "turn", "role", "text", "fault", F.col("_at").isNull().alias("_dropped"))


def state_after(state: int, inserts: int) -> int:
    """The state after so many inserted rows; what may be inserted follows from the state."""
    for _ in range(inserts):
        state = ASSISTANT if state == USER else USER
    return state


def step(costs: tuple, ranks: tuple, kind: int) -> tuple:
    """One row: new costs (least 0), new ranks of the audits, what the least cost grew by, and per state (before, inserts, letter).

    A state that cannot be reached costs ``FAR``.
    """
    kept_as, fault = CLASSES[kind]
    late = UNFINISHED if fault == "truncated" else 0
    options: dict[int, list] = {s: [] for s in range(4)}
    for before in range(4):
        if costs[before] >= FAR:
            continue
        # A third insert in a row would lead back to where one insert leads.
        for inserts in range(3):
            state, cost = state_after(before, inserts), costs[before] + INSERT * inserts
            letters = "I" * inserts
            options[state].append((cost + DELETE, ranks[before], letters + "D", before, inserts))
            if fault == "gone":
                continue
            follows = {NOTHING: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}[state]
            if kept_as in follows:
                options[kept_as].append((cost + KEEP + late, ranks[before], letters + "K", before, inserts))
            new = ASSISTANT if state == USER else USER
            options[new].append((cost + REROLE + late, ranks[before], letters + "R", before, inserts))
    best = [min(options[s]) if options[s] else None for s in range(4)]
    least = min(b[0] for b in best if b)
    order = sorted((b[1], b[2], s) for s, b in enumerate(best) if b)
    ranks = [0] * 4
    for place, (_, _, s) in enumerate(order):
        ranks[s] = place
    return (tuple(b[0] - least if b else FAR for b in best), tuple(ranks), least,
            tuple((b[3], b[4], b[2][-1]) if b else None for b in best))


def ending(costs: tuple, ranks: tuple) -> tuple[int, int, int]:
    """Cost, state and inserts of the best end: nothing at all or an assistant's row last."""
    ends = []
    for state in range(4):
        if costs[state] < FAR:
            for inserts in range(3):
                if state_after(state, inserts) in (NOTHING, ASSISTANT):
                    ends.append((costs[state] + INSERT * inserts, ranks[state], inserts, state))
    cost, _, inserts, state = min(ends)
    return cost, state, inserts


class Text:
    """The hash of a repaired text and the number of its rows."""

    __slots__ = ("hash", "rows")

    def __init__(self, of=None, rows: int = 0):
        self.hash, self.rows = of or hashlib.sha256(), rows

    def with_rows(self, state: int, inserts: int, role: str | None, text: str) -> Text:
        out = Text(self.hash.copy(), self.rows)
        for _ in range(inserts):
            state = ASSISTANT if state == USER else USER
            out.add(f"{NAMES[state]}:")
        if role is not None:
            out.add(f"{role}:{text}")
        return out

    def add(self, line: str) -> None:
        self.hash.update((("\n" if self.rows else "") + line).encode("utf-8", "surrogatepass"))
        self.rows += 1


class Pointers:
    """Four bytes a row: per state, where it came from, the inserts and the letter."""

    LETTERS = "DKR"

    def __init__(self, memory_rows: int = MEMORY_ROWS):
        self.codes, self.memory_rows, self.file, self.rows = bytearray(), memory_rows, None, 0

    @classmethod
    def packed(cls, back: tuple) -> bytes:
        return bytes(0 if b is None else b[0] | b[1] << 2 | cls.LETTERS.index(b[2]) << 4 for b in back)

    def append(self, code: bytes) -> None:
        self.codes += code
        self.rows += 1
        if len(self.codes) >= 4 * self.memory_rows:
            # A nameless file in the task's own scratch folder: it ends with the task, and a task that is run again makes its own.
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.codes)
            self.codes = bytearray()

    def _blocks(self) -> Iterator[bytes]:
        """Blocks of rows, the last first."""
        yield bytes(self.codes)
        if self.file:
            size = 4 * self.memory_rows
            for at in range(self.file.tell() - size, -1, -size):
                self.file.seek(at)
                yield self.file.read(size)

    def audit(self, state: int, inserts: int) -> str:
        out = bytearray(b"I" * inserts)
        for block in self._blocks():
            for at in range(len(block) - 4, -1, -4):
                code = block[at + state]
                out += self.LETTERS[code >> 4].encode()
                out += b"I" * (code >> 2 & 3)
                state = code & 3
        if self.file:
            self.file.close()
        return out[::-1].decode()


class Repair:
    """One conversation while its rows come in order."""

    START = ((0, FAR, FAR, FAR), (0, 0, 0, 0))

    def __init__(self, conv_id, steps: dict, memory_rows: int = MEMORY_ROWS):
        self.conv_id, self.steps = conv_id, steps
        self.costs, self.ranks = self.START
        self.texts: list[Text | None] = [Text(), None, None, None]
        self.pointers = Pointers(memory_rows)
        self.cost, self.initial, self.turn, self.first, self.turns = 0, None, None, None, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if fault:
            self.faults[fault] += 1
        kept_as = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(initial)
        kind = CLASSES.index((kept_as, "gone" if fault in ("blank", "duplicate") else fault))
        key = (self.costs, self.ranks, kind)
        if key not in self.steps:
            self.steps[key] = (*(made := step(*key)), Pointers.packed(made[3]))
        self.costs, self.ranks, grown, back, code = self.steps[key]
        self.cost += grown
        self.pointers.append(code)
        before, self.texts = self.texts, [None] * 4
        for state, b in enumerate(back):
            if b:
                old, inserts, letter = b
                if letter == "D" and not inserts:
                    self.texts[state] = before[old]
                else:
                    own = None if letter == "D" else role if letter == "K" else NAMES[state]
                    self.texts[state] = before[old].with_rows(old, inserts, own, text)

    def result(self) -> tuple:
        cost, state, inserts = ending(self.costs, self.ranks)
        text = self.texts[state].with_rows(state, inserts, None, "") if inserts else self.texts[state]
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost + cost,
                self.pointers.audit(state, inserts), text.hash.hexdigest(), self.pointers.rows, text.rows)


def repairs(conversations: DataFrame, memory_rows: int = MEMORY_ROWS) -> DataFrame:
    """One row per conversation of rows that ``streamed`` has put in order.

    Columns: conv_id, gaps (turns missing between the least and the largest),
    blank, duplicate, truncated (rows by first fault), illegal (neighbours whose
    roles' initials are not su, ua or au), cost, audit (initials of the edits Keep,
    Rerole, Delete, Insert), repaired_sha256 (of ``role:text`` lines), n_rows (rows
    met), n_repaired (rows left). A null conv_id is a conversation like others; one
    without rows has zeros, an empty audit and the hash of nothing. Neither the
    number of rows nor the length of their texts is bounded, but for the audit,
    which is a letter a row in one cell.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        steps: dict = {}
        now, done = None, []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done))
            kinds = [pa.int64()] * 7 + [pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            columns = [batch.column(c) for c in ("conv_id", "turn", "role", "text", "fault", "_dropped")]
            # A batch's texts become Python strings a few rows at a time.
            for at in range(0, batch.num_rows, 256):
                for conv_id, turn, role, text, fault, dropped in zip(*(c.slice(at, 256).to_pylist() for c in columns)):
                    if now is None or now.conv_id != conv_id:
                        if now is not None:
                            done.append(now.result())
                        now = Repair(conv_id, steps, memory_rows)
                    if not dropped:
                        now.add(turn, role, text, fault)
            if len(done) >= 1000 or sum(r[-2] for r in done) > 1 << 22:
                yield out()
                done = []
        if now is not None:
            done.append(now.result())
        if done:
            yield out()

    return conversations.mapInArrow(run, RESULT)


def repair(conversations: DataFrame, memory_rows: int = MEMORY_ROWS) -> DataFrame:
    """Faults and cheapest repair of every conversation (columns conv_id, turn, role, text) as it is; see ``repairs``."""
    def shown(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(" "))

    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), F.lit(0).alias("_at"))
    return repairs(streamed(rows), memory_rows)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The same after ``damaged``, with every conversation, also those of which no row is left."""
    return repairs(streamed(damaged(conversations)))


# The same in SQL: crc32 by its rule, then one step per row over the states of all conversations.
SQL = r"""
WITH RECURSIVE entries AS (
  SELECT list(list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
              ORDER BY n) AS entry
  FROM range(256) AS t(n)),
spots AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295], list_transform(
          string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
        lambda c, b: xor(c // 256, entry[xor(c, b) % 256 + 1])), 4294967295) % 20 AS spot
  FROM conversations, entries),
convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
damaged AS (
  SELECT c, turn, CASE WHEN spot = 4 THEN 'user' ELSE role END AS role,
    CASE spot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN spot = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM spots JOIN convs ON spots.conv_id IS NOT DISTINCT FROM convs.conv_id WHERE spot <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    left(role, 1) AS initial FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY c ORDER BY i) AS before FROM placed),
counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faulty GROUP BY c),
-- States: 0 nothing, 1 system, 2 user, 3 assistant; k rows inserted from a state lead to another.
inserts AS (
  SELECT s, k, CASE WHEN k = 0 THEN s WHEN (s = 2) = (k = 1) THEN 3 ELSE 2 END AS t,
    CASE WHEN k = 0 THEN NULL WHEN k = 1 THEN CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END
         WHEN s = 2 THEN 'assistant:' || chr(10) || 'user:' ELSE 'user:' || chr(10) || 'assistant:' END AS lines
  FROM range(4) AS a(s), range(3) AS b(k)),
steps AS (
  SELECT c, 0::BIGINT AS i, 0::BIGINT AS s, {'cost': 0::BIGINT, 'audit': '', 'body': NULL::VARCHAR} AS best FROM convs
  UNION ALL
  SELECT c, i, s, min({'cost': cost, 'audit': audit, 'body': body}) FROM (
    SELECT steps.c, steps.i + 1 AS i,
      CASE letter WHEN 'D' THEN t WHEN 'K' THEN CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
        ELSE CASE WHEN t = 2 THEN 3 ELSE 2 END END::BIGINT AS s,
      best.cost + 5 * k + CASE letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
        + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
      best.audit || repeat('I', k) || letter AS audit,
      nullif(concat_ws(chr(10), best.body, lines, CASE letter WHEN 'D' THEN NULL WHEN 'K' THEN role || ':' || text
        ELSE CASE WHEN t = 2 THEN 'assistant:' ELSE 'user:' END || text END), '') AS body
    FROM steps JOIN faulty ON faulty.c = steps.c AND faulty.i = steps.i + 1 JOIN inserts ON inserts.s = steps.s,
      (VALUES ('D'), ('K'), ('R')) AS l(letter)
    WHERE letter = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (letter = 'R'
      OR (t = 0 AND initial IN ('s', 'u')) OR (t IN (1, 3) AND initial = 'u') OR (t = 2 AND initial = 'a'))))
  GROUP BY c, i, s),
ends AS (
  SELECT steps.c, min({'cost': best.cost + 5 * k, 'audit': best.audit || repeat('I', k), 'body': concat_ws(chr(10), best.body, lines)}) AS best
  FROM steps JOIN inserts ON inserts.s = steps.s LEFT JOIN counted ON counted.c = steps.c
  WHERE steps.i = coalesce(counted.n, 0) AND t IN (0, 3) GROUP BY steps.c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
  sha256(coalesce(best.body, '')) AS repaired_sha256
FROM convs JOIN ends ON ends.c = convs.c LEFT JOIN counted ON counted.c = convs.c
"""
