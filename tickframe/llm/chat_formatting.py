"""Preference pairs for training: one prompt, two masked completions.

The longest common prefix of turns (same role and text) of the chosen and the
rejected conversation is rendered once, as the prompt; the turns after it are
rendered as the two completions. The result is a table of segments, one per
turn, each with its place in its part, so that no conversation, however long,
has to be one value: the segments of a part in order of position are its text.
A mask marks what the loss counts: the contents and ends of assistant turns of
the completions. Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import running_totals

HEAD, MIDDLE, END = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"


KEY = ["pair_id", "side", "turn_key", "role", "digest"]


def rendered(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Both conversations' turns (pair_id, turn, role, text) as segments, with a key that is never null.

    Null roles and texts are empty. Rows without pair_id are left out.
    """
    def of(df: DataFrame, side: str) -> DataFrame:
        role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
        return df.filter("pair_id IS NOT NULL").select(
            "pair_id", F.lit(side).alias("side"), F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn_key"),
            role.alias("role"), F.md5(F.encode(text, "UTF-8")).alias("digest"), "turn",
            F.concat(F.lit(HEAD), role, F.lit(MIDDLE), text, F.lit(END)).alias("segment"))
    return of(chosen, "chosen").unionByName(of(rejected, "rejected"))


def places(segments: DataFrame) -> DataFrame:
    """Position and offset of each segment in its conversation; texts stay where they are.

    Turns are ordered by turn (null first), then role, then a digest of the
    text, so repeated rows are turns of their own and ties do not depend on the
    order of rows.
    """
    narrow = segments.select(*KEY, "turn", F.char_length("segment").cast("long").alias("length"))
    return running_totals(narrow, ["pair_id", "side"], ["turn", "role", "digest"],
                          {"position": F.lit(1), "offset": F.col("length")}, "turns")


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), position, role, segment, start, mask_from, mask_to, n_prompt.

    ``start`` is the segment's offset in its part in characters, mask_from and
    mask_to bound what is trained on (null where nothing is), ``n_prompt`` is
    the number of turns in the pair's prompt. A pair with one side only has no
    prompt; equal sides are prompt alone. Empty tables give no rows. The two
    tables are read twice: turns are compared by digests, and texts are moved
    once, to the places found for them.
    """
    segments = rendered(chosen, rejected)
    turns = places(segments)
    # A position that does not hold the same turn twice ends the prefix; the first one tells where.
    ends = turns.groupBy("pair_id", "position").agg(
        F.min("offset").alias("offset"),
        ((F.count("*") == 2) & (F.min("role") == F.max("role")) & (F.min("digest") == F.max("digest"))).alias("same")) \
        .filter(~F.col("same")).groupBy(F.col("pair_id").alias("_pair")) \
        .agg(F.min(F.struct("position", "offset")).alias("_end"))
    # Equal sides have no end of the prefix: their prompt is as long as the pair.
    whole = turns.filter("side = 'chosen'").groupBy(F.col("pair_id").alias("_whole")).agg(F.count("*").alias("_turns"))
    shared = F.col("_end").isNull() | (F.col("position") < F.col("_end.position"))
    kept = turns.join(ends, F.col("pair_id") == F.col("_pair"), "left").join(whole, F.col("pair_id") == F.col("_whole"), "left") \
        .withColumn("_shared", shared).filter(~F.col("_shared") | (F.col("side") == "chosen")) \
        .withColumn("start", F.col("offset") - F.when(F.col("_shared"), 0).otherwise(F.col("_end.offset")))
    trained = ~F.col("_shared") & (F.col("role") == TRAINED_ROLE)
    parts = kept.select(
        *KEY, F.when(F.col("_shared"), "prompt").otherwise(F.col("side")).alias("part"),
        F.col("position").cast("int").alias("position"), "start",
        F.when(trained, F.col("start") + F.char_length("role") + len(HEAD + MIDDLE)).alias("mask_from"),
        F.when(trained, F.col("start") + F.col("length")).alias("mask_to"),
        F.coalesce("_end.position", "_turns").cast("int").alias("n_prompt"))
    # Repeated rows are alike, so one text serves all their places.
    texts = segments.select(*KEY, "segment").dropDuplicates(KEY)
    return parts.join(texts, KEY).select("pair_id", "part", "position", "role", "segment", "start", "mask_from", "mask_to", "n_prompt")


def with_other_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations (conv_id, turn, role, text): chosen and rejected turns.

    Chosen is the conversation itself; in the rejected one its last assistant
    turn is answered as in the next conversation by id that has an assistant turn,
    after the last one as in the first (left out if no other has one).
    Conversations without assistant turns are equal on both sides.
    """
    turns = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("pair_id"), "turn", "role", "text") \
        .withColumn("_digest", F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    order = F.struct(F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63))).alias("turn"), "_digest")
    last = turns.filter(F.col("role") == TRAINED_ROLE).groupBy("pair_id") \
        .agg(F.max_by(F.struct("turn", "text", "_digest"), order).alias("_last")) \
        .select(F.col("pair_id").alias("_pair"), "_last")
    is_last = (F.col("role") == TRAINED_ROLE) & F.col("turn").eqNullSafe(F.col("_last.turn")) & (F.col("_digest") == F.col("_last._digest"))
    rest = turns.join(last, F.col("pair_id") == F.col("_pair"), "left") \
        .filter(F.col("_last").isNull() | ~F.coalesce(is_last, F.lit(False))).select("pair_id", "turn", "role", "text")
    # Ids are numbered without gaps and without one task; the texts are joined by these numbers.
    numbered = running_totals(last.select("_pair"), [], ["_pair"], {"_before": F.lit(1)}, "answered")
    follows = (F.col("_before") + 1) % numbered.agg(F.count("*")).scalar()
    donors = last.join(numbered.withColumnRenamed("_pair", "_donor"), F.col("_pair") == F.col("_donor")) \
        .select("_donor", F.col("_before").alias("_place"), F.col("_last.text").alias("text"))
    answers = last.select("_pair", F.col("_last.turn").alias("turn")).join(
        numbered.select(F.col("_pair").alias("pair_id"), follows.alias("_follows")), F.col("_pair") == F.col("pair_id")) \
        .join(donors, F.col("_follows") == F.col("_place")).filter(F.col("pair_id") != F.col("_donor")) \
        .select("pair_id", "turn", F.lit(TRAINED_ROLE).alias("role"), "text")
    return turns.select("pair_id", "turn", "role", "text"), rest.unionByName(answers)


# The query over the table conversations, for DuckDB.
SQL = f"""
WITH t AS (SELECT conv_id AS pair_id, turn, role, text, md5(coalesce(text, '')) AS digest FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT pair_id, turn, text, digest FROM (
        SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn DESC NULLS LAST, digest DESC) AS k FROM t WHERE role = 'assistant')
      WHERE k = 1),
b AS (SELECT *, row_number() OVER (ORDER BY pair_id) AS place, count(*) OVER () AS answered FROM l),
r AS (SELECT t.pair_id, t.turn, t.role, t.text FROM t LEFT JOIN l USING (pair_id)
      WHERE l.digest IS NULL OR NOT coalesce(t.role = 'assistant' AND t.turn IS NOT DISTINCT FROM l.turn AND t.digest = l.digest, false)
      UNION ALL SELECT b.pair_id, b.turn, 'assistant', d.text FROM b JOIN b AS d ON d.place = b.place % b.answered + 1 WHERE b.answered > 1),
s AS (SELECT 'chosen' AS side, pair_id, turn, role, text FROM t UNION ALL SELECT 'rejected', pair_id, turn, role, text FROM r),
g AS (SELECT pair_id, side, turn, coalesce(role, '') AS role, md5(coalesce(text, '')) AS digest,
        '{HEAD}' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS segment FROM s),
o AS (SELECT *, row_number() OVER w - 1 AS position,
        coalesce(sum(length(segment)) OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, digest
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
      FROM g WINDOW w AS (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, digest)),
p AS (SELECT pair_id, position, min(off) AS off FROM o GROUP BY pair_id, position
      HAVING NOT (count(*) = 2 AND min(role) = max(role) AND min(digest) = max(digest))),
e AS (SELECT pair_id, min(position) AS position, min(off) AS off FROM p GROUP BY pair_id),
n AS (SELECT pair_id, count(*) AS turns FROM o WHERE side = 'chosen' GROUP BY pair_id),
x AS (SELECT o.*, e.position IS NULL OR o.position < e.position AS shared, o.off - CASE WHEN e.position IS NULL OR o.position < e.position
        THEN 0 ELSE e.off END AS start, coalesce(e.position, n.turns) AS n_prompt FROM o LEFT JOIN e USING (pair_id) LEFT JOIN n USING (pair_id))
SELECT pair_id, CASE WHEN shared THEN 'prompt' ELSE side END AS part, CAST(position AS INTEGER) AS position, role, segment,
  CAST(start AS BIGINT) AS start, CAST(CASE WHEN NOT shared AND role = 'assistant' THEN start + length(role) + {len(HEAD + MIDDLE)} END AS BIGINT) AS mask_from,
  CAST(CASE WHEN NOT shared AND role = 'assistant' THEN start + length(segment) END AS BIGINT) AS mask_to, CAST(n_prompt AS INTEGER) AS n_prompt
FROM x WHERE NOT shared OR side = 'chosen'
"""
