"""Mentions and context texts."""

import pytest

from tickframe.functions import text
from tickframe.operators import ranking
from tickframe.plans import context
from tickframe.schemas import RECOMMENDATIONS

from .helpers import day, stocks


@pytest.fixture
def latest(spark):
    rows = [(day(1), 1, 1, 61.005, "LEM", (0.0, 45.67, 100.0), day(1)), (day(1), 2, 2, 50.0, "LEM", (1.0, 30.0, 0.0), day(1)),
            (day(1), 1, 3, 80.0, "SHE", (0.0, 20.0, None), day(0)), (day(0), 1, 4, 80.0, "SHE", (0.0, 20.0, 0.0), day(0))]
    names = stocks(spark, {1: "AAAB", 2: "M&M", 3: "BAJAJ-AUTO", 4: "OLD"})
    return ranking.latest_recommendations(spark.createDataFrame(rows, RECOMMENDATIONS), names)


def messages(spark, texts):
    return spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "conv_id int, turn int, message string")


@pytest.mark.parametrize("said, words", [
    ("why AAAB", ["WHY", "AAAB"]),
    ("AAAB?", ["AAAB"]),
    ("m&m", ["M&M"]),
    ("BAJAJ-AUTO", ["BAJAJ", "AUTO"]),
    ("x1 2y", []),
    ("étion TCS", ["TCS"]),
    ("“TCS” — good", ["TCS", "GOOD"]),
    ("日本TCS", []),
    ("", []),
])
def test_mentions(spark, said, words):
    assert messages(spark, [said]).select(text.mentions("message")).first()[0] == words


def test_context_text(spark, latest):
    got = [r.context for r in context.contexts(messages(spark, ["AAAB?", "why AAAB", "", "m&m", "OLD"]), latest)
           .orderBy("conv_id").collect()]
    head = ("Today's Date: 2001-01-02\n--- Top 5 ML Model (LEM) Recommendations ---\n"
            "- Rank 1: AAAB, Score: 61.01\n- Rank 2: M&M, Score: 50.00\n")
    assert got[0] == (head + "\n--- Detailed Scores for AAAB ---\n- Trend Signal: 0.0\n- Momentum Score: 45.67\n"
                      "- MACD Score: 100.0\n(Note: Trend is -1, 0, or 1. Momentum and MACD are 0-100).")
    assert got[1] == got[2] == got[4] == head
    assert "--- Detailed Scores for M&M ---" in got[3]


def test_messages_are_not_moved(spark, latest, tmp_path):
    messages(spark, ["AAAB"]).write.parquet(str(tmp_path / "m"))
    asked = spark.read.parquet(str(tmp_path / "m"))
    for df in (context.contexts(asked, latest), context.mentioned(asked, latest)):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        # Subqueries hang to the side of a ":"; the rest is the path of the messages.
        path = [line for line in lines if ":" not in line.split("+-")[0]]
        assert "FileScan" in path[-1] and not any("Exchange" in line or "Join" in line for line in path)


def test_missing_component_is_named(spark, latest):
    assert latest.filter("symbol = 'BAJAJ-AUTO'").select(context.detail()).first()[0].count("N/A") == 1


def test_without_recommendations(spark, latest):
    got = context.contexts(messages(spark, ["AAAB"]), latest.limit(0)).first()
    assert got.context == "No recommendation data available."


def test_any_mention(spark, latest):
    got = context.mentioned(messages(spark, ["why AAAB and m&m, AAAB", "none", "OLD"]), latest)
    assert sorted((r.conv_id, r.symbol) for r in got.collect()) == [(0, "AAAB"), (0, "M&M")]


def test_scores_round_trip(spark, latest):
    df = latest.select("algorithm_scores", text.scores_from_json(text.scores_json()).alias("back"))
    assert all(r[0] == r[1] for r in df.collect())
