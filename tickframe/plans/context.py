"""Context text for a batch of questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.functions import text

# The wording of the context text.
NO_DATA = "No recommendation data available."
DATE_LINE = "Today's Date: "
LIST_TITLE = "--- Top 5 ML Model (LEM) Recommendations ---"
DETAIL_TITLE = "--- Detailed Scores for %s ---"
TREND_LINE = "- Trend Signal: "
MOMENTUM_LINE = "- Momentum Score: "
MACD_LINE = "- MACD Score: "
NOTE = "(Note: Trend is -1, 0, or 1. Momentum and MACD are 0-100)."


def header(latest: DataFrame, model: str = "LEM") -> DataFrame:
    """One row with the text that all answers share; null text without rows."""
    line = F.concat(F.lit("- Rank "), F.col("rank").cast("string"), F.lit(": "), "symbol",
                    F.lit(", Score: "), text.two_decimals("score"), F.lit("\n"))
    one = latest.groupBy().agg(
        F.max("date").alias("date"),
        F.array_sort(F.collect_list(F.when(F.col("model_type") == model, F.struct("rank", line.alias("line")))))
        .alias("lines"))
    lines = F.array_join(F.transform("lines", lambda r: r["line"]), "")
    return one.select(F.concat(F.lit(DATE_LINE), F.date_format("date", "yyyy-MM-dd"),
                               F.lit("\n" + LIST_TITLE + "\n"), lines).alias("header"))


def symbol_scores(latest: DataFrame) -> DataFrame:
    """One row: the component scores of the recommended symbols, as a map.
    Models agree on them; the model that sorts last is taken."""
    each = latest.groupBy("symbol").agg(F.max_by("algorithm_scores", "model_type").alias("algorithm_scores"))
    return each.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("symbol", "algorithm_scores"))).alias("known"))


def detail(symbol: str = "symbol", scores: str = "algorithm_scores") -> F.Column:
    before, after = DETAIL_TITLE.split("%s")
    return F.concat(
        F.lit("\n" + before), F.col(symbol), F.lit(after + "\n"),
        F.lit(TREND_LINE), text.or_na(F.col(f"{scores}.trend_signal")), F.lit("\n"),
        F.lit(MOMENTUM_LINE), text.or_na(F.col(f"{scores}.momentum_score")), F.lit("\n"),
        F.lit(MACD_LINE), text.or_na(F.col(f"{scores}.macd_score")), F.lit("\n" + NOTE))


def contexts(messages: DataFrame, latest: DataFrame, model: str = "LEM") -> DataFrame:
    """Adds ``context`` to each message: the shared text, and the scores of the
    first mentioned symbol if it is recommended.

    Messages are not moved, so a word that most of them name costs nothing. The
    shared text and the map of recommended symbols are scalar subqueries; every
    text holds the ranked rows anyway, so both are of a text's size.
    """
    asked = messages.withColumn("symbol", text.first_mention("message"))
    known = symbol_scores(latest).scalar()
    found = asked.withColumn("algorithm_scores", F.when(F.col("symbol").isNotNull(), F.try_element_at(known, F.col("symbol"))))
    body = F.when(F.col("algorithm_scores").isNotNull(), detail()).otherwise("")
    shared = header(latest, model).scalar()
    return found.withColumn("context", F.coalesce(F.concat(shared, body), F.lit(NO_DATA))) \
        .select(*messages.columns, "context")


def mentioned(messages: DataFrame, latest: DataFrame, keys=("conv_id", "turn")) -> DataFrame:
    """The recommended symbols each message names anywhere, without moving messages."""
    known = F.map_keys(symbol_scores(latest).scalar())
    named = F.array_intersect(text.mentions("message"), known)
    return messages.select(*keys, F.explode(named).alias("symbol"))
