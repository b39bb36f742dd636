"""Text expressions: mentions, JSON records, fixed-point text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern of a symbol-like word.
MENTION = r"\b([A-Z&]+)\b"


def mentions(message: str | Column) -> Column:
    """All symbol-like words of the upper-cased text, in order.

    Letters and digits outside ASCII are word characters that no symbol holds,
    which ``\\b`` of Java knows less well than this replacement does.
    """
    upper = F.upper(message)
    plain = F.regexp_replace(F.regexp_replace(upper, r"[\p{L}\p{N}&&[^\x00-\x7F]]", "_"), r"[^\x00-\x7F]", " ")
    return F.regexp_extract_all(plain, F.lit(MENTION), F.lit(1))


def first_mention(message: str | Column) -> Column:
    return F.get(mentions(message), F.lit(0))


def two_decimals(value: str | Column) -> Column:
    """The number as text with two decimals, half up on its first six."""
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("decimal(18,6)").cast("decimal(18,2)").cast("string")


def or_na(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("N/A"))


def scores_json(record: str | Column = "algorithm_scores") -> Column:
    return F.to_json(record)


def scores_from_json(text: str | Column) -> Column:
    return F.from_json(text, "trend_signal double, momentum_score double, macd_score double")
