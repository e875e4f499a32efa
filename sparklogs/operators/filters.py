"""Row filters of log tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyword_match(message: Column, query: str) -> Column:
    """Whether the trimmed, lower-cased query, read as a regex, is in the lower-cased message. Lower-casing also turns \\S into \\s."""
    word = query.strip().lower()
    return F.lit(True) if not word else F.lower(message).rlike(word)


def keyword_filter(df: DataFrame, query: str) -> DataFrame:
    """An empty query keeps all rows."""
    return df.where(keyword_match(F.col("message"), query)) if query.strip() else df


def search_filter(df: DataFrame, conditions: list[Column]) -> DataFrame:
    """Rows that meet every condition; none keeps all."""
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df


def time_filter(df: DataFrame, start_ms: int, window_ms: int) -> DataFrame:
    """start < timestamp < start + window, both strict."""
    ts = F.col("timestamp")
    return df.where((ts > F.lit(start_ms).cast("long")) & (ts < F.lit(start_ms + window_ms).cast("long")))


def recent(df: DataFrame, now_ms: int, back_ms: int = 30_000, ahead_ms: int = 1_000) -> DataFrame:
    """now - back < timestamp < now + ahead; null times go."""
    return time_filter(df, now_ms - back_ms, back_ms + ahead_ms)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows with a null in any column go."""
    return df.dropna("any")


#: Texts of data-node lines that are noise to a search.
NOISE = ["clienttrace", "Received block"]


def drop_noise(df: DataFrame, patterns: list[str] = NOISE) -> DataFrame:
    """Rows go whose message has any of the patterns; null messages stay."""
    return df.where(~F.coalesce(F.col("message").rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False)))
