"""The search job: filter, window, extraction, and four tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklogs.operators import stats as S
from sparklogs.operators.extract import Rule, extract_fields
from sparklogs.operators.filters import drop_incomplete, keyword_match, search_filter, time_filter


@dataclass(frozen=True)
class SearchSpec:
    """What a search asks: keyword, rules of extraction, group keys, statistics and the time rule, which it must have."""

    keyword: str
    time_rule: S.TimeRule
    extracts: list[Rule] = field(default_factory=list)
    keys: list[str] = field(default_factory=list)
    stats: list[S.Stat] = field(default_factory=list)
    conditions: list[Column] = field(default_factory=list)


def matches(df: DataFrame, spec: SearchSpec, start_ms: int) -> DataFrame:
    """Rows that match, in the window, with all fields extracted."""
    found = search_filter(df, [keyword_match(F.col("message"), spec.keyword), *spec.conditions])
    return drop_incomplete(extract_fields(time_filter(found, start_ms, spec.time_rule.window_ms), spec.extracts))


def log_search(df: DataFrame, spec: SearchSpec, start_ms: int | None = None, tz: str = "UTC", limit: int = 100, now_ms: Callable[[], int] | None = None) -> dict[str, DataFrame]:
    """matchchart, logtable, grouptable and meta of the window from `start_ms`, by default one window before now.

    `df` has the LOG columns and seq, the order of arrival. Each table is a plan of
    its own over the matching rows; see `kept_search` for all four.
    """
    if start_ms is None:
        start_ms = (now_ms or (lambda: int(time.time() * 1000)))() - spec.time_rule.window_ms
    return _tables(matches(df, spec, start_ms), spec, start_ms, tz, limit)


@contextmanager
def kept_search(df: DataFrame, spec: SearchSpec, start_ms: int | None = None, tz: str = "UTC", limit: int = 100, now_ms: Callable[[], int] | None = None) -> Iterator[dict[str, DataFrame]]:
    """`log_search` whose matching rows are found once and kept in memory and on disk until the block ends."""
    if start_ms is None:
        start_ms = (now_ms or (lambda: int(time.time() * 1000)))() - spec.time_rule.window_ms
    found = matches(df, spec, start_ms).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield _tables(found, spec, start_ms, tz, limit)
    finally:
        found.unpersist()


def _tables(found: DataFrame, spec: SearchSpec, start_ms: int, tz: str, limit: int) -> dict[str, DataFrame]:
    return {
        "matchchart": S.match_chart(found, spec.time_rule, start_ms, tz),
        "logtable": S.log_table(found, limit, tz),
        "grouptable": S.group_table(found, spec.keys, spec.stats, spec.time_rule, start_ms, tz) if spec.keys else S.time_grid(found.sparkSession, spec.time_rule, start_ms, tz),
        "meta": S.group_meta(found, spec.keys, spec.stats),
    }
