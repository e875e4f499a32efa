"""Epoch milliseconds and text. Zones are arguments; the session's zone has no part in it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
DAY_MS = 86_400_000


def millis(local: Column, tz: str = "UTC") -> Column:
    """Epoch ms of a zone-less timestamp that shows the time in `tz`."""
    utc = local if tz == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), utc)


def local_time(ms: Column, tz: str = "UTC") -> Column:
    """Zone-less timestamp of epoch ms as shown in `tz`."""
    utc = F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH))
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def parse_time(text: Column, tz: str = "UTC") -> Column:
    """Epoch ms of `yyyy-MM-dd HH:mm:ss,SSS` (or with a point) in `tz`; null if there is no such time."""
    return millis(F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp_ntz"), tz)


def format_time(ms: Column, tz: str = "UTC") -> Column:
    """`yyyy-MM-dd HH:mm:ss` in `tz`."""
    return F.substring(local_time(ms, tz).cast("string"), 1, 19)


def bucket_start(ms: Column, step_ms: int) -> Column:
    return ms - F.pmod(ms, F.lit(step_ms))


def time_bucket(ms: Column, step_ms: int, tz: str = "UTC") -> Column:
    """The start of the bucket that holds `ms`, as text in `tz`."""
    return format_time(bucket_start(ms, step_ms), tz)


def utc_day(ms: Column) -> Column:
    """`yyyyMMdd` in UTC."""
    return F.replace(F.substring(local_time(ms).cast("string"), 1, 10), F.lit("-"), F.lit(""))


def archive_path(topic: Column, ms: Column) -> Column:
    """`yyyy-MM-dd/yyyyMMddTHHmmss.SSSZ.topic` in UTC."""
    text = format_time(ms)
    clock = F.replace(F.substring(text, 12, 8), F.lit(":"), F.lit(""))
    part = F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("/"), utc_day(ms), F.lit("T"), clock, F.lit("."), part, F.lit("Z."), topic)


def path_timestamp(path: Column) -> Column:
    """Start ms that the last part of an archive path shows; null for other paths."""
    name = "(\\d{4})(\\d{2})(\\d{2})T(\\d{2})(\\d{2})(\\d{2})\\.(\\d{3})Z\\.[^/]*$"
    g = [F.regexp_extract(path, name, i) for i in range(1, 8)]
    return parse_time(F.concat(g[0], F.lit("-"), g[1], F.lit("-"), g[2], F.lit(" "), g[3], F.lit(":"), g[4], F.lit(":"), g[5], F.lit("."), g[6]))


def path_topic(path: Column) -> Column:
    return F.regexp_extract(path, "\\d{8}T\\d{6}\\.\\d{3}Z\\.([^/]*)$", 1)
