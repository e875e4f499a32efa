"""Grouped statistics, time grids and tables of a search."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklogs.functions.times import bucket_start, format_time, time_bucket
from sparklogs.operators.events import running_count


@dataclass(frozen=True)
class TimeRule:
    """A window, its buckets and the step of the probes that find the buckets of a grid."""

    window_ms: int
    bucket_ms: int
    probe_ms: int = 5_000


#: The two presets.
PRESETS = {"60": TimeRule(60_000, 5_000), "300": TimeRule(300_000, 10_000)}


@dataclass(frozen=True)
class Stat:
    """`fn` of the field `key`, named fn_key: "count", "sum" or a function from a column to an aggregate (named by `name`)."""

    fn: str | Callable[[Column], Column]
    key: str
    name: str = ""
    number: str = "long"

    @property
    def alias(self) -> str:
        return self.name or f"{self.fn.lower() if isinstance(self.fn, str) else self.fn.__name__}_{self.key}"

    def column(self) -> Column:
        if callable(self.fn):
            return self.fn(F.col(f"`{self.key}`")).alias(self.alias)
        if self.fn.lower() == "count":
            return F.count(F.lit(1)).alias(self.alias)
        if self.fn.lower() == "sum":
            return F.sum(F.col(f"`{self.key}`").try_cast(self.number)).alias(self.alias)
        raise ValueError(f"no statistic {self.fn!r}: count, sum or a function")


def _known(df: DataFrame, keys: list[str]) -> None:
    if unknown := [k for k in keys if k not in df.columns]:
        raise ValueError(f"no such keys: {unknown}")


def group_stats(df: DataFrame, keys: list[str], stats: list[Stat]) -> DataFrame:
    """Statistics by keys; without keys the result is empty."""
    _known(df, keys)
    if not keys:
        return df.where("false").groupBy(F.lit("").alias("_")).agg(*[s.column() for s in stats]).drop("_")
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*[s.column() for s in stats])


def group_stats_by_time(df: DataFrame, keys: list[str], stats: list[Stat], rule: TimeRule, tz: str = "UTC") -> DataFrame:
    """Statistics by bucket label and keys."""
    _known(df, keys)
    return group_stats(df.withColumn("bucket", time_bucket(F.col("timestamp"), rule.bucket_ms, tz)), ["bucket", *keys], stats) if keys else group_stats(df, [], stats)


def group_meta(df: DataFrame, keys: list[str], stats: list[Stat]) -> DataFrame:
    """`group_stats` with gid from 0 in the order of the keys.

    Groups are counted in chunks of the first key and over earlier chunks, so that no
    task needs all of them.
    """
    groups = group_stats(df, keys, stats)
    if not keys:
        return groups.select(F.lit(0).alias("gid"), "*").where("false")
    first = F.col(f"`{keys[0]}`")
    chunk = F.substring(first, 1, 2) if groups.schema[keys[0]].dataType.typeName() == "string" else first
    numbered = running_count(groups, F.lit(1), [], [F.col(f"`{k}`").asc_nulls_first() for k in keys], chunk, "_gid")
    return numbered.select((F.col("_gid") - 1).cast("int").alias("gid"), *[F.col(f"`{c}`") for c in groups.columns])


def time_grid(spark, rule: TimeRule, start_ms: int, tz: str = "UTC") -> DataFrame:
    """(bucket): labels of the buckets that the probes start, start + probe, ... below the window's end fall in."""
    probes = F.sequence(F.lit(0), F.lit(rule.window_ms // rule.probe_ms - 1))
    at = F.transform(probes, lambda i: bucket_start(F.lit(start_ms).cast("long") + i * rule.probe_ms, rule.bucket_ms))
    return spark.range(1).select(F.explode(F.array_distinct(at)).alias("at")).select(format_time(F.col("at"), tz).alias("bucket"))


def match_chart(df: DataFrame, rule: TimeRule, start_ms: int, tz: str = "UTC", weight: str | None = None) -> DataFrame:
    """(bucket, search_count) on the dense grid; rows after its last bucket are in no bucket. A row counts once, or as often as its `weight` says."""
    count = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(time_bucket(F.col("timestamp"), rule.bucket_ms, tz).alias("bucket")).agg(count.alias("n"))
    grid = time_grid(df.sparkSession, rule, start_ms, tz)
    return grid.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("search_count"))


def group_table(df: DataFrame, keys: list[str], stats: list[Stat], rule: TimeRule, start_ms: int, tz: str = "UTC", nested: bool = False) -> DataFrame:
    """(bucket, gid, statistics): for each bucket of the grid the groups seen in it, in order; buckets without any have a null gid.

    nested: (bucket, events array<struct<gid, statistics>>), one row a bucket, groups by gid.
    """
    meta = group_meta(df, keys, [Stat("count", "_")]).select("gid", *[F.col(f"`{k}`") for k in keys])
    timed = group_stats_by_time(df, keys, stats, rule, tz)
    names = [s.alias for s in stats]
    both = timed.join(meta, [timed[f"`{k}`"].eqNullSafe(meta[f"`{k}`"]) for k in keys]).select("bucket", "gid", *[F.col(f"`{n}`") for n in names])
    long = time_grid(df.sparkSession, rule, start_ms, tz).join(both, "bucket", "left")
    if not nested:
        return long.orderBy("bucket", "gid")
    item = F.when(F.col("gid").isNotNull(), F.struct("gid", *[F.col(f"`{n}`") for n in names]))
    return long.groupBy("bucket").agg(F.sort_array(F.collect_list(item)).alias("events")).orderBy("bucket")


def log_table(df: DataFrame, limit: int = 100, tz: str = "UTC", order: str = "seq") -> DataFrame:
    """The latest rows: by second, newest first, ties by latest arrival. Columns: timestamp, system fields, extracted fields, message."""
    latest = df.orderBy(F.floor(F.col("timestamp") / 1000).desc(), F.col(order).desc()).limit(limit)
    system = [c for c in ("level", "location", "host") if c in df.columns]
    fields = [c for c in df.columns if c not in ("timestamp", "message", "level", "location", "host")]
    return latest.select(format_time(F.col("timestamp"), tz).alias("timestamp"), *system, *[F.col(f"`{c}`") for c in fields], "message")


def trim_buffer(df: DataFrame, max_rows: int = 500, keep: int = 200, order: str = "seq") -> DataFrame:
    """The latest `keep` rows if there are `max_rows` or more, else all. At most `max_rows` rows are ever sorted."""
    latest = df.orderBy(F.col(order).desc()).limit(max_rows).withColumn("_n", F.row_number().over(Window.orderBy(F.col(order).desc())))
    full = latest.agg((F.count(F.lit(1)) >= max_rows).alias("_full"))
    return latest.join(F.broadcast(full)).where(~F.col("_full") | (F.col("_n") <= keep)).drop("_n", "_full")


def sample_head(df: DataFrame, n: int = 10, order: str = "seq") -> DataFrame:
    return df.orderBy(order).limit(n)
