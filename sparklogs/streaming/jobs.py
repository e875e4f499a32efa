"""Continuous jobs: collect, archive, search, grouped series and flows."""

from __future__ import annotations

import time
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparklogs.functions.times import bucket_start
from sparklogs.operators.extract import extract_fields
from sparklogs.operators.filters import drop_incomplete, keyword_match, search_filter
from sparklogs.operators.segments import MAX_BYTES
from sparklogs.operators.stats import Stat, group_meta, group_table, log_table, match_chart, time_grid
from sparklogs.operators.traffic import parse_transfers
from sparklogs.plans.search import SearchSpec
from sparklogs.shared import children, remove
from sparklogs.sources.archive import write_archive
from sparklogs.sources.files import TopicSpec, collect_topics, load_manifest, save_manifest
from sparklogs.sources.topics import from_topic, to_topic, write_topic

_STATE = "timestamp"


def run_collector(spark: SparkSession, topics: dict[str, TopicSpec], manifest_dir: str, host: str = "", tz: str = "UTC", folder: str | None = None, servers: str | None = None, once: bool = True, pause_s: float = 5.0) -> None:
    """Each cycle reads what is new, publishes it and then saves the manifest: at least once, never lost.

    A batch job per cycle, because a file stream never sees a file grow.
    """
    while True:
        events, manifest = collect_topics(spark, topics, load_manifest(spark, manifest_dir), host, tz)
        write_topic(to_topic(events, F.col("topic"), ["file_ord", "offset"]), servers, folder)
        save_manifest(manifest, manifest_dir)
        if once:
            return
        time.sleep(pause_s)


def stream_archive(stream: DataFrame, base: str, checkpoint: str, max_bytes: int = MAX_BYTES, trigger: dict | None = None) -> StreamingQuery:
    """`stream (topic, value[, offset])` to the archive: each micro-batch is dealt to segments by the index that the last one left.

    Messages of a batch are in the order of their offsets, as `read_messages` gives
    them, whatever tasks read them: a micro-batch that runs again after a failure
    leaves what one run leaves. Without offsets the order is that of the tasks, and
    that holds only if they read the same parts again.
    """
    name = f"{zlib.crc32(checkpoint.encode()):08x}"

    def batch(df: DataFrame, number: int) -> None:
        numbered = df.withColumn("seq", F.col("offset") if "offset" in df.columns else F.monotonically_increasing_id())
        stamped = numbered.withColumn("timestamp", F.get_json_object("value", "$.timestamp").try_cast("long")).persist()  # it is gone over several times
        write_archive(stamped.where("timestamp IS NOT NULL"), base, max_bytes, batch=f"{name}.{number}")
        stamped.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def stream_late_split(stream: DataFrame, out: str, checkpoint: str, delay_ms: int = 30_000, trigger: dict | None = None) -> StreamingQuery:
    """Tells events of `stream (topic, value)` that come too late from those in time, under out/late and out/in_time, with the batch they came in.

    An event is late if it is older than the newest time of its topic in all earlier
    batches by more than `delay_ms`; those of its own batch don't count, as what is
    in a batch came together. The newest times, a row a topic, are kept for each
    batch, so that one that runs again decides as it did. Events without a time, as
    of broken messages, are in neither.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        rows = from_topic(df, [c for c in ("topic", "offset") if c in df.columns]).where("timestamp IS NOT NULL").persist()
        known = [int(n) for n in children(spark, f"{out}/_newest") if int(n) < number]
        before = spark.createDataFrame([], "topic string, newest long") if not known else spark.read.parquet(f"{out}/_newest/{max(known)}")
        both = rows.join(F.broadcast(before), "topic", "left")
        late = F.coalesce(F.col("timestamp") < F.col("newest") - delay_ms, F.lit(False))
        for name, part in (("late", late), ("in_time", ~late)):
            both.where(part).drop("newest").write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        newest = rows.select("topic", F.col("timestamp").alias("newest")).unionByName(before).groupBy("topic").agg(F.max("newest").alias("newest"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{out}/_newest/{number}")
        rows.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def _panes(rows: DataFrame, spec: SearchSpec) -> DataFrame:
    """(minute, timestamp, keys, _n, statistics): rows by minute, bucket start and keys, in sums that can be added up."""
    at = bucket_start(F.col("timestamp"), spec.time_rule.bucket_ms)
    keys = [F.col(f"`{k}`") for k in spec.keys]
    return rows.withColumn("_at", at).groupBy("minute", "_at", *keys).agg(F.count(F.lit(1)).alias("_n"), *[s.column() for s in spec.stats]).withColumnRenamed("_at", "timestamp")


def _latest(rows: DataFrame, limit: int) -> DataFrame:
    """The rows of each minute that can be among the latest `limit`."""
    order = Window.partitionBy("minute").orderBy(F.floor(F.col("timestamp") / 1000).desc(), F.col("seq").desc())
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit).drop("_rank")


def stream_search(stream: DataFrame, spec: SearchSpec, out: str, checkpoint: str, tz: str = "UTC", trigger: dict | None = None, now_ms=lambda: int(time.time() * 1000), limit: int = 100) -> StreamingQuery:
    """The search of a trailing window, run again for every micro-batch of `stream (topic, value[, offset])`.

    A micro-batch adds its own panes, counts and sums by minute, bucket and keys, and
    the latest rows of each minute. A run puts the panes of the window's whole
    minutes together; rows, which are sorted by minute, are read again only for the
    minutes that its ends cut.
    What lies before the window isn't kept, and micro-batches that do are dropped.
    One that runs again replaces its own part. Results are written under
    out/<table>/query_time=<ms>. Statistics must be counts and sums, which add up.
    """
    if odd := [s.alias for s in spec.stats if callable(s.fn)]:
        raise ValueError(f"statistics that don't add up over minutes: {odd}")
    rows = from_topic(stream, [c for c in ("offset",) if c in stream.columns])
    found = drop_incomplete(extract_fields(search_filter(rows, [keyword_match(F.col("message"), spec.keyword), *spec.conditions]), spec.extracts))
    add = [Stat(F.sum, s.alias, s.alias) for s in spec.stats]

    def batch(df: DataFrame, number: int) -> None:
        spark, now = df.sparkSession, now_ms()
        start = now - spec.time_rule.window_ms
        first = start - start % 60_000
        place = F.col("offset") if "offset" in df.columns else F.lit(number).cast("long") * (1 << 40) + F.monotonically_increasing_id() % (1 << 40)
        minute = bucket_start(F.col(_STATE), 60_000)
        mine = df.withColumns({"seq": place, "minute": minute}).drop("offset").where(F.col("minute") >= first).persist()
        parts = {"_rows": mine, "_panes": _panes(mine, spec), "_latest": _latest(mine, limit)}
        for name, part in parts.items():
            part.sortWithinPartitions("minute").write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        read = lambda name: spark.read.schema(parts[name].schema).parquet(f"{out}/{name}/*")
        whole = (F.col("minute") > start) & (F.col("minute") <= now - 60_000)
        cut = read("_rows").where((F.col("minute") <= start) | (F.col("minute") > now - 60_000)).where((F.col("timestamp") > start) & (F.col("timestamp") < now))
        panes = read("_panes").where(whole).unionByName(_panes(cut, spec)).drop("minute")
        latest = read("_latest").where(whole).unionByName(cut).drop("minute")
        rule = spec.time_rule
        tables = {
            "matchchart": match_chart(panes, rule, start, tz, "_n"),
            "logtable": log_table(latest, limit, tz),
            "grouptable": group_table(panes, spec.keys, add, rule, start, tz) if spec.keys else time_grid(spark, rule, start, tz),
            "meta": group_meta(panes, spec.keys, add),
        }
        for name, result in tables.items():
            result.write.mode("overwrite").parquet(f"{out}/{name}/query_time={now}")
        mine.unpersist()
        batches = spark.read.schema("minute long, batch long").option("basePath", f"{out}/_panes").parquet(f"{out}/_panes")
        live = {f"batch={r.batch}" for r in batches.where(F.col("minute") >= first).select("batch").distinct().collect()}
        for old in children(spark, f"{out}/_rows"):
            if old != f"batch={number}" and old not in live:
                for name in parts:
                    remove(spark, f"{out}/{name}/{old}")

    return found.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def _event_time(df: DataFrame, delay: str) -> DataFrame:
    return df.withColumn("event_time", F.timestamp_millis("timestamp")).withWatermark("event_time", delay)


def stream_group_stats(stream: DataFrame, keys: list[str], stats: list[Stat], bucket: str = "5 seconds", delay: str = "30 seconds") -> DataFrame:
    """(window_start ms, keys, statistics) of tumbling windows over LOG rows; windows close `delay` after their end."""
    timed = _event_time(stream, delay).groupBy(F.window("event_time", bucket).alias("w"), *keys).agg(*[s.column() for s in stats])
    return timed.select(F.unix_millis("w.start").alias("window_start"), *keys, *[F.col(s.alias) for s in stats])


def stream_flow_totals(stream: DataFrame, window: str = "30 seconds", slide: str = "5 seconds", delay: str = "30 seconds", now: Column | None = None, ahead_ms: int = 1_000) -> DataFrame:
    """(window_start, window_end, src, dest, dataflow) of sliding windows over LOG rows; rows far ahead of the clock go."""
    clock = F.unix_millis(F.current_timestamp()) if now is None else now
    rows = parse_transfers(stream).where(F.col("timestamp") < clock + ahead_ms)
    flows = _event_time(rows, delay).groupBy(F.window("event_time", window, slide).alias("w"), F.col("srcip").alias("src"), F.col("destip").alias("dest")).agg(F.sum("filesize").alias("dataflow"))
    return flows.select(F.unix_millis("w.start").alias("window_start"), F.unix_millis("w.end").alias("window_end"), "src", "dest", "dataflow")
