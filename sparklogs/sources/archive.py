"""The archive: JSON lines in a folder per UTC day, files by start time and topic, rolled by size."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.functions.times import DAY_MS, archive_path, path_timestamp, path_topic, utc_day
from sparklogs.operators.segments import MAX_BYTES, assign_segments
from sparklogs.schemas import ARCHIVE_INDEX, LOG
from sparklogs.shared import checkpoint, children, exists, get_text, move, put_new, remove
from sparklogs.sources.files import _decoded


#: Versions of the index before the last one that stay, and files that are renamed at a time.
KEPT_VERSIONS, MOVES = 3, 16
#: Tasks a core that write segments: their number counts, of which Spark knows nothing when it puts small tasks together.
WRITERS = 4
#: A segment is a folder with the name of the file it stands for; Spark's writers add files to it.
_FILE = "(.*/\\d{4}-\\d{2}-\\d{2}/\\d{8}T\\d{6}\\.\\d{3}Z\\.[^/]*)/([^/]+)$"


def scan_archive(spark: SparkSession, base: str, without: str | None = None, newest_only: bool = False) -> DataFrame:
    """ARCHIVE_INDEX of what is under `base`: start, topic, day, path, bytes and newest event of each segment.

    Files that the batch `without` wrote don't count. Starts and sizes come from
    the list of files; the newest event takes the bodies, with `newest_only` those of
    the last segment of each topic alone (null for others), which is all that
    rolling asks for.
    """
    if not exists(spark, base):
        return spark.createDataFrame([], ARCHIVE_INDEX)
    mine = F.lit(True) if without is None else ~F.regexp_extract("file", _FILE, 2).startswith(f"{without}-")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select(_decoded(F.col("path")).alias("file"), "length").where(F.col("file").rlike(_FILE) & mine)
    sizes = files.groupBy(F.regexp_extract("file", _FILE, 1).alias("path")).agg(F.sum("length").alias("size"))
    sizes = sizes.withColumns({"start_ts": path_timestamp(F.col("path")), "topic": path_topic(F.col("path"))})
    bodies = [base]
    if newest_only:
        bodies = [r.path for r in sizes.groupBy("topic").agg(F.max_by("path", "start_ts").alias("path")).collect()]  # one a topic
        if not bodies:
            return spark.createDataFrame([], ARCHIVE_INDEX)
    logs = spark.read.schema(LOG).option("recursiveFileLookup", True).json(bodies)
    logs = logs.select("timestamp", _decoded(F.col("_metadata.file_path")).alias("file")).where(F.col("file").rlike(_FILE) & mine)
    newest = logs.groupBy(F.regexp_extract("file", _FILE, 1).alias("path")).agg(F.max("timestamp").alias("recent_ts"))
    return sizes.join(newest, "path", "left").select("start_ts", "topic", utc_day(F.col("start_ts")).alias("day"), "path", "size", "recent_ts")


def _versions(spark: SparkSession, base: str) -> list[str]:
    return sorted((n for n in children(spark, f"{base}/_index/done") if n.isdigit()), reverse=True)


def load_index(spark: SparkSession, base: str, without: str | None = None) -> DataFrame | None:
    """ARCHIVE_INDEX as the last write left it, or as it was before the batch `without`; None if no index is kept.

    One version is read; nothing of the archive is listed or opened.
    """
    base = base.rstrip("/")
    for n in _versions(spark, base):
        entry = json.loads(get_text(spark, f"{base}/_index/done/{n}"))
        if entry["batch"] != without:
            found = spark.read.schema(ARCHIVE_INDEX).parquet(f"{base}/_index/data/{entry['data']}")
            return found.withColumn("path", F.concat(F.lit(f"{base}/"), "path"))
    return None


def _is_last(spark: SparkSession, base: str, batch: str) -> bool:
    """Whether the last version of the index is the one that `batch` left."""
    done = _versions(spark, base)
    return bool(done) and json.loads(get_text(spark, f"{base}/_index/done/{done[0]}"))["batch"] == batch


def _keep_index(placed: DataFrame, index: DataFrame, base: str, batch: str) -> None:
    """The next version of the index: `index` and what `placed (topic, segment_ts, path, timestamp, value)` adds."""
    spark = placed.sparkSession
    done = _versions(spark, base)
    added = placed.groupBy("path").agg(F.first("segment_ts").alias("start_ts"), F.first("topic").alias("topic"), F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + 1).alias("size"), F.max("timestamp").alias("recent_ts"))
    both = index.select(F.substring_index("path", "/", -2).alias("path"), "start_ts", "topic", "size", "recent_ts").unionByName(added)
    now = both.groupBy("path").agg(F.first("start_ts").alias("start_ts"), F.first("topic").alias("topic"), F.sum("size").alias("size"), F.max("recent_ts").alias("recent_ts"))
    data = str(uuid.uuid4())
    now.select("start_ts", "topic", utc_day(F.col("start_ts")).alias("day"), "path", "size", "recent_ts").coalesce(1).write.parquet(f"{base}/_index/data/{data}")
    if not put_new(spark, f"{base}/_index/done/{int(done[0]) + 1 if done else 0:012d}", json.dumps({"batch": batch, "data": data})):
        raise RuntimeError(f"two writers of {base} at a time")
    for old in done[KEPT_VERSIONS:]:
        entry = json.loads(get_text(spark, f"{base}/_index/done/{old}"))
        remove(spark, f"{base}/_index/done/{old}")
        remove(spark, f"{base}/_index/data/{entry['data']}")


def write_archive(messages: DataFrame, base: str, max_bytes: int = MAX_BYTES, order: str = "seq", per_topic: bool = True, batch: str | None = None) -> DataFrame:
    """Appends `messages (topic, timestamp, value, <order>)` to their segments; returns the rows with segment_ts and path, as they were placed.

    Rows of a segment are dealt to one task and sorted by arrival, so that each
    write adds one file to a segment. `batch` names the write: the same messages
    written again under one name, whole or after a part of the files has been
    moved, leave the archive as one write does; a batch in the last version of the index
    has all its files, and no file is written for it again. What is there is known from the
    index that each write leaves (see `load_index`); an archive without one is
    listed once. One writer at a time.
    """
    spark = messages.sparkSession
    batch, base = batch or str(uuid.uuid4()), base.rstrip("/")
    index = load_index(spark, base, batch)
    index = checkpoint(scan_archive(spark, base, batch)) if index is None else index
    found = assign_segments(messages, max_bytes, index, order, per_topic)
    placed = checkpoint(found.withColumn("path", archive_path(F.col("topic"), F.col("segment_ts"))))
    if _is_last(spark, base, batch):
        return placed
    day, name = F.substring_index("path", "/", 1), F.substring_index("path", "/", -1)
    out = placed.select(day.alias("day"), name.alias("segment"), F.col(order).alias("_order"), "value")
    out = out.repartition(WRITERS * spark.sparkContext.defaultParallelism, "day", "segment").sortWithinPartitions("day", "segment", "_order")
    staging = f"{base}/_staging-{batch}"
    out.drop("_order").write.mode("overwrite").partitionBy("day", "segment").text(staging)
    _move(spark, staging, base, batch)
    _keep_index(placed, index, base, batch)
    return placed


def _move(spark: SparkSession, staging: str, base: str, batch: str) -> None:
    """Renames day=D/segment=S/part files to D/S/<batch>-<number>, of which there is one a segment, many at a time, then drops what is left of the staging folder."""

    def segment(day: str, name: str) -> None:
        folder = f"{staging}/{day}/{name}"
        parts = sorted(n for n in children(spark, folder) if n.startswith("part-"))
        for k, part in enumerate(parts):
            move(spark, f"{folder}/{part}", f"{base}/{day.split('=', 1)[1]}/{name.split('=', 1)[1]}/{batch}-{k}")

    days = [d for d in children(spark, staging) if d.startswith("day=")]
    with ThreadPoolExecutor(MOVES) as pool:
        for done in [pool.submit(segment, day, name) for day in days for name in children(spark, f"{staging}/{day}")]:
            done.result()
    remove(spark, staging)


def read_archive(spark: SparkSession, base: str, from_ms: int, to_ms: int) -> DataFrame:
    """LOG rows with from <= timestamp < to; only folders of their days are read."""
    first, last = from_ms // DAY_MS, (to_ms - 1) // DAY_MS
    days = [r.d for r in spark.range(first, last + 1).select(F.date_format(F.date_from_unix_date(F.col("id").cast("int")), "yyyy-MM-dd").alias("d")).collect()]
    there = [f"{base.rstrip('/')}/{d}" for d in days if exists(spark, f"{base.rstrip('/')}/{d}")]
    if not there:
        return spark.createDataFrame([], LOG)
    logs = spark.read.schema(LOG).option("recursiveFileLookup", True).json(there)
    return logs.where((F.col("timestamp") >= from_ms) & (F.col("timestamp") < to_ms))
