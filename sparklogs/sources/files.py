"""Rolling log files: discovery, lines with byte offsets, manifests."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparklogs.functions.parsing import parse_log_line
from sparklogs.operators.events import parse_log_events
from sparklogs.schemas import MANIFEST
from sparklogs.shared import checkpoint, children, exists

#: Bytes of a split of a file, and of it that a task holds at a time.
SPLIT_BYTES, BLOCK_BYTES = 16 << 20, 1 << 20

Order = str | Callable[[Column], list[Column]]


def _sort_keys(path: Column, order: Order) -> list[Column]:
    if callable(order):
        return order(path)
    if order == "daily":  # by name, the live file last
        return [path.endswith(".log"), path]
    if order == "numeric":  # .log.N from large N down, then .log
        number = F.when(path.endswith(".log"), F.lit(0)).when(path.rlike(r"[.]log[.]\d+$"), F.regexp_extract(path, r"[.]log[.](\d+)$", 1).cast("int"))
        return [F.coalesce(number, F.raise_error(F.concat(F.lit("not a rolling file: "), path)).cast("int")).desc()]
    raise ValueError(f"no order {order!r}")


def _decoded(path: Column) -> Column:
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "/")


def _listed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, size, modified) of the files below some paths, from the file system's lists alone. The list is taken now and stays."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return found.select(_decoded(F.col("path")).alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def _right_under(base: str, pattern: str) -> Column:
    root, name = base.rstrip("/").removeprefix("file://"), F.substring_index("path", "/", -1)  # Spark may ask it of each line
    return name.rlike(pattern) & (F.concat(F.lit(root + "/"), name) == F.col("path"))


def discover_files(spark: SparkSession, base: str, pattern: str, order: Order = "daily") -> DataFrame:
    """(path, size, modified, file_ord): regular files right under `base` whose name the regex finds, from oldest to newest.

    Numbering sees one row a file. No file body is read.
    """
    rank = F.row_number().over(Window.orderBy(*_sort_keys(F.col("path"), order)))
    return _listed(spark, base).where(_right_under(base, pattern)).withColumn("file_ord", rank)


def _open(path: str):
    """A file of any store that Arrow knows, for reading in parts."""
    if path.startswith("/"):
        return fs.LocalFileSystem().open_input_file(path)
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """`rows` over all tasks. Their number is given, as small rows that stand for much work would be put together in one task otherwise."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, *keys)


def _lines_of(file, start: int, stop: int, size: int, meter=None):
    """(offset, line) of the lines that begin in [start, stop) of a file of `size` bytes, \\n not included."""
    at = max(0, start - 1)
    file.seek(at)
    begin = None if start else 0  # where the open line begins; None before the first line end
    rest: list[bytes] = []
    while at < size and (at < stop or begin is not None):
        block = file.read(min(BLOCK_BYTES, size - at))
        if not block:
            break
        if meter is not None:
            meter.add(len(block))
        parts = block.split(b"\n")
        for k, part in enumerate(parts):
            if k:
                if begin is not None:
                    yield begin, b"".join(rest)
                rest = []
                begin = at if at < stop else None
                if begin is None:
                    return
            if begin is not None:
                rest.append(part)
            at += len(part) + (k < len(parts) - 1)
    if begin is not None and begin < size:
        yield begin, b"".join(rest)


def _batches(rows, names: list[str]):
    """Arrow batches of bounded size of (key columns..., offset, line)."""
    held, size = [], 0

    def batch():
        columns = list(zip(*held, strict=True))
        kinds = {"offset": pa.int64(), "line": pa.binary(), "file_ord": pa.int32()}
        return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns, strict=True)], names)

    for row in rows:
        held.append(row)
        size += len(row[-1]) + 50
        if size >= BLOCK_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def read_ranges(files: DataFrame, meter=None) -> DataFrame:
    """(path, offset, line) of `files (path, size[, read_from])`: the lines that begin at `read_from` or after it, with their byte offsets.

    Only bytes from `read_from` on are read, up to the size that is given, so that a
    file that grows meanwhile makes no difference. Files are dealt to tasks in splits
    of `SPLIT_BYTES`; a split gives the lines that begin in it, wherever they end.
    Text is UTF-8, line ends are \\n; a \\r before it stays in the line. Rows with a
    null `read_from` aren't opened. `meter`: an accumulator that counts bytes read.
    """
    start = F.col("read_from") if "read_from" in files.columns else F.lit(0).cast("long")
    asked = files.select("path", "size", start.alias("start")).where("start < size")
    split = F.explode(F.sequence("start", F.col("size") - 1, F.lit(SPLIT_BYTES))).alias("from")
    splits = asked.select("path", "size", split).withColumn("to", F.least(F.col("from") + SPLIT_BYTES, "size"))

    def each(batches):
        def rows():
            for batch in batches:
                for path, size, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    with _open(path) as file:
                        for offset, line in _lines_of(file, start, stop, size, meter):
                            yield path, offset, line

        yield from _batches(rows(), ["path", "offset", "line"])

    dealt = _dealt(splits.select("path", "size", "from", "to"), "path", "from")
    return dealt.mapInArrow(each, "path string, offset long, line binary").withColumn("line", F.col("line").cast("string"))


def read_lines(spark: SparkSession, paths: list[str], starts: DataFrame | None = None) -> DataFrame:
    """(file, offset, line): lines of files with their byte offsets; with `starts (path, read_from)`, of the files there from there on. See `read_ranges`."""
    if not paths:
        return spark.createDataFrame([], "file string, offset long, line string")
    files = _listed(spark, paths)
    if starts is not None:
        files = files.join(F.broadcast(starts.select("path", "read_from").where("read_from IS NOT NULL")), "path")
    return read_ranges(files).withColumnRenamed("path", "file")


def first_lines(files: DataFrame, meter=None) -> DataFrame:
    """(path, first_line) of `files (path, size)` that aren't empty: one block of a file is read, or as many as its first line takes."""

    def each(batches):
        for batch in batches:
            paths, lines = [], []
            for path, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with _open(path) as file:
                    for _, line in _lines_of(file, 0, 1, size, meter):
                        paths.append(path)
                        lines.append(line)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lines, pa.binary())], ["path", "first_line"])

    dealt = _dealt(files.where("size > 0").select("path", "size"), "path")
    return dealt.mapInArrow(each, "path string, first_line binary").withColumn("first_line", F.col("first_line").cast("string"))


def build_manifest(spark: SparkSession, files: DataFrame, topic: str | None = None, old: DataFrame | None = None, meter=None) -> DataFrame:
    """MANIFEST of `files (path, size, file_ord[, modified, topic])`: first line, path and size; empty files are left out, of equal first lines of a topic the last file stays.

    A file that `old`, an earlier manifest, has with the same path, size and time of
    change keeps its first line and isn't opened; of others the first line is read,
    no more.
    """
    named = files.withColumn("topic", F.lit(topic)) if topic is not None else files
    if "modified" not in files.columns:
        named = named.withColumn("modified", F.lit(None).cast("timestamp"))
    same = ["topic", "path", "size", "modified"]
    was = (spark.createDataFrame([], MANIFEST) if old is None else old).select(*same, F.col("first_line").alias("was"))
    both = named.join(was, same, "left")
    fresh = first_lines(both.where("was IS NULL").select("path", "size").distinct(), meter)
    both = both.join(fresh, "path", "left").withColumn("first_line", F.coalesce("was", "first_line")).where("first_line IS NOT NULL")
    last = both.groupBy("topic", "first_line").agg(F.max_by(F.struct("path", "size", "modified"), "file_ord").alias("f"))
    return last.select("topic", "first_line", "f.path", "f.size", "f.modified")


def duplicate_files(firsts: DataFrame) -> DataFrame:
    """(first_line, paths): files (first_line, path) that begin alike."""
    return firsts.groupBy("first_line").agg(F.sort_array(F.collect_list("path")).alias("paths")).where(F.size("paths") > 1)


def diff_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """`new` with status and read_from: new from 0, grown from the old size; unchanged and shrunk have nothing to read. Paths don't matter."""
    was = old.groupBy("topic", "first_line").agg(F.max("size").alias("_was"))
    both = new.join(was, ["topic", "first_line"], "left")
    size, old_size = F.col("size"), F.col("_was")
    status = F.when(old_size.isNull(), "new").when(size > old_size, "grown").when(size == old_size, "unchanged").otherwise("shrunk")
    start = F.when(old_size.isNull(), F.lit(0).cast("long")).when(size > old_size, old_size)
    return both.select(*new.columns, status.alias("status"), start.alias("read_from"))


def save_manifest(manifest: DataFrame, folder: str) -> None:
    """A new version that replaces the last one for `load_manifest`."""
    manifest.write.parquet(f"{folder}/version={time.time_ns()}")


def load_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The last version; empty if there is none."""
    done = [v for v in children(spark, folder) if v.startswith("version=") and exists(spark, f"{folder}/{v}/_SUCCESS")]
    if not done:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/{max(done, key=lambda v: int(v.split('=')[1]))}")


@dataclass(frozen=True)
class TopicSpec:
    """Where a topic's files are and how they are read."""

    base: str
    pattern: str
    order: Order = "daily"
    parser: Callable[[Column], Column] | None = None


def _tagged(spark: SparkSession, topics: dict[str, TopicSpec]) -> DataFrame:
    """(topic, path, size, modified, file_ord) of the files of all topics, from one list."""
    listed = _listed(spark, sorted({spec.base for spec in topics.values()}))
    parts = []
    for topic, spec in topics.items():
        rank = F.row_number().over(Window.orderBy(*_sort_keys(F.col("path"), spec.order)))
        parts.append(listed.where(_right_under(spec.base, spec.pattern)).select(F.lit(topic).alias("topic"), "*", rank.alias("file_ord")))
    return reduce(DataFrame.unionByName, parts)


def collect_topics(spark: SparkSession, topics: dict[str, TopicSpec], manifest: DataFrame, host: str = "", tz: str = "UTC", meter=None) -> tuple[DataFrame, DataFrame]:
    """(events, manifest): what is new in all topics since `manifest`, as LOG rows with topic, file, file_ord and offset.

    All topics are one plan: one list of files, one read of what is new in them and
    one parse, whose parser goes by the topic. The manifest is written to the shared
    folder first; what the events read follows from it, so files that change
    meanwhile change neither.
    """
    files = _tagged(spark, topics)
    now = checkpoint(build_manifest(spark, files, old=manifest, meter=meter))
    todo = checkpoint(diff_manifest(manifest, now).where("read_from IS NOT NULL").join(files.select("topic", "path", "file_ord"), ["topic", "path"]))
    lines = read_ranges(todo.groupBy("path", "size").agg(F.min("read_from").alias("read_from")), meter)
    mine = todo.select("topic", "path", "read_from", "file_ord").withColumnRenamed("path", "of")
    lines = lines.join(F.broadcast(mine), F.col("path") == F.col("of")).where("offset >= read_from").select("topic", F.col("path").alias("file"), "file_ord", "offset", "line")

    def parser(c: Column) -> Column:
        rules = [(F.col("topic") == topic, (spec.parser or (lambda c: parse_log_line(c, tz)))(c)) for topic, spec in topics.items()]
        return reduce(lambda chain, rule: chain.when(*rule), rules[1:], F.when(*rules[0]))

    events = parse_log_events(lines, F.lit(host), parser, tz, ["topic", "file", "file_ord"], chunk=F.floor(F.col("offset") / (1 << 26)))
    return events, now
