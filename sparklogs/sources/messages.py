"""A log of messages whose offsets count messages: published in files of a bounded number, read as a stream in batches of a bounded number.

A folder holds files of messages and an index that is appended to: each publishing
adds one entry, with the names of its files in order and how many messages each
has. The place of a message is its number among the messages of the topics that are
read, in the order of publishing, so a batch is a range of numbers.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from sparklogs.shared import children, put_new

#: Messages that a producer sends at a time, and that a consumer takes.
SENT, READ = 1000, 10
#: Files that one task reads.
FILES = 20
SCHEMA = "topic string, offset long, value string"


def publish(messages: DataFrame, folder: str, order: list[str] | None = None, per_file: int = SENT) -> int:
    """Appends `messages (topic, value)` to the log, in files of at most `per_file`; returns how many there were.

    With `order` messages of a topic are in the order of these columns. They can be
    read when the entry of the index is there, which comes last: what a broken run
    leaves is never read. Two that publish at a time get entries one after the other.
    """
    spark = messages.sparkSession
    folder, name = folder.rstrip("/"), str(uuid.uuid4())
    rows = messages.orderBy("topic", *order) if order else messages
    rows.select("topic", "value").write.option("maxRecordsPerFile", per_file).partitionBy("topic").parquet(f"{folder}/files/{name}")
    if not [c for c in children(spark, f"{folder}/files/{name}") if c.startswith("topic=")]:
        return 0
    file = F.col("_metadata.file_path")
    written = spark.read.schema("value string, topic string").parquet(f"{folder}/files/{name}").groupBy("topic", F.substring_index(file, "/", -2).alias("file")).agg(F.count(F.lit(1)).alias("n"))
    entry = [[r.topic, f"{name}/{r.file}", r.n] for r in written.orderBy("topic", "file").collect()]  # one row a file
    at = len(_entries(spark, folder))
    while not put_new(spark, f"{folder}/index/{at:012d}", json.dumps(entry)):
        at += 1
    return sum(n for _, _, n in entry)


def _entries(spark: SparkSession, folder: str) -> list[str]:
    return sorted(c for c in children(spark, f"{folder}/index") if c.isdigit())


def read_messages(spark: SparkSession, folder: str, topics: list[str], position: str, starting: str = "latest", max_per_batch: int = READ, per_trigger: int | None = None) -> DataFrame:
    """A stream of (topic, offset, value) of some topics, in batches of at most `max_per_batch` messages.

    A micro-batch is one batch. With `per_trigger` it is as many batches as there
    are, up to that number: each goes to a task of its own, and a column `batch`
    numbers them from 0. What a micro-batch costs whatever it holds is then paid once for
    many small batches. A batch is short only if the log has no more; after a failure
    numbers may be left out.

    `starting`: "latest" gives what is published after the first start of the query,
    "earliest" everything. `position` is a folder of the query's own, kept as its
    checkpoint is: it holds the start and how far batches were planned, as Spark
    asks a source for a batch's end without telling where it begins. A query that
    goes on starts where it was; a batch that was planned and not begun before a
    failure comes together with the next one.
    """
    if starting not in ("latest", "earliest"):
        raise ValueError(f"no start {starting!r}")
    if max_per_batch < 1 or (per_trigger is not None and per_trigger < 1):
        raise ValueError("a batch needs a message")
    spark.dataSource.register(MessageSource)
    reader = spark.readStream.format(MessageSource.name()).option("folder", folder.rstrip("/")).option("topics", json.dumps(sorted(topics)))
    reader = reader.option("starting", starting).option("per_batch", str(max_per_batch)).option("position", position.rstrip("/"))
    if per_trigger is not None:
        reader = reader.option("per_trigger", str(per_trigger))
    return reader.load()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


class MessageSource(DataSource):
    """The data source behind `read_messages`."""

    @classmethod
    def name(cls) -> str:
        return "sparklogs_messages"

    def schema(self) -> str:
        return f"{SCHEMA}, batch long" if "per_trigger" in self.options else SCHEMA

    def streamReader(self, schema):  # noqa: N802
        return _Reader(dict(self.options))


class _Part(InputPartition):
    """Rows of files, as (topic, path, start, stop, first): rows [start, stop), the first of which has the place `first`. All are of one batch, if batches are told."""

    def __init__(self, pieces: list[tuple[str, str, int, int, int]], batch: int | None = None):
        self.pieces, self.batch = pieces, batch


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.topics = options["folder"], set(json.loads(options["topics"]))
        self.starting, self.per_batch, self.position = options["starting"], int(options["per_batch"]), options["position"]
        self.per_trigger = int(options["per_trigger"]) if "per_trigger" in options else None
        self.files: list[tuple[str, str, int, int]] = []  # (topic, path, place of the first message, messages)
        self.firsts: list[int] = []  # the places alone
        self.total = self.seen = 0
        self.planned: tuple[int, int] | None = None  # messages and batches

    def _refresh(self) -> int:
        """Reads new entries of the index; returns how many messages there are."""
        store, folder = _store(f"{self.folder}/index")
        while store.get_file_info(path := f"{folder}/{self.seen:012d}").type == fs.FileType.File:
            with store.open_input_stream(path) as file:
                entry = json.loads(file.read())
            for topic, name, n in entry:
                if topic in self.topics:
                    self.files.append((topic, f"{self.folder}/files/{name}", self.total, n))
                    self.firsts.append(self.total)
                    self.total += n
            self.seen += 1
        return self.total

    def _kept(self, name: str, *values: int) -> tuple[int, ...] | None:
        """The numbers that the position folder has under a name, after writing `values` there if any are given."""
        store, folder = _store(self.position)
        if values:
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(f"{folder}/{name}.new") as file:
                file.write(" ".join(map(str, values)).encode())
            store.move(f"{folder}/{name}.new", f"{folder}/{name}")
            return values
        if store.get_file_info(f"{folder}/{name}").type != fs.FileType.File:
            return None
        with store.open_input_stream(f"{folder}/{name}") as file:
            return tuple(map(int, file.read().split()))

    def _start(self) -> int:
        start = self._kept("start")
        return (start or self._kept("start", self._refresh() if self.starting == "latest" else 0))[0]

    def initialOffset(self) -> dict:  # noqa: N802
        return {"messages": self._start(), "batches": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        total = self._refresh()
        if self.planned is None:
            kept = self._kept("planned")
            self.planned = (*(kept or (self._start(),)), 0)[:2]
        at, batches = self.planned
        end = min(total, at + self.per_batch * (self.per_trigger or 1))
        if end > at:
            self.planned = self._kept("planned", end, batches - (at - end) // self.per_batch)
        return {"messages": self.planned[0], "batches": self.planned[1]}

    def _pieces(self, a: int, b: int) -> list[tuple[str, str, int, int, int]]:
        """Rows of files that are the messages [a, b)."""
        there = self.files[max(bisect_right(self.firsts, a) - 1, 0) : bisect_left(self.firsts, b)]
        return [(topic, path, max(a, first) - first, min(b, first + n) - first, max(a, first)) for topic, path, first, n in there if a < first + n]

    def partitions(self, start: dict, end: dict) -> list[_Part]:
        a, b = start["messages"], end["messages"]
        if self._refresh() < b:
            raise ValueError(f"the log has lost messages: {self.total} of {b} are there")
        self.planned = max((b, end.get("batches", 0)), self.planned or (0, 0))
        if self.per_trigger is None:
            pieces = self._pieces(a, b)
            return [_Part(pieces[k : k + FILES]) for k in range(0, len(pieces), FILES)]
        return [_Part(self._pieces(low, min(low + self.per_batch, b)), start.get("batches", 0) + k) for k, low in enumerate(range(a, b, self.per_batch))]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        for topic, path, start, stop, place in partition.pieces:
            store, inside = _store(path)
            at = 0
            with store.open_input_file(inside) as file:
                for batch in pq.ParquetFile(file).iter_batches(batch_size=1000, columns=["value"]):
                    low, high = max(start - at, 0), min(stop - at, batch.num_rows)
                    if low < high:
                        first, n = place + at + low - start, high - low
                        columns = [pa.array([topic] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), batch.column(0).slice(low, n).cast(pa.string())]
                        told = [] if partition.batch is None else [pa.array([partition.batch] * n, pa.int64())]
                        yield pa.RecordBatch.from_arrays(columns + told, ["topic", "offset", "value", "batch"][: 3 + len(told)])
                    at += batch.num_rows
                    if at >= stop:
                        break

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass
