"""Line dedup over an index that grows and shrinks: sharded cuckoo filters before exact reference counts.

The index holds, for every line key, how many documents have it and the smallest of
their ids. A shard of the key space has two cuckoo filters: of all keys in the
index, and of those that several documents share. New keys that the first filter
doesn't know go straight into the counts, the others are looked up there; when
lines are dropped, only those that the second filter knows are looked up. Filters
take removals, so that deleting documents undoes what adding them did: lines that
were dropped for their sake come back.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.common import checkpoint, likely_rows, table
from sparklogs.llm.cuckoo import CuckooFilter, key_words
from sparklogs.shared import children, new_folder

#: Fixed value: white space that keys lose at both ends.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
MIN_CHARS = 10
#: Keys of a shard, on average, beyond which the index is dealt into more shards: what one call of a task holds.
SHARD_KEYS = 4096
#: Rows without an id are one document that comes after all others.
_NO_ID = (1 << 63) - 1

_POSTING = "key binary, doc long, at int"
_GONE = "doc long, at int"
_COUNT = "key binary, refs long, first long, at int"
_FILTER = "shard int, kind string, cells binary"
_DONE = "version int, shards int"
_KNOWN, _SHARED = "known", "shared"


def line_key(line: bytes) -> bytes | None:
    """The 16 bytes that stand for a line: a BLAKE2 digest of it without outer white space, A-Z lower-cased; None if it has too few characters to count."""
    body = line.strip(SPACE)
    if len(body) < MIN_CHARS or not body.isascii() and len(body.decode()) < MIN_CHARS:
        return None
    return blake2b(body.lower(), digest_size=16).digest()


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def _postings(docs: DataFrame) -> DataFrame:
    """(key, doc): the keys of the lines of `docs (id, text)`, each once a document."""

    def each(batches):
        for batch in batches:
            keys, counts = [], []
            for text in batch.column(1).to_pylist():
                found = {line_key(line) for line in text.split(b"\n")} - {None}
                keys += found
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(np.repeat(batch.column(0).to_numpy(), counts), pa.int64())], ["key", "doc"])

    return docs.mapInArrow(each, "key binary, doc long").distinct()


def _shard(shards: int) -> Column:
    """The shard of a key, from bytes that the filters don't use."""
    return F.pmod(F.conv(F.hex(F.substring("key", 9, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int")


class LineIndex:
    """An index of the lines of documents in a folder that driver and executors share.

    `insert` and `delete` each write a new version: what changed of postings and
    counts, and the filters. A version counts when its mark is written, last of all;
    what a broken run leaves is overwritten by the next. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # --- state ---

    def state(self) -> tuple[int, int]:
        """(version, shards): 0 and 1 before anything is written."""
        done = [int(n) for n in children(self.spark, f"{self.folder}/done")]
        done = [n for n in done if "_SUCCESS" in children(self.spark, f"{self.folder}/done/{n}")]
        if not done:
            return 0, 1
        return max(done), self.spark.read.schema(_DONE).parquet(f"{self.folder}/done/{max(done)}").first()["shards"]

    def _read(self, name: str, schema: str) -> DataFrame:
        version, _ = self.state()
        there = [f"{self.folder}/{name}/{n}" for n in sorted(map(int, children(self.spark, f"{self.folder}/{name}"))) if n <= version]
        return self.spark.read.schema(schema).parquet(*there) if there else self.spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, name: str, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}/{version}")

    def postings(self) -> DataFrame:
        """(key, doc) of all documents in the index."""
        gone = self._read("gone", _GONE).groupBy("doc").agg(F.max("at").alias("gone_at"))
        return self._read("postings", _POSTING).join(gone, "doc", "left").where("gone_at IS NULL OR gone_at < at").select("key", "doc")

    def counts(self) -> DataFrame:
        """(key, refs, first): in how many documents a key is, and the smallest id; the exact table behind the filters."""
        newest = F.max_by(F.struct("refs", "first"), "at").alias("now")
        return self._read("counts", _COUNT).groupBy("key").agg(newest).select("key", "now.*").where("refs > 0")

    def filters(self) -> DataFrame:
        """(shard, kind, cells) of the newest version."""
        version, _ = self.state()
        return self.spark.read.schema(_FILTER).parquet(f"{self.folder}/filters/{version}") if version else self.spark.createDataFrame([], _FILTER)

    def _commit(self, version: int, shards: int) -> None:
        self._write(self.spark.createDataFrame([(version, shards)], _DONE).coalesce(1), "done", version)

    # --- filters ---

    def _perhaps(self, keys: DataFrame, kind: str) -> DataFrame:
        """Of `keys (key, ...)`, one row a key, those that the filter of their shard knows: all that are in, and few others."""
        _, shards = self.state()
        schema = keys.schema
        cells = self.filters().where(F.col("kind") == kind).select("shard", "cells")

        def choose(rows: pa.Table, cells: pa.Table) -> pa.Table:
            rows = rows.select(schema.names)
            if not rows.num_rows or not cells.num_rows:
                return rows.slice(0, 0)
            known = CuckooFilter(table=cells["cells"][0].as_py()).contains(key_words(rows["key"].to_pylist()))
            return rows.filter(pa.array(known))

        dealt = keys.withColumn("shard", _shard(shards))
        return dealt.groupBy("shard").cogroup(cells.groupBy("shard")).applyInArrow(choose, schema)

    def _filtered(self, changes: DataFrame, shards: int) -> DataFrame:
        """The filters after `changes (key, kind, more)`: keys that come (more) and go. Shards without changes keep theirs."""
        dealt = changes.withColumn("shard", _shard(shards))

        def renew(rows: pa.Table, cells: pa.Table) -> pa.Table:
            kind, shard = ((rows if rows.num_rows else cells)[c][0].as_py() for c in ("kind", "shard"))
            made = CuckooFilter(table=cells["cells"][0].as_py()) if cells.num_rows else CuckooFilter()
            if rows.num_rows:
                more = rows["more"].to_numpy()
                words = key_words(rows["key"].to_pylist())
                made.remove(words[~more])
                if not made.add(words[more]):
                    made = None  # too small: made anew from the counts
            return pa.table({"shard": pa.array([shard], pa.int32()), "kind": [kind], "cells": pa.array([None if made is None else made.tobytes()], pa.binary())})

        by = ["shard", "kind"]
        return dealt.groupBy(*by).cogroup(self.filters().groupBy(*by)).applyInArrow(renew, _FILTER)

    def _rebuilt(self, counts: DataFrame, shards: int) -> DataFrame:
        """Filters of all keys in `counts`."""

        def build(rows: pa.Table) -> pa.Table:
            made = CuckooFilter.of(key_words(rows["key"].to_pylist()))
            return pa.table({"shard": rows["shard"].slice(0, 1), "kind": rows["kind"].slice(0, 1), "cells": pa.array([made.tobytes()], pa.binary())})

        kinds = F.explode(F.when(F.col("refs") > 1, F.array(F.lit(_KNOWN), F.lit(_SHARED))).otherwise(F.array(F.lit(_KNOWN)))).alias("kind")
        return counts.select("key", kinds).withColumn("shard", _shard(shards)).groupBy("shard", "kind").applyInArrow(build, _FILTER)

    def _advance(self, changed: DataFrame) -> None:
        """Writes counts and filters of the next version and its mark. `changed (key, refs, first, before)`: keys with new counts, and their old refs."""
        version, shards = self.state()
        at = version + 1
        self._write(changed.select("key", "refs", "first", F.lit(at).alias("at")), "counts", at)
        keys = self.spark.read.schema(_COUNT).parquet(f"{self.folder}/counts/{at}")
        # the mark isn't there yet: counts of this version come on top of the older ones
        both = self._read("counts", _COUNT).union(keys)
        now = keys.drop("at") if not version else both.groupBy("key").agg(F.max_by(F.struct("refs", "first"), "at").alias("now")).select("key", "now.*").where("refs > 0")
        wanted = max(1, -(-now.count() // SHARD_KEYS))
        if not version or wanted > shards:
            shards = max(wanted, shards)
            self._write(self._rebuilt(now, shards), "filters", at)
        else:
            turn = lambda name, least: F.when((F.col("before") < least) & (F.col("refs") >= least), F.struct(F.lit(name).alias("kind"), F.lit(True).alias("more"))).when(
                (F.col("before") >= least) & (F.col("refs") < least), F.struct(F.lit(name).alias("kind"), F.lit(False).alias("more"))
            )
            turns = changed.select("key", F.explode(F.array_compact(F.array(turn(_KNOWN, 1), turn(_SHARED, 2)))).alias("turn")).select("key", "turn.*")
            renewed = checkpoint(self._filtered(turns, shards))
            small = renewed.where("cells IS NULL").select("shard", "kind")
            again = self._rebuilt(now, shards).join(small, ["shard", "kind"], "left_semi") if not small.isEmpty() else renewed.limit(0)
            self._write(renewed.where("cells IS NOT NULL").union(again), "filters", at)
        self._commit(at, shards)

    # --- use ---

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """Adds the lines of documents. What is in the index already changes nothing, so that a batch can be added again."""
        version, _ = self.state()
        at = version + 1
        fresh = _postings(_identified(docs, id_col, text_col))
        if version:
            fresh = checkpoint(fresh)
            perhaps = checkpoint(self._perhaps(fresh.select("key").distinct(), _KNOWN))
            fresh = fresh.join(self.postings().join(perhaps, "key", "left_semi"), ["key", "doc"], "left_anti")
        self._write(fresh.select("key", "doc", F.lit(at).alias("at")), "postings", at)
        fresh = self.spark.read.schema(_POSTING).parquet(f"{self.folder}/postings/{at}")
        added = fresh.groupBy("key").agg(F.count(F.lit(1)).alias("more"), F.min("doc").alias("low"))
        if version:
            added = added.join(self.counts().join(perhaps, "key", "left_semi"), "key", "left")
        else:
            added = added.withColumns({"refs": F.lit(None).cast("long"), "first": F.lit(None).cast("long")})
        before = F.coalesce("refs", F.lit(0))
        changed = added.select("key", (before + F.col("more")).alias("refs"), F.least("first", "low").alias("first"), before.alias("before"))
        self._advance(checkpoint(changed) if version else changed)
        return self

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """Takes documents out again: counts fall, the next smallest id takes over a key. Ids that aren't in the index change nothing; null stands for the rows without an id."""
        version, _ = self.state()
        if not version:
            return self
        at = version + 1
        ids = checkpoint(ids.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc")).distinct())
        live = self.postings()
        lost = checkpoint(live.join(ids, "doc", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("less")))
        left = live.join(ids, "doc", "left_anti").join(lost, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("refs"), F.min("doc").alias("first"))
        refs = F.coalesce("refs", F.lit(0))
        changed = checkpoint(lost.join(left, "key", "left").select("key", refs.alias("refs"), "first", (refs + F.col("less")).alias("before")))
        self._write(ids.select("doc", F.lit(at).alias("at")), "gone", at)
        self._advance(changed)
        return self

    def dropped(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(key, doc): lines of `docs` that a document with a smaller id in the index has too."""
        rows = checkpoint(_postings(_identified(docs, id_col, text_col)))
        shared = self.counts().where("refs > 1").join(self._perhaps(rows.select("key").distinct(), _SHARED), "key", "left_semi")
        return rows.join(checkpoint(shared), "key").where("doc > first").select("key", "doc")

    def dedup(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(doc_id, n_lines, n_dropped, kept): one row per row of `docs`, which should be in the index.

        A text is split at \\n; null and empty texts are one empty line. Lines whose
        key (see `line_key`) has 10 characters or more and is in a document of the
        index with a smaller id are dropped, the others joined by \\n again. Rows with
        equal ids are one document and lose no line to each other; rows without an id
        are one document that comes last. An empty table gives an empty result; other
        columns are not read. Texts are shuffled only where lines may go.
        """
        rows = _identified(docs, id_col, text_col)
        drops = checkpoint(self.dropped(docs, id_col, text_col))
        ids = drops.select(F.col("doc").alias("id")).distinct()
        hit, rest = likely_rows(rows, ids), likely_rows(rows, ids, False)
        gathered = drops.groupBy("doc").agg(F.collect_list("key").alias("keys")).withColumnRenamed("doc", "id")
        both = hit.join(gathered, "id", "left").unionByName(rest.withColumn("keys", F.lit(None).cast("array<binary>")))

        def each(batches):
            for batch in batches:
                n, gone, kept = [], [], []
                for text, keys in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    lines = text.split(b"\n")
                    keys = set(keys or ())
                    stay = [x for x in lines if line_key(x) not in keys] if keys else lines
                    n.append(len(lines))
                    gone.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], ["id", "n_lines", "n_dropped", "kept"])

        out = both.select("id", "text", "keys").mapInArrow(each, "id long, n_lines long, n_dropped long, kept binary")
        return out.select(F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"), "n_lines", "n_dropped", F.col("kept").cast("string").alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = LineIndex(spark, new_folder(spark, "lines")).insert(docs)
    return index.dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
     k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (first < doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN s USING (key) GROUP BY doc_id
"""
