"""Exact duplicates by a tree merge of sorted digest runs.

Every partition first turns its rows into one sorted run of digests. Partitions
then exchange runs in binomial rounds: in each round a partition keeps the part
of the digest space that its number stands for and sends the rest to partners
whose numbers differ in that round's bits, and the runs that meet are merged.
After log(partitions) rounds each partition holds the whole truth on its share
of the digests. Runs arrive one after another, each in order; the sort of a
partition, a TimSort, finds them and merges them. Every merge keeps one entry a digest, so a text that fills a
third of the table never brings more than one entry from each run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.common import checkpoint, partitions, table

#: Bits of the partition number that one round settles: 8 runs meet in a merge.
ROUND_BITS = 3
_NO_ID = (1 << 63) - 1
_RUN = "digest binary, n_norm int, n_chars int, id long, n long, home int, row long"
_ARROW = pa.schema([("digest", pa.binary()), ("n_norm", pa.int32()), ("n_chars", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("home", pa.int32()), ("row", pa.int64())])


def normalised(text: Column) -> Column:
    """The text without the characters space and U+0009 to U+000D; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\x09-\\x0D]+", "")


def _merge(bits: int, mask: int):
    """Folds rows sorted by digest, then best first, to one row a digest; sets the home of the next round."""

    def fold(batches):
        kept = None  # the group that the next batch may continue
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]).cast(_ARROW)
            if kept is not None:
                rows = pa.concat_tables([kept, rows])
            rows = rows.combine_chunks()
            digests = rows["digest"].combine_chunks()
            raw = _words(digests)
            length = rows["n_norm"].to_numpy()
            first = np.ones(len(length), bool)  # equal digests are verified by the length of what they stand for
            first[1:] = (raw[1:] != raw[:-1]).any(axis=1) | (length[1:] != length[:-1])
            at = np.flatnonzero(first)
            home = rows["home"].to_numpy()[at]
            out = rows.take(pa.array(at)).set_column(4, "n", pa.array(np.add.reduceat(rows["n"].to_numpy(), at)))
            home = (home & ~mask) | ((raw[at, 0] & np.uint64((1 << bits) - 1)).astype(np.int64) & mask)
            out = out.set_column(5, "home", pa.array(home.astype(np.int32)))
            kept = out.slice(len(at) - 1)
            yield from out.slice(0, len(at) - 1).to_batches()
        if kept is not None:
            yield from kept.to_batches()

    return fold


def _words(digests: pa.Array) -> np.ndarray:
    """The 32 bytes of each digest as four words."""
    fixed = digests.cast(pa.binary(32))
    return np.frombuffer(fixed.buffers()[1], dtype="<u8").reshape(-1, 4)[fixed.offset : fixed.offset + len(fixed)]


def merge_runs(rows: DataFrame, width: int) -> DataFrame:
    """(digest, n_norm, n_chars, id, n, row): for each digest the best row (most characters, smallest id, smallest row key) and the number of rows.

    `width`: partitions of the last round, raised to a power of two.
    """
    bits = max(1, (max(2, width) - 1).bit_length())
    best_first = ["digest", "n_norm", F.desc("n_chars"), "id", "row"]
    home = F.spark_partition_id() % (1 << bits)
    runs = rows.select("digest", "n_norm", "n_chars", "id", F.lit(1).cast("long").alias("n"), home.alias("home"), "row")
    for done in range(0, bits, ROUND_BITS):
        mask = ((1 << min(ROUND_BITS, bits - done)) - 1) << done
        runs = runs.sortWithinPartitions(*best_first).mapInArrow(_merge(bits, mask), _RUN)
        runs = runs.repartitionById(1 << bits, "home")
    return runs.sortWithinPartitions(*best_first).mapInArrow(_merge(bits, 0), _RUN).drop("home")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per row of `docs`: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical without white space (see `normalised`); the
    row with the most code points in its original text stays, then the smallest
    id. Null texts count as empty, and all empty texts are one group. A null id
    sorts last and comes back as null; rows that share an id and a text are all
    kept or dropped together, unless `row_col` names a long key of rows: then one
    row of a group stays, in the end that with the smallest key, and the key is a
    further column `row`. Other columns of `docs` are not read. An empty table
    gives an empty result.
    """
    text = normalised(F.col(text_col))
    rows = docs.select(
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.length(text).alias("n_norm"),
        F.coalesce(F.length(text_col), F.lit(0)).alias("n_chars"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"),
        (F.col(row_col) if row_col else F.lit(0)).cast("long").alias("row"),
    )
    rows = checkpoint(rows)
    best = merge_runs(rows, partitions(docs.sparkSession))
    best = best.select("digest", "n_norm", F.col("id").alias("keep"), F.col("row").alias("keep_row"), F.col("n").alias("group_size"))
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return rows.join(best, ["digest", "n_norm"]).select(
        real("id").alias("doc_id"),
        real("keep").alias("keep_id"),
        "group_size",
        ((F.col("id") == F.col("keep")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *(["row"] if row_col else []),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
     g AS (SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-n_chars, doc_id)) AS keep_id FROM n GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""
