"""Small helpers shared by the operators: tables, checkpoints, components."""

from __future__ import annotations

import gc
import sys

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.shared import checkpoint, shared_folder  # noqa: F401  the operators have them from here

#: Bits of the filter that `likely_rows` broadcasts: 4 MB at any size of the input.
_FILTER_BITS = 1 << 25


if str(getattr(getattr(sys.modules["__main__"], "__spec__", None), "name", "")).startswith("pyspark."):
    # a Python worker lives on after its task: memory goes back to the system, not to a pool of its own
    pa.set_memory_pool(pa.system_memory_pool())

#: Rows of whole texts, and bytes of them, that a Python worker and its executor hold at a time.
BATCH_ROWS, BATCH_BYTES = 2_000, 16 << 20
_BATCH, _BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the queries. Lowers the session's Arrow batches to BATCH_ROWS and BATCH_BYTES, which the plan reads when it runs: texts may be long."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)
    spark.conf.set(_BYTES, BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more, which it does when the driver collects garbage.

    Called between the heavy steps of a job, after their results are checkpointed,
    so that disks hold the files of one step and not of all.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _smallest(edges: DataFrame) -> DataFrame:
    """For each `a` the smaller of itself and its smallest neighbour; written, so that joins with it can be split."""
    return checkpoint(edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected `edges (a, b)`: (id, component), the smallest id reachable.

    Alternates the large-star and small-star steps until the edges no longer
    change. Each step is an aggregate (partial sums first) and an equi-join with
    a written table, so a node with very many neighbours is split by AQE. Self
    loops are allowed: they only name the node. Null ends are dropped.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    nodes = None
    edges = checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    edges = edges.where("a > b")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
        if not state[0]:
            break
        both = checkpoint(edges.union(edges.select("b", "a")).toDF("a", "b"))
        large = both.join(_smallest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = checkpoint(large.where("a > b").distinct())
        low = _smallest(large)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", "m")).where("a > b")
        edges = checkpoint(small.distinct())
    return nodes.join(edges.select(F.col("a").alias("id"), F.col("b").alias("component")), "id", "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )


def _marked(docs: DataFrame, ids: DataFrame, id_col: str, likely: bool) -> DataFrame:
    """Rows of `docs` whose id may be in `ids (id)`, or those whose id surely isn't, by a broadcast bitmap of a fixed size."""
    spot = F.explode(F.array(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(_FILTER_BITS)) for k in range(2)])).alias("spot")
    words = ids.select(spot).groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(spot & 63 AS INT))")).alias("bits"))
    got = words.toArrow()  # at most _FILTER_BITS / 64 rows
    filled = np.zeros(_FILTER_BITS // 64, np.int64)
    filled[got["word"].to_numpy()] = got["bits"].to_numpy()
    schema, width = docs.schema, len(docs.columns)

    def choose(batches):
        for batch in batches:
            hit = np.ones(batch.num_rows, bool)
            for c in (width, width + 1):
                spot = batch.column(c).to_numpy(zero_copy_only=False)
                hit &= (filled[spot >> 6] >> (spot & 63)) & 1 == 1
            yield batch.filter(pa.array(hit == likely)).select(list(range(width)))

    key = F.col(id_col).cast("long")
    return docs.select("*", *[F.pmod(F.xxhash64(key, F.lit(k)), F.lit(_FILTER_BITS)) for k in range(2)]).mapInArrow(choose, schema)


def likely_rows(docs: DataFrame, ids: DataFrame, likely: bool = True) -> DataFrame:
    """Rows of `docs (id, text)` whose id may be in `ids (id)`, so that a join after it shuffles few texts; not `likely`: the others."""
    return _marked(docs.where("id IS NOT NULL"), ids, "id", likely)


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """`docs` with a long key of each row that is the same in every plan.

    Rows of Parquet files read as they are go by 64-bit hashes of their file and
    place in it, so nothing is written; other tables are checkpointed with numbers.
    """
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            return docs.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(name))
        except AnalysisException:
            pass
    return checkpoint(docs.withColumn(name, F.monotonically_increasing_id()))


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`docs` without the rows whose id is in `ids (id)`; rows with a null id stay. Texts that surely stay aren't shuffled."""
    ids = checkpoint(ids.select(F.col("id").cast("long").alias("id")).where("id IS NOT NULL").distinct())
    perhaps = _marked(docs, ids, id_col, True)
    stay = perhaps.join(ids, perhaps[id_col].cast("long") == ids["id"], "left_anti")
    return _marked(docs, ids, id_col, False).union(stay)
