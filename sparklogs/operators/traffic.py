"""Block transfers between hosts from data-node logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklogs.operators.extract import route_first_match

#: The texts that route a line, and where addresses and sizes stand.
_SRC, _DEST = r"(?<=src: /)[0-9.]+(?=:)", r"(?<=dest: /)[0-9.]+(?=:)"
RULES = [("received", "Received block", r"(?<=size )[0-9]+"), ("write", "HDFS_WRITE", r"(?<=bytes: )[0-9]+"), ("read", "HDFS_READ", r"(?<=bytes: )[0-9]+")]


def _transfer(message: Column, tag: str, size: str) -> Column:
    src, dest = (F.coalesce(F.regexp_substr(message, F.lit(p)), F.lit("")) for p in (_SRC, _DEST))
    if tag != "read":  # the flow is towards the sender of what was received or written
        src, dest = dest, src
    size = F.coalesce(F.regexp_substr(message, F.lit(size)).try_cast("long"), F.lit(0))
    return F.struct(src.alias("srcip"), dest.alias("destip"), size.cast("long").alias("filesize"), F.lit(tag).alias("tag"))


def parse_transfers(df: DataFrame) -> DataFrame:
    """TRANSFER rows of the messages that tell of one, by the first rule that fits; a missing address is empty, a missing size 0."""
    message = F.col("message")
    routed = route_first_match(df.select("timestamp", "message"), [(tag, message.contains(text), _transfer(message, tag, size)) for tag, text, size in RULES])
    return routed.select("timestamp", "routed.*")


def flow_totals(transfers: DataFrame) -> DataFrame:
    """(src, dest, dataflow): bytes of each pair; busy hosts are summed before the shuffle."""
    return transfers.groupBy(F.col("srcip").alias("src"), F.col("destip").alias("dest")).agg(F.sum("filesize").alias("dataflow"))


def flow_nodes(flows: DataFrame) -> DataFrame:
    return flows.select(F.col("src").alias("node")).union(flows.select("dest")).distinct()


def flow_matrix(flows: DataFrame, max_nodes: int = 5_000) -> DataFrame:
    """(src, dest, dataflow) of every pair of nodes, 0 where nothing flowed.

    The square of the number of nodes in rows is the feature: a chart of few nodes.
    More than `max_nodes` nodes are an error, not a cut.
    """
    nodes = flow_nodes(flows)
    if (n := nodes.count()) > max_nodes:
        raise ValueError(f"{n} nodes are too many for a dense matrix: keep the flows in long form")
    grid = nodes.select(F.col("node").alias("src")).crossJoin(F.broadcast(nodes.select(F.col("node").alias("dest"))))
    return grid.join(flows, ["src", "dest"], "left").select("src", "dest", F.coalesce("dataflow", F.lit(0)).alias("dataflow"))


def node_totals(flows: DataFrame) -> DataFrame:
    """(node, dataflow): bytes out; nodes that only receive have 0."""
    out = flows.select(F.col("src").alias("node"), "dataflow").union(flows.select(F.col("dest"), F.lit(0).cast("long")))
    return out.groupBy("node").agg(F.sum("dataflow").alias("dataflow"))


def flow_range(flows: DataFrame) -> DataFrame:
    """(min_flow, max_flow) of the matrix's cells, without building it: a cell is 0 unless all pairs of nodes have flows."""
    cells = flows.agg(F.min("dataflow").alias("lo"), F.max("dataflow").alias("hi"), F.count(F.lit(1)).alias("n"))
    nodes = flow_nodes(flows).agg(F.count(F.lit(1)).alias("m"))
    dense = F.col("n") == F.col("m") * F.col("m")
    return cells.crossJoin(nodes).select(F.when(dense, F.col("lo")).otherwise(F.least("lo", F.lit(0))).alias("min_flow"), F.when(dense, F.col("hi")).otherwise(F.greatest("hi", F.lit(0))).alias("max_flow"))


def flows_to_json(flows: DataFrame) -> DataFrame:
    """(json): one document {"info": [{src, dest, dataflow}]} for a chart; as large as the flows, so meant for few."""
    edges = F.sort_array(F.collect_list(F.struct("src", "dest", "dataflow")))
    return flows.agg(F.to_json(F.struct(edges.alias("info"))).alias("json"))
