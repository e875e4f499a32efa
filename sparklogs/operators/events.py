"""Multi-line events from lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklogs.functions.parsing import parse_log_line


#: Steps of the order, bytes of a file, that lines of one event may span in one row.
PIECE = 64 << 20


def running_count(df: DataFrame, flag: Column, keys: list[str], order: list[str], chunk: Column, name: str, latest: tuple[str, Column] | None = None) -> DataFrame:
    """`df` with `name`: how many rows of the keys up to this one, in order, have the flag.

    `chunk` is a column that never falls along the order. Counts run inside chunks
    and the totals of earlier chunks are added, so that a key of any size is spread
    over tasks; one row a chunk is all that a key has in one place. `latest (name,
    value)`: also the largest value so far.

    Rows and totals meet by a shuffle, which is the one that the counts need: rows
    that a Python function makes of a few splits look small, and would be sent whole
    to all tasks. Keys are one struct, in which nulls are equal.
    """
    value = F.lit(None).cast("long") if latest is None else latest[1]
    df = df.withColumns({"_part": F.struct(*keys, chunk.alias("_chunk")), "_flag": F.coalesce(flag.cast("long"), F.lit(0)), "_value": value})
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = df.groupBy("_part").agg(F.sum("_flag").alias("_total"), F.max("_value").alias("_top"))
    earlier = Window.partitionBy(*[F.col(f"_part.`{k}`") for k in keys]).orderBy("_part._chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns({"_before": F.coalesce(F.sum("_total").over(earlier), F.lit(0)), "_above": F.max("_top").over(earlier)}).drop("_total", "_top")
    joined = df.join(totals.hint("shuffle_hash"), "_part")
    found = {name: F.sum("_flag").over(inside) + F.col("_before")}
    if latest is not None:
        found[latest[0]] = F.greatest(F.max("_value").over(inside), F.col("_above"))
    return joined.withColumns(found).drop("_part", "_flag", "_value", "_before", "_above")


def assemble_events(lines: DataFrame, file_key: list[str], order: str, is_start: Column, chunk: Column | None = None, line: str = "line", piece: int = PIECE) -> DataFrame:
    """(*file_key, event, piece, offset, text): lines from one start to the next, joined by line ends.

    Lines before the first start of a file are an event of their own, number 0.
    `order` is the place of a line in its file; lines of one place come in the order
    of their texts. `chunk` cuts long files (by default every 2**16 steps of
    `order`). Null lines count as empty. An event whose lines span more than `piece`
    steps from its first one, or from 0 for event 0, is given in pieces, numbered
    from 0, so that a file without any start is never in one row.
    """
    chunk = F.floor(F.col(order) / (1 << 16)) if chunk is None else chunk
    rows = lines.select(*file_key, order, F.coalesce(line, F.lit("")).alias("_line"), is_start.alias("_start"))
    begin = F.when(F.col("_start"), F.col(order)).cast("long")
    rows = running_count(rows, F.col("_start"), file_key, [order, "_line"], chunk, "event", ("_begin", begin))
    rows = rows.withColumn("piece", F.floor((F.col(order) - F.coalesce("_begin", F.lit(0))) / piece))
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col("_line").alias("l"))))
    return rows.groupBy(*file_key, "event", "piece").agg(F.min(order).alias("offset"), F.array_join(F.transform(parts, lambda p: p.l), "\n").alias("text"))


def parse_log_events(
    lines: DataFrame,
    host: Column | None = None,
    parser: Callable[[Column], Column] | None = None,
    tz: str = "UTC",
    file_key: list[str] | None = None,
    order: str = "offset",
    chunk: Column | None = None,
    piece: int = PIECE,
) -> DataFrame:
    """Log events of RAW_LINE rows: assembled, parsed, those without a header dropped, with a host.

    `parser` maps a line or event to a struct (timestamp, level, location,
    message), null where it doesn't fit; it also says where events start. A pandas
    UDF will do. The result keeps the file key and the offset for order. An event
    with a header that spans more than `piece` bytes is an error that names the file;
    lines before the first header, however many, are dropped piece by piece.
    """
    parse = parser or (lambda c: parse_log_line(c, tz))
    keys = file_key or ["file"]
    events = assemble_events(lines, keys, order, parse(F.col("line")).isNotNull(), chunk, piece=piece)
    long = F.raise_error(F.concat(F.lit(f"an event of more than {piece} bytes in "), F.col(keys[-1] if "file" not in keys else "file").cast("string")))
    events = events.where((F.col("piece") == 0) | F.when(F.col("event") > 0, long.cast("boolean")).otherwise(F.lit(True)))
    parsed = events.select(*keys, "offset", parse(F.col("text")).alias("p")).where("p IS NOT NULL")
    return parsed.select(*keys, "offset", "p.timestamp", "p.level", "p.location", (F.lit("") if host is None else host).alias("host"), "p.message")
