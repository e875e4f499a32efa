"""Which archive file a message belongs to."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklogs.functions.times import DAY_MS
from sparklogs.shared import checkpoint, steps

MAX_BYTES = 60 * 1024 * 1024
#: Time of messages that one task merges with files, at least.
CHUNK_MS = 60_000
#: Steps of the order, and bytes, that one task runs over.
CHUNK_ROWS, CHUNK_BYTES = 1 << 16, 1 << 24


def _day(at: Column) -> Column:
    return F.floor(at / DAY_MS)


def chunk_ms(busiest: int) -> int:
    """Length of the chunks of a day, where the busiest day of a topic has so many messages: spread evenly, a quarter of CHUNK_ROWS a chunk."""
    return max(CHUNK_MS, DAY_MS // max(1, math.ceil(4 * busiest / CHUNK_ROWS)))


def assign_existing_segment(messages: DataFrame, index: DataFrame, per_topic: bool = True, width_ms: int | None = None) -> DataFrame:
    """`messages` with `start_ts` of the file with the greatest start <= timestamp of the same UTC day (and topic), null if none.

    A floor join: files and messages are merged in time order inside chunks of a day,
    and a chunk starts with the last file of earlier ones, so that a day of any size
    is spread over tasks. `width_ms` is the length of a chunk, for which `chunk_ms` takes
    the messages of the busiest day; without it chunks are short. Null times find nothing.
    """
    width = width_ms or CHUNK_MS
    keys = ["_topic", "_day", "_chunk"] if per_topic else ["_day", "_chunk"]
    place = lambda topic, at: {"_topic": F.coalesce(topic, F.lit("\0")), "_day": F.coalesce(_day(at), F.lit(0)), "_chunk": F.coalesce(F.floor(at / width), F.lit(0)), "_at": at}
    left = messages.withColumns({**place(F.col("topic"), F.col("timestamp")), "_start": F.lit(None).cast("long"), "_file": F.lit(0)})
    files = index.select(*[c.alias(n) for n, c in place(F.col("topic"), F.col("start_ts")).items()], F.col("start_ts").alias("_start"), F.lit(1).alias("_file"))
    both = left.unionByName(files, allowMissingColumns=True)
    earlier = Window.partitionBy(*keys[:-1]).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = both.groupBy(*keys).agg(F.max("_start").alias("_last"))
    both = both.join(chunks.select(*keys, F.max("_last").over(earlier).alias("_before")), keys)
    seen = Window.partitionBy(*keys).orderBy("_at", F.desc("_file")).rowsBetween(Window.unboundedPreceding, 0)
    found = F.coalesce(F.last("_start", ignorenulls=True).over(seen), F.col("_before"))
    both = both.withColumn("start_ts", F.when(F.col("timestamp").isNotNull(), found))
    return both.where("_file = 0").select(*messages.columns, "start_ts")


def _running(df: DataFrame, keys: list[str], chunk: Column, order: list[Column], what: dict[str, tuple[str, Column]], inclusive: bool = False, falling: bool = False) -> DataFrame:
    """`df` with a running sum, max or min of the rows before each (`inclusive`: and of itself), in order.

    `chunk` never falls along the order (`falling`: never rises). Windows run inside
    chunks and take over what earlier chunks come to, so that a key of any size is
    spread over tasks; one row a chunk is all that a key has in one place.
    """
    do = {"sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))), "max": (F.max, F.greatest), "min": (F.min, F.least)}
    df = df.withColumns({"_chunk": chunk, **{f"_of_{n}": c for n, (_, c) in what.items()}})
    totals = df.groupBy(*keys, "_chunk").agg(*[do[how][0](f"_of_{n}").alias(f"_all_{n}") for n, (how, _) in what.items()])
    along = F.desc("_chunk") if falling else F.asc("_chunk")
    earlier = Window.partitionBy(*keys).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "_chunk", *[do[how][0](f"_all_{n}").over(earlier).alias(f"_before_{n}") for n, (how, _) in what.items()])
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    both = df.join(totals, [*keys, "_chunk"])
    found = {n: do[how][1](do[how][0](f"_of_{n}").over(inside), F.col(f"_before_{n}")) for n, (how, _) in what.items()}
    return both.select(*[c for c in df.columns if c not in ("_chunk", *(f"_of_{n}" for n in what))], *[c.alias(n) for n, c in found.items()])


_DAY = ["_topic", "_day"]


def _by_arrival(seq: str = "seq") -> Column:
    return F.floor(F.col(seq) / CHUNK_ROWS)


def _next_rolls(peaks: DataFrame, late: DataFrame, max_bytes: int, kept: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`peaks` with `next`: the peak that would roll a file started at each.

    `peaks (keys, seq, ts, before, below)`: messages newer than all before them; `before`
    are the bytes that came before one, `below` those of older messages whenever
    they came. A file started at r holds what isn't below r, so at a peak q it has
    before(q) - below(r) + missing(r, q) bytes, where `missing` counts `late (keys, seq,
    size, level)` messages that are below r and come after q. It starts as what comes
    after r, which gives a q that is never too far on, and falls from round to round
    until nothing changes. Only peaks for which it fell look for their q again. What a
    peak knows goes along through the running sums, so that no round joins peaks.
    """
    known = [*_DAY, "seq", "ts", "before", "below"]
    found = peaks.withColumns({"missing": F.col("below") - F.col("before"), "next": F.lit(None).cast("long"), "ask": F.lit(True)})
    spots = peaks.select(*_DAY, F.col("before").alias("value"), F.lit(1).alias("peak"), F.col("seq").alias("spot"))
    some = not late.isEmpty()
    while True:
        asked = found.where("ask").select(*known, "missing", F.col("next").alias("was"), (F.col("below") + max_bytes - F.col("missing")).alias("value"), F.lit(0).alias("peak"))
        chunk = F.floor(F.col("value") / CHUNK_BYTES)
        met = _running(asked.unionByName(spots, allowMissingColumns=True), _DAY, chunk, [F.desc("value"), F.asc("peak")], {"next": ("min", F.col("spot"))}, falling=True)
        met = kept(met.where("peak = 0").select(*known, "missing", "was", "next"))
        now = found.where("NOT ask").select(*known, "missing", "next").union(met.select(*known, "missing", "next"))
        if not some or met.where("NOT next <=> was").isEmpty():
            return now.drop("missing")
        # the last r whose q had come when a late message came
        rolls = now.where("next IS NOT NULL").select(*_DAY, F.col("next").alias("at"), F.lit(0).alias("kind"), F.col("seq").alias("r"), F.lit(0).cast("long").alias("size"), F.lit(0).cast("long").alias("level"))
        comes = late.select(*_DAY, F.col("seq").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("r"), "size", "level")
        last = _running(rolls.union(comes), _DAY, _by_arrival("at"), [F.asc("at"), F.asc("kind")], {"last": ("max", F.col("r"))}, inclusive=True)
        last = kept(last.where("kind = 1 AND last > level").select(*_DAY, "level", "last", "size"))
        # it is missing from all peaks after its level up to that one
        falls = last.select(*_DAY, F.explode(F.array(F.struct(F.col("level").alias("seq"), F.col("size").alias("more")), F.struct(F.col("last").alias("seq"), (-F.col("size")).alias("more")))).alias("s")).select(*_DAY, "s.seq", F.lit(1).alias("step"), "s.more")
        axis = now.withColumnRenamed("missing", "held").withColumns({"step": F.lit(0), "more": F.lit(0).cast("long")})
        missing = _running(axis.unionByName(falls, allowMissingColumns=True), _DAY, _by_arrival(), [F.asc("seq"), F.asc("step")], {"missing": ("sum", F.col("more"))})
        found = kept(missing.where("step = 0").select(*known, "missing", "next", (F.col("missing") != F.col("held")).alias("ask")))


def _links(block: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """The place in its block that each peak points to (its own where that is outside), the pointers (-2: none), and the block in that order."""
    block = block.sort_by("seq")
    seq, to = block["seq"].to_numpy(), block["next"].fill_null(-2).to_numpy()
    inside = (to >= 0) & (to <= seq[-1])
    return np.where(inside, np.searchsorted(seq, to), np.arange(len(seq))), to, block


def _exits(block: pa.Table) -> pa.Table:
    """The first pointer of each peak that leads out of its block, where there is one."""
    place, to, block = _links(block)
    while not np.array_equal(further := place[place], place):
        place = further
    out = block.select([*_DAY, "seq"]).append_column("next", pa.array(to[place], pa.int64()))
    return out.filter(pa.array(to[place] >= 0))


def _walked(block: pa.Table) -> pa.Table:
    """The peaks that are reached in a block from the one where it is entered."""
    place, _, block = _links(block)
    at, reached = int(np.argmax(block["entered"].to_numpy())), []
    while not reached or at != reached[-1]:
        reached.append(at)
        at = int(place[at])
    return block.select([*_DAY, "seq", "ts"]).take(pa.array(reached))


def _roll_starts(seen: DataFrame, max_bytes: int, width_ms: int, kept: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(keys, start): times of the messages that open a file because of size.

    `seen (keys, seq, ts, size, before, top)` of the newest day of a topic as long as it
    is that, with the bytes and the newest time of what came before; a file that is
    there already is a row before all others, and others are numbered without gaps.
    Only a message newer than all before it, a peak, can roll, whatever the sizes
    are. Each peak points to the next one at which a file started there would roll.
    Blocks of CHUNK_ROWS messages tell where pointers lead out of them, those peaks
    where a block can be entered are followed from block to block by doubling, and a
    block that is entered is walked from there.
    """
    peak = F.coalesce(F.col("ts") > F.col("top"), F.lit(True))
    seen = seen.select(*_DAY, "seq", "ts", "size", "before", peak.alias("peak"), (~peak & (F.col("ts") < F.col("top"))).alias("late"))
    by_time = {"below": ("sum", F.col("size")), "level": ("max", F.when(F.col("peak"), F.col("seq")))}
    placed = kept(_running(seen, _DAY, F.floor(F.col("ts") / width_ms), [F.asc("ts"), F.asc("seq")], by_time).where("peak OR late"))
    peaks = placed.where("peak").select(*_DAY, "seq", "ts", "before", "below")
    late = placed.where("late").select(*_DAY, "seq", "size", F.coalesce("level", F.lit(-2)).alias("level"))
    found = _next_rolls(peaks, late, max_bytes, kept).select(*_DAY, "seq", "ts", "next", _by_arrival().alias("_block"))
    place = ["_topic string", "_day long", "seq long"]
    exits = kept(found.groupBy(*_DAY, "_block").applyInArrow(_exits, ", ".join([*place, "next long"])))
    marked = kept(found.groupBy(*_DAY).agg(F.min("seq").alias("seq")))
    entries = marked.union(exits.select(*_DAY, "next")).distinct()
    jumps = kept(exits.join(entries, [*_DAY, "seq"], "left_semi"))
    while not jumps.isEmpty():
        marked = kept(marked.union(marked.join(jumps, [*_DAY, "seq"]).select(*_DAY, "next")))
        onward = jumps.select(*_DAY, F.col("seq").alias("next"), F.col("next").alias("then"))
        jumps = kept(jumps.join(onward, [*_DAY, "next"]).select(*_DAY, "seq", F.col("then").alias("next")))
    entered = marked.select(*_DAY, _by_arrival().alias("_block"), F.col("seq").alias("_entry"))
    walk = found.join(entered, [*_DAY, "_block"]).withColumn("entered", (F.col("seq") == F.col("_entry")).cast("int"))
    starts = walk.groupBy(*_DAY, "_block").applyInArrow(_walked, ", ".join([*place, "ts long"]))
    return starts.where("seq >= 0").select(*_DAY, F.col("ts").alias("start"))


def _starts(sized: DataFrame, index: DataFrame | None, topic: Column, max_bytes: int, kept: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int]:
    """(topic, start_ts) of all files, those of `index` and new ones, for `sized (keys, seq, ts, size)`; and a length of chunks of a day."""
    none = sized.limit(0).select("_topic", "_day", F.col("ts").alias("start"), "size", F.col("ts").alias("recent"))
    files = none
    if index is not None:
        recent = F.greatest(F.coalesce("recent_ts", "start_ts"), "start_ts")
        files = kept(index.select(topic.alias("_topic"), _day(F.col("start_ts")).alias("_day"), F.col("start_ts").alias("start"), "size", recent.alias("recent")))
    there = files.groupBy(*_DAY).agg(F.min("start").alias("low"), F.max_by(F.struct("start", "size", "recent"), "start").alias("file"))
    days = sized.groupBy(*_DAY).agg(F.min("seq").alias("first"), F.sum("size").alias("bytes"), F.count("seq").alias("n")).join(there, _DAY, "full")
    first = F.when(F.col("file").isNotNull(), F.lit(-1)).otherwise(F.col("first"))
    later = Window.partitionBy("_topic").orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    days = kept(days.withColumn("stop", F.coalesce(F.min(first).over(later), F.lit((1 << 63) - 1))))

    width = chunk_ms(days.agg(F.max("n")).first()[0] or 0)  # one number
    rows = sized.select(*_DAY, "seq", "ts", "size", F.col("ts").alias("high"))
    newest = there.select(*_DAY, F.lit(-1).cast("long").alias("seq"), F.col("file.start").alias("ts"), "file.size", F.col("file.recent").alias("high"))
    runs = {"before": ("sum", F.col("size")), "top": ("max", F.col("high")), "least": ("min", F.col("ts")), "rank": ("sum", (F.col("seq") >= 0).cast("long"))}
    seen = _running(rows.union(newest) if index is not None else rows, _DAY, _by_arrival(), [F.asc("seq")], runs)
    large = (F.coalesce("bytes", F.lit(0)) + F.coalesce("file.size", F.lit(0)) > max_bytes) & (F.col("stop") >= 0)
    seen = kept(seen.join(days.select(*_DAY, "low", "stop", large.alias("large")), _DAY))
    lows = (F.col("seq") >= 0) & F.coalesce(F.col("ts") < F.least("least", "low"), F.lit(True))
    starts = seen.where(lows).select(*_DAY, F.col("ts").alias("start"))
    rolling = seen.where("large AND seq < stop").select(*_DAY, F.when(F.col("seq") >= 0, F.col("rank")).otherwise(-1).alias("seq"), "ts", "size", "before", "top")
    if not rolling.isEmpty():
        starts = starts.union(_roll_starts(rolling, max_bytes, width, kept))
    starts = starts.union(files.select(*_DAY, "start")).distinct()
    known = checkpoint(starts.select(F.nullif("_topic", F.lit("\0")).alias("topic"), F.col("start").alias("start_ts")))
    return known, width


def assign_segments(messages: DataFrame, max_bytes: int = MAX_BYTES, index: DataFrame | None = None, order: str = "seq", per_topic: bool = True) -> DataFrame:
    """`messages (topic, timestamp, value, <order>)` with `segment_ts`, the start of the file each goes to, in order of arrival.

    A message goes to the file with the greatest start up to its time. There is a
    new file if that file is of another UTC day or there is none, or if it is the
    newest of all, the message is newer than all in it and it has over `max_bytes`.
    Sizes are bytes of values without line ends; files of `index` (ARCHIVE_INDEX)
    count with their own. The order must be unique in a topic and not negative.
    Messages without a time go.

    Which messages open files is found first. A message older than all starts of its
    day opens one, and no other start depends on it. Roll points: see `_roll_starts`,
    asked only for days with more bytes than the limit; the newest day is left at the
    first message or file of a later day, which is known beforehand. Then every message
    finds its start by a floor join, as no start lies between a message's time and
    its own file's start unless it was there when the message came. No step has a
    topic's day in one task. Steps lie in a folder below the shared one, which goes at the end.
    """
    topic = F.coalesce("topic", F.lit("\0")) if per_topic else F.lit("")
    timed = messages.where("timestamp IS NOT NULL")
    sized = timed.select(topic.alias("_topic"), _day(F.col("timestamp")).alias("_day"), F.col(order).cast("long").alias("seq"), F.col("timestamp").alias("ts"), F.coalesce(F.octet_length("value"), F.lit(0)).cast("long").alias("size"))
    with steps(messages.sparkSession) as kept:
        known, width = _starts(kept(sized), index, topic, max_bytes, kept)
    return assign_existing_segment(timed, known, per_topic, width).withColumnRenamed("start_ts", "segment_ts")


def segment_sizes(assigned: DataFrame) -> DataFrame:
    """(topic, segment_ts, messages, bytes) of each file."""
    return assigned.groupBy("topic", "segment_ts").agg(F.count(F.lit(1)).alias("messages"), F.sum(F.coalesce(F.octet_length("value"), F.lit(0)).cast("long")).alias("bytes"))
