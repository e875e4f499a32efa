"""Registered queries of sources, sinks and streams: they write what the tables hold below the shared folder, as files, topics or an archive, and read it with the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.functions.times import format_time
from sparklogs.operators import stats
from sparklogs.operators.events import parse_log_events
from sparklogs.plans.search import kept_search, log_search, matches
from sparklogs.queries import KEYS, LOGS_SQL, RULE, SPEC, SQL, START, STATS, TRANSFERS_SQL, _messages, _renamed, logs, query, transfers_log
from sparklogs.shared import checkpoint, children, move, new_folder
from sparklogs.sources import archive, files, messages, topics
from sparklogs.streaming import jobs

def log_files(spark: SparkSession, sf_dir: str, numeric: bool = False) -> str:
    """A folder of rolling files, one a day, the last of them app.log: events of two lines in the order of seq."""
    rows = logs(spark, sf_dir)
    time = F.concat(format_time(F.col("timestamp")), F.lit(","), F.lpad((F.col("timestamp") % 1000).cast("string"), 3, "0"))
    text = F.concat(time, F.lit(" "), F.col("level"), F.lit(" "), F.col("location"), F.lit(": "), F.col("message"), F.lit("\n  at "), F.col("host"))
    folder = new_folder(spark, "logs")
    dated = rows.select(F.substring(time, 1, 10).alias("day"), F.col("seq"), text.alias("value"))
    dated.repartition("day").sortWithinPartitions("day", "seq").drop("seq").write.partitionBy("day").text(f"{folder}/parts")
    days = sorted(d for d in children(spark, f"{folder}/parts") if d.startswith("day="))
    for k, day in enumerate(days):  # one file a day
        (part,) = (p for p in children(spark, f"{folder}/parts/{day}") if p.startswith("part-"))
        ago = len(days) - 1 - k
        name = "app.log" if not ago else f"app.log.{ago}" if numeric else f"app.log.{day.split('=')[1]}"
        move(spark, f"{folder}/parts/{day}/{part}", f"{folder}/files/{name}")
    return f"{folder}/files"


def _name(path: str) -> Column:
    return F.substring_index(path, "/", -1)


_TEXT_SQL = f"""{LOGS_SQL}, days AS (SELECT DISTINCT timestamp // 86400000 AS day FROM logs),
  named AS (SELECT day, CASE WHEN day = max(day) OVER () THEN 'app.log' ELSE 'app.log.' || strftime(make_timestamp(day * 86400000000), '%Y-%m-%d') END AS file, row_number() OVER (ORDER BY day) AS file_ord FROM days),
  texts AS (SELECT l.*, file, file_ord, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d %H:%M:%S,%g ') || level || ' ' || location || ': ' || message AS head, '  at ' || host AS tail FROM logs l JOIN named ON timestamp // 86400000 = day),
  lines AS (SELECT file, seq, 0 AS part, head AS line FROM texts UNION ALL SELECT file, seq, 1, tail FROM texts),
  placed AS (SELECT file, line, seq, part, CAST(sum(strlen(line) + 1) OVER (PARTITION BY file ORDER BY seq, part ROWS UNBOUNDED PRECEDING) AS BIGINT) - strlen(line) - 1 AS "offset" FROM lines),
  sizes AS (SELECT file, CAST(sum(strlen(line) + 1) AS BIGINT) AS size FROM lines GROUP BY 1)"""


@query(f"WITH {_TEXT_SQL} SELECT file, size, CAST(file_ord AS INT) AS file_ord FROM sizes JOIN named USING (file)")
def discover_files_daily(spark, sf_dir):
    return files.discover_files(spark, log_files(spark, sf_dir), "^app[.]log").select(_name("path").alias("file"), "size", "file_ord")


@query(f"""WITH {_TEXT_SQL} SELECT 'app.log' || CASE WHEN n = file_ord THEN '' ELSE '.' || (n - file_ord) END AS file, size, CAST(file_ord AS INT) AS file_ord
  FROM (SELECT *, max(file_ord) OVER () AS n FROM named) JOIN sizes USING (file)""")
def discover_files_numeric(spark, sf_dir):
    return files.discover_files(spark, log_files(spark, sf_dir, True), "^app[.]log", "numeric").select(_name("path").alias("file"), "size", "file_ord")


@query(f"WITH {_TEXT_SQL} SELECT file, size, CAST(1 + (SELECT count(*) FROM named) - file_ord AS INT) AS file_ord FROM sizes JOIN named USING (file) WHERE file <> 'app.log'")
def discover_files_custom(spark, sf_dir):
    """Newest first, without the live file."""
    found = files.discover_files(spark, log_files(spark, sf_dir), "^app[.]log", lambda p: [p.endswith("app.log").desc(), p.desc()])
    return found.where(_name("path") != "app.log").select(_name("path").alias("file"), "size", "file_ord")


def _paths(spark: SparkSession, folder: str) -> list[str]:
    return [f"{folder}/{n}" for n in children(spark, folder)]


@query(f'WITH {_TEXT_SQL} SELECT file, "offset", line FROM placed')
def read_lines(spark, sf_dir):
    return files.read_lines(spark, _paths(spark, log_files(spark, sf_dir))).select(_name("file").alias("file"), "offset", "line")


@query(f'WITH {_TEXT_SQL} SELECT file, "offset", line FROM placed JOIN sizes USING (file) WHERE "offset" >= size // 2')
def read_lines_from(spark, sf_dir):
    folder = log_files(spark, sf_dir)
    starts = files.discover_files(spark, folder, ".").select("path", F.floor(F.col("size") / 2).alias("read_from"))
    return files.read_lines(spark, _paths(spark, folder), starts).select(_name("file").alias("file"), "offset", "line")


@query(f"WITH {_TEXT_SQL} SELECT 'app' AS topic, line AS first_line, file AS path, size FROM placed JOIN sizes USING (file) WHERE \"offset\" = 0")
def build_manifest(spark, sf_dir):
    found = files.build_manifest(spark, files.discover_files(spark, log_files(spark, sf_dir), "."), "app")
    return found.withColumn("path", _name("path")).drop("modified")


@query(f"WITH {_TEXT_SQL} SELECT 'app' AS topic, line AS first_line, file AS path, size FROM placed JOIN sizes USING (file) WHERE \"offset\" = 0")
def manifest_round_trip(spark, sf_dir):
    folder = new_folder(spark, "manifest")
    now = files.build_manifest(spark, files.discover_files(spark, log_files(spark, sf_dir), "."), "app")
    files.save_manifest(now.limit(0), folder)
    files.save_manifest(now, folder)
    return files.load_manifest(spark, folder).withColumn("path", _name("path")).drop("modified")


_EVENTS_SQL = f"""WITH {_TEXT_SQL} SELECT t.file, "offset", timestamp, level, location, 'box' AS host, message || chr(10) || tail AS message
  FROM texts t JOIN placed p ON t.file = p.file AND t.seq = p.seq AND part = 0"""


@query(_EVENTS_SQL)
def parse_log_events_query(spark, sf_dir):
    lines = files.read_lines(spark, _paths(spark, log_files(spark, sf_dir)))
    return parse_log_events(lines, F.lit("box")).withColumn("file", _name("file"))


@query(_EVENTS_SQL)
def parse_with_own_parser(spark, sf_dir):
    """A parser of the user's: the header is what stands before the first colon after the time."""
    lines = files.read_lines(spark, _paths(spark, log_files(spark, sf_dir)))

    def parser(c: Column) -> Column:
        part = lambda i: F.regexp_extract(c, r"(?s)^(\S+ \S+),(\d+) (\S+) (\S+): (.*)$", i)
        ms = F.unix_millis(F.try_to_timestamp(F.concat(part(1), F.lit("Z")), F.lit("yyyy-MM-dd HH:mm:ssX"))) + part(2).try_cast("long")
        return F.when(ms.isNotNull(), F.struct(ms.alias("timestamp"), part(3).alias("level"), part(4).alias("location"), part(5).alias("message")))

    return parse_log_events(lines, F.lit("box"), parser).withColumn("file", _name("file"))


@query(f"WITH {_TEXT_SQL} SELECT timestamp, level, location, 'box' AS host, message || chr(10) || tail AS message FROM texts")
def run_collector(spark, sf_dir):
    """Two cycles: the second finds nothing new."""
    out, state = new_folder(spark, "topic"), new_folder(spark, "state")
    specs = {"app": files.TopicSpec(log_files(spark, sf_dir), "^app[.]log")}
    for _ in range(2):
        jobs.run_collector(spark, specs, state, "box", folder=out)
    return topics.from_topic(spark.read.parquet(out))


@query(f"""WITH {_TEXT_SQL} SELECT topic, host, file, "offset", timestamp, level, location, message FROM (
    SELECT 'daily' AS topic, 'box' AS host, t.file, p."offset", timestamp, level, location, message || chr(10) || tail AS message FROM texts t JOIN placed p ON t.file = p.file AND t.seq = p.seq AND part = 0
    UNION ALL SELECT 'live', 'box', t.file, p."offset", timestamp, level, location, message || chr(10) || tail FROM texts t JOIN placed p ON t.file = p.file AND t.seq = p.seq AND part = 0 WHERE t.file = 'app.log'
    UNION ALL SELECT 'hosts', 'box', file, "offset", 0, 'INFO', 'host', line FROM placed WHERE part = 1 AND file = 'app.log')""")
def collect_topics(spark, sf_dir):
    """Three topics of one folder: all files, the live file alone, and its second lines by a parser of the user's; a second cycle finds nothing new."""
    folder = log_files(spark, sf_dir)
    own = lambda c: F.when(c.rlike("^  at "), F.struct(F.lit(0).cast("long").alias("timestamp"), F.lit("INFO").alias("level"), F.lit("host").alias("location"), F.substring_index(c, "\n", 1).alias("message")))
    specs = {"daily": files.TopicSpec(folder, "^app[.]log"), "live": files.TopicSpec(folder, "[.]log$", "numeric"), "hosts": files.TopicSpec(folder, "[.]log$", "numeric", own)}
    events, manifest = files.collect_topics(spark, specs, files.load_manifest(spark, f"{folder}/none"), "box")
    again, _ = files.collect_topics(spark, specs, manifest, "box")
    return events.unionByName(again).withColumn("file", _name("file")).drop("file_ord")


_PLACED_SQL = f"""WITH {LOGS_SQL}, m AS (SELECT *, timestamp // 86400000 AS day FROM logs),
  low AS (SELECT *, min(timestamp) OVER (PARTITION BY location, day ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM m),
  s AS (SELECT location, day, seq AS since, timestamp AS start FROM low WHERE before IS NULL OR timestamp < before),
  placed AS (SELECT m.seq, location AS topic, any_value(timestamp) AS timestamp, any_value(level) AS level, any_value(host) AS host, any_value(message) AS message, max(start) AS segment_ts
             FROM m JOIN s USING (location, day) WHERE since <= seq AND start <= timestamp GROUP BY 1, 2)"""
_PATH_SQL = "strftime(make_timestamp(segment_ts * 1000), '%Y-%m-%d/%Y%m%dT%H%M%S.%gZ.') || topic AS path"


@query(f"{_PLACED_SQL} SELECT seq, topic, segment_ts, {_PATH_SQL} FROM placed")
def write_archive(spark, sf_dir):
    return archive.write_archive(_messages(spark, sf_dir), new_folder(spark, "archive")).select("seq", "topic", "segment_ts", "path")


@query(f"""{_PLACED_SQL} SELECT segment_ts AS start_ts, topic, strftime(make_timestamp(segment_ts * 1000), '%Y%m%d') AS day, {_PATH_SQL}, max(timestamp) AS recent_ts,
  CAST(sum(strlen('{{"timestamp":' || timestamp || ',"level":"' || level || '","location":"' || topic || '","host":"' || host || '","message":"' || message || '"}}') + 1) AS BIGINT) AS size
  FROM placed GROUP BY segment_ts, topic""")
def scan_archive(spark, sf_dir):
    """After the same batch has been written twice."""
    base = new_folder(spark, "archive")
    for _ in range(2):
        archive.write_archive(_messages(spark, sf_dir), base, batch="one")
    found = archive.scan_archive(spark, base)
    return found.withColumn("path", F.substring_index("path", "/", -2))


@query(f"WITH {LOGS_SQL} SELECT timestamp, level, location, host, message FROM logs WHERE timestamp >= {START} AND timestamp < {START + 3 * RULE.window_ms}")
def read_archive(spark, sf_dir):
    base = new_folder(spark, "archive")
    archive.write_archive(_messages(spark, sf_dir), base)
    return archive.read_archive(spark, base, START, START + 3 * RULE.window_ms)


@query(SQL["match_chart"])
def log_search_matchchart(spark, sf_dir):
    """Without a start: one window before the clock, which is given here."""
    return log_search(logs(spark, sf_dir), SPEC, now_ms=lambda: START + RULE.window_ms)["matchchart"]


@query(SQL["log_table"])
def log_search_logtable(spark, sf_dir):
    return log_search(logs(spark, sf_dir), SPEC, START)["logtable"]


@query(SQL["group_table_long"])
def log_search_grouptable(spark, sf_dir):
    return log_search(logs(spark, sf_dir), SPEC, START)["grouptable"]


@query(f"SELECT 'matchchart' AS result, count(*) AS n FROM ({SQL['match_chart']}) UNION ALL SELECT 'logtable', count(*) FROM ({SQL['log_table']}) UNION ALL SELECT 'grouptable', count(*) FROM ({SQL['group_table_long']}) UNION ALL SELECT 'meta', count(*) FROM ({SQL['log_search_meta']})")
def log_search_all(spark, sf_dir):
    """Rows of all four tables of one search."""
    with kept_search(logs(spark, sf_dir), SPEC, START) as tables:
        counts = [table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("result"), "n") for name, table in tables.items()]
        return checkpoint(topics.union_all(counts))


@query(f"""SELECT bucket, CASE WHEN count(gid) = 0 THEN '[]' ELSE '[' || string_agg('{{"gid":' || gid || ',"count_user":' || count_user || ',"sum_k":' || sum_k || '}}', ',' ORDER BY gid) || ']' END AS events
  FROM ({SQL["group_table_long"]}) GROUP BY bucket""")
def group_table_nested(spark, sf_dir):
    found = stats.group_table(matches(logs(spark, sf_dir), SPEC, START), KEYS, STATS, RULE, START, nested=True)
    return found.select("bucket", F.to_json("events").alias("events"))


def _topic(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """A stream of what a topic holds."""
    folder = new_folder(spark, "topic")
    topics.write_topic(topics.to_topic(rows, "app"), folder=folder)
    return topics.read_topics(spark, ["app"], folder=folder)


def _drained(df: DataFrame) -> DataFrame:
    """What a stream gives until its source is read to the end."""
    spark, folder = df.sparkSession, new_folder(df.sparkSession, "stream")
    df.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


@query(f"WITH {LOGS_SQL} SELECT timestamp, level, location, host, message FROM logs")
def stream_topic(spark, sf_dir):
    return _drained(topics.from_topic(_topic(spark, logs(spark, sf_dir))))


@query(f"""WITH {LOGS_SQL} SELECT timestamp // 3600000 * 3600000 AS window_start, level, count(*) AS count_message FROM logs
  WHERE timestamp // 3600000 * 3600000 + 3600000 <= (SELECT max(timestamp) FROM logs) - 3600000 GROUP BY 1, 2""")
def stream_group_stats(spark, sf_dir):
    """Windows that are closed when the source ends."""
    found = topics.from_topic(_topic(spark, logs(spark, sf_dir)))
    return _drained(jobs.stream_group_stats(found, ["level"], [stats.Stat("count", "message")], "1 hour", "1 hour"))


@query(f"""WITH {TRANSFERS_SQL}, w AS (SELECT x.*, timestamp // 1800000 * 1800000 - 1800000 * i AS window_start FROM x, range(2) r(i))
  SELECT window_start, window_start + 3600000 AS window_end, srcip AS src, destip AS dest, CAST(sum(filesize) AS BIGINT) AS dataflow FROM w
  WHERE window_start + 3600000 <= (SELECT max(timestamp) FROM x) - 60000 GROUP BY 1, 2, 3, 4""")
def stream_flow_totals(spark, sf_dir):
    rows = transfers_log(spark, sf_dir).select("timestamp", F.lit("INFO").alias("level"), F.lit("node").alias("location"), F.lit("box").alias("host"), "message")
    return _drained(jobs.stream_flow_totals(topics.from_topic(_topic(spark, rows)), "1 hour", "30 minutes", "1 minute", F.lit(1 << 60)))


@query(f"""SELECT 'matchchart' AS result, concat_ws('|', bucket, search_count) AS "row" FROM ({SQL['match_chart']})
  UNION ALL SELECT 'logtable', concat_ws('|', timestamp, level, location, host, "user", action, k, seq, message) FROM ({SQL['log_table']})
  UNION ALL SELECT 'grouptable', concat_ws('|', bucket, gid, count_user, sum_k) FROM ({SQL['group_table_long']})
  UNION ALL SELECT 'meta', concat_ws('|', gid, action, count_user, sum_k) FROM ({SQL['log_search_meta']})""")
def stream_search(spark, sf_dir):
    """All four tables of one stream, after three batches."""
    rows, out = logs(spark, sf_dir), new_folder(spark, "search")
    stream = messages.read_messages(spark, _published(spark, rows, ["seq"]), ["app"], f"{out}/position", "earliest", -(-rows.count() // 3))
    _ended(jobs.stream_search(stream, SPEC, out, f"{out}/state", trigger=_AT_ONCE, now_ms=lambda: START + RULE.window_ms))
    columns = {"matchchart": ["bucket", "search_count"], "logtable": ["timestamp", "level", "location", "host", "user", "action", "k", "seq", "message"], "grouptable": ["bucket", "gid", "count_user", "sum_k"], "meta": ["gid", "action", "count_user", "sum_k"]}
    told = lambda name: spark.read.parquet(f"{out}/{name}").select(F.lit(name).alias("result"), F.concat_ws("|", *[F.col(c).cast("string") for c in columns[name]]).alias("row"))
    return topics.union_all([told(name) for name in columns])


@query(f"WITH {LOGS_SQL} SELECT timestamp, level, location, host, message FROM logs")
def stream_archive(spark, sf_dir):
    """In several batches, all of it read back."""
    rows, base = logs(spark, sf_dir), new_folder(spark, "archive")
    log = _published(spark, rows, ["seq"])
    stream = messages.read_messages(spark, log, ["app"], f"{base}-position", "earliest", -(-rows.count() // 3)).withColumn("topic", F.get_json_object("value", "$.location"))
    _ended(jobs.stream_archive(stream, base, f"{base}-state", trigger=_AT_ONCE))
    first, last = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    return archive.read_archive(spark, base, first, last + 1)


#: Batches follow one another without a pause.
_AT_ONCE = {"processingTime": "0 seconds"}


def _ended(started) -> None:
    """Lets a stream read its source to the end."""
    started.processAllAvailable()
    started.stop()
    started.awaitTermination()


def _published(spark: SparkSession, rows: DataFrame, order: list[str], topic: str = "app") -> str:
    """A log of messages of LOG rows."""
    folder = new_folder(spark, "log")
    messages.publish(topics.to_topic(rows, topic, order), folder, order)
    return folder


@query(f"WITH {LOGS_SQL}, c AS (SELECT count(*) AS n FROM logs) SELECT i AS batch, least(4000, n - 4000 * i) AS messages, 4000 * i AS first FROM c, range(100000) r(i) WHERE 4000 * i < n")
def stream_batches(spark, sf_dir):
    """Batches of at most 4,000 messages each, many of them in a micro-batch."""
    folder = new_folder(spark, "batches")
    stream = messages.read_messages(spark, _published(spark, logs(spark, sf_dir), ["seq"]), ["app"], f"{folder}/position", "earliest", 4_000, per_trigger=100)
    keep = lambda df, n: df.select("offset", "batch").write.mode("overwrite").parquet(f"{folder}/out/{n}")
    _ended(stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/state").start())
    return spark.read.parquet(f"{folder}/out/*").groupBy("batch").agg(F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first"))


@query(f"WITH {LOGS_SQL} SELECT timestamp, level, location, host, message FROM logs WHERE seq % 2 = 1")
def stream_from_newest(spark, sf_dir):
    """Messages with even numbers are there before the start and don't come; the others are published after it."""
    rows, folder = logs(spark, sf_dir), new_folder(spark, "newest")
    log = _published(spark, rows.where("seq % 2 = 0"), ["seq"])
    stream = messages.read_messages(spark, log, ["app"], f"{folder}/position", "latest", 100_000_000)
    started = topics.from_topic(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").start()
    started.processAllAvailable()
    messages.publish(topics.to_topic(rows.where("seq % 2 = 1"), "app", ["seq"]), log, ["seq"])
    _ended(started)
    return spark.read.parquet(f"{folder}/out")


@query(f"""WITH {LOGS_SQL}, p AS (SELECT *, row_number() OVER (ORDER BY (seq + seq * 37 % 50) * 100 + seq % 100) - 1 AS place, count(*) OVER () AS n FROM logs),
  b AS (SELECT *, place // (n // 4 + 1) AS batch FROM p), t AS (SELECT batch, max(timestamp) AS top FROM b GROUP BY 1),
  w AS (SELECT b.batch, max(top) AS newest FROM (SELECT DISTINCT batch FROM b) b JOIN t ON t.batch < b.batch GROUP BY 1)
  SELECT place AS "offset", timestamp, location, message, coalesce(timestamp < newest - 1800000, FALSE) AS late FROM b LEFT JOIN w USING (batch)""")
def stream_late(spark, sf_dir):
    """Four batches of messages that come up to fifty places late; more than half an hour is too late."""
    seq = F.col("seq")
    rows = logs(spark, sf_dir).withColumn("arrival", (seq + seq * 37 % 50) * 100 + seq % 100)
    folder = new_folder(spark, "late")
    stream = messages.read_messages(spark, _published(spark, rows, ["arrival"]), ["app"], f"{folder}/position", "earliest", rows.count() // 4 + 1)
    _ended(jobs.stream_late_split(stream, folder, f"{folder}/state", 1_800_000, _AT_ONCE))
    read = lambda name: spark.read.parquet(f"{folder}/{name}").select("offset", "timestamp", "location", "message")
    return read("late").withColumn("late", F.lit(True)).unionByName(read("in_time").withColumn("late", F.lit(False)))


@query(f"""{_PLACED_SQL} SELECT segment_ts AS start_ts, topic, strftime(make_timestamp(segment_ts * 1000), '%Y%m%d') AS day, {_PATH_SQL}, max(timestamp) AS recent_ts,
  CAST(sum(strlen('{{"timestamp":' || timestamp || ',"level":"' || level || '","location":"' || topic || '","host":"' || host || '","message":"' || message || '"}}') + 1) AS BIGINT) AS size
  FROM placed GROUP BY segment_ts, topic""")
def archive_index(spark, sf_dir):
    """The kept index after two batches, the second of which has been written twice."""
    base, rows = new_folder(spark, "archive"), _messages(spark, sf_dir)
    half = rows.count() // 2
    for batch, part in (("one", F.col("seq") < half), ("two", F.col("seq") >= half), ("two", F.col("seq") >= half)):
        archive.write_archive(rows.where(part), base, batch=batch)
    return archive.load_index(spark, base).withColumn("path", F.substring_index("path", "/", -2))


_renamed("parse_log_events_query", "parse_log_events")
