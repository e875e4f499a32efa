"""The registered queries of the log jobs and their SQL. Log views are derived from `events`, manifests from `pages` and `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.functions.parsing import parse_log_line
from sparklogs.functions.times import archive_path, format_time, path_timestamp, time_bucket, utc_day
from sparklogs.operators import filters, jobs, segments, stats, traffic
from sparklogs.operators.events import assemble_events
from sparklogs.operators.extract import extract_fields, route_first_match
from sparklogs.operators.stats import Stat, TimeRule
from sparklogs.plans.search import SearchSpec, log_search, matches
from sparklogs.sources import files, topics

#: 2024-01-10 06:30:00 UTC, one day in hours.
START, RULE = 1_704_868_200_000, TimeRule(86_400_000, 3_600_000)
EXTRACTS = [("user * did", "user"), ("did * k=", "action"), ("k=* end", "k")]
KEYS = ["action"]
STATS = [Stat("count", "user"), Stat("sum", "k")]
SPEC = SearchSpec("did", RULE, EXTRACTS, KEYS, STATS)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOG rows with seq, of `events`."""
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "signup", "WARN").otherwise("INFO")
    k = F.get_json_object("props", "$.k")
    message = F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" did "), kind, F.lit(" k="), k, F.lit(" end"))
    return _table(spark, sf_dir, "events").select(
        F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts")).alias("timestamp"),
        level.alias("level"),
        F.concat(F.lit("app."), kind).alias("location"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 16).cast("string")).alias("host"),
        message.alias("message"),
        F.col("event_id").alias("seq"),
    )


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows that match the search's keyword, with all its fields, whenever they were."""
    return filters.drop_incomplete(extract_fields(filters.keyword_filter(logs(spark, sf_dir), SPEC.keyword), SPEC.extracts))


def transfers_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOG rows with data-node messages, of `events`."""
    kind, user, k = F.col("event_type"), (F.col("user_id") % 16).cast("string"), (F.get_json_object("props", "$.k").cast("int") % 8).cast("string")
    cents = F.round(F.col("value") * 100).cast("long").cast("string")
    trace, ident = kind.isin("view", "purchase"), F.col("event_id").cast("string")
    told = F.concat(
        F.when(trace, "").otherwise(F.concat(F.lit("Received block blk_"), ident, F.lit(" "))),
        F.lit("src: /10.0.0."), user, F.lit(":50010"), F.when(trace, ", ").otherwise(" "),
        F.lit("dest: /10.0.1."), k, F.lit(":4000"), F.when(trace, ", bytes: ").otherwise(" of size "), cents,
        F.when(kind == "view", ", op: HDFS_READ, cliID: c").when(trace, ", op: HDFS_WRITE, cliID: c").otherwise(""),
    )
    message = F.when(trace | (kind == "click"), told).otherwise(F.concat(F.lit("Transmitted block blk_"), ident))
    ts = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts"))
    return _table(spark, sf_dir, "events").select(ts.alias("timestamp"), message.alias("message"), F.col("event_id").alias("seq"))


LOGS_SQL = """logs AS (SELECT epoch_us(ts) // 1000 AS timestamp,
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS level,
    'app.' || event_type AS location, '10.0.0.' || (user_id % 16) AS host,
    'user ' || user_id || ' did ' || event_type || ' k=' || json_extract_string(props, '$.k') || ' end' AS message, event_id AS seq FROM events)"""
TRANSFERS_SQL = """t AS (SELECT epoch_us(ts) // 1000 AS timestamp, event_id AS seq, event_type, '10.0.0.' || (user_id % 16) AS src,
    '10.0.1.' || (CAST(json_extract_string(props, '$.k') AS INT) % 8) AS dest, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
  x AS (SELECT timestamp, seq, CASE WHEN event_type = 'view' THEN src ELSE dest END AS srcip, CASE WHEN event_type = 'view' THEN dest ELSE src END AS destip,
    cents AS filesize, CASE event_type WHEN 'view' THEN 'read' WHEN 'purchase' THEN 'write' ELSE 'received' END AS tag FROM t WHERE event_type IN ('view', 'purchase', 'click')),
  flows AS (SELECT srcip AS src, destip AS dest, CAST(sum(filesize) AS BIGINT) AS dataflow FROM x GROUP BY 1, 2)"""
_WINDOW = f"timestamp > {START} AND timestamp < {START + RULE.window_ms}"
_FOUND_SQL = rf"""{LOGS_SQL}, f AS (SELECT *, regexp_extract(message, 'user (\S*) did', 1) AS "user", regexp_extract(message, 'did (\S*) k=', 1) AS action,
    regexp_extract(message, 'k=(\S*) end', 1) AS k FROM logs WHERE {_WINDOW} AND lower(message) LIKE '%did%')"""
#: The same without a window.
_ALL_SQL = _FOUND_SQL.replace(f"{_WINDOW} AND ", "")
_LABEL = "strftime(make_timestamp((timestamp - timestamp % 3600000) * 1000), '%Y-%m-%d %H:%M:%S')"
_GRID_SQL = f"grid AS (SELECT DISTINCT strftime(make_timestamp((p - p % 3600000) * 1000), '%Y-%m-%d %H:%M:%S') AS bucket FROM (SELECT {START} + 5000 * i AS p FROM range({RULE.window_ms // 5000}) r(i)))"
_META_SQL = 'meta AS (SELECT CAST(row_number() OVER (ORDER BY action) - 1 AS INT) AS gid, action, count(*) AS count_user, CAST(sum(CAST(k AS BIGINT)) AS BIGINT) AS sum_k FROM f GROUP BY action)'

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


@query(f"WITH {LOGS_SQL} SELECT * FROM logs WHERE lower(message) LIKE '%did error k=1%'")
def keyword_filter(spark, sf_dir):
    return filters.keyword_filter(logs(spark, sf_dir), " Did ERROR k=1 ")


@query(f"WITH {LOGS_SQL} SELECT * FROM logs WHERE {_WINDOW}")
def time_filter(spark, sf_dir):
    return filters.time_filter(logs(spark, sf_dir), START, RULE.window_ms)


@query(f"WITH {LOGS_SQL} SELECT * FROM logs WHERE timestamp > {START - 3_600_000} AND timestamp < {START + 60_000}")
def recent(spark, sf_dir):
    return filters.recent(logs(spark, sf_dir), START, 3_600_000, 60_000)


@query(f"WITH {LOGS_SQL} SELECT * FROM logs WHERE message LIKE '%did view%' AND level = 'INFO'")
def search_filter(spark, sf_dir):
    return filters.search_filter(logs(spark, sf_dir), [F.col("message").contains("did view"), F.col("level") == "INFO"])


@query(f"WITH {TRANSFERS_SQL} SELECT timestamp, seq FROM t WHERE event_type <> 'click'")
def drop_noise(spark, sf_dir):
    return filters.drop_noise(transfers_log(spark, sf_dir)).select("timestamp", "seq")


@query(rf"""WITH {LOGS_SQL} SELECT seq, regexp_extract(message, 'user (\S*) did', 1) AS "user",
  CASE WHEN regexp_matches(message, 'did (\S*)') THEN regexp_extract(message, 'did (\S*)', 1) END AS action,
  CASE WHEN regexp_matches(message, 'k=1(\S*) end') THEN regexp_extract(message, 'k=1(\S*) end', 1) END AS k1,
  CASE WHEN message LIKE '%did error%' THEN '' END AS error FROM logs""")
def extract_fields_query(spark, sf_dir):
    rules = [("user * did", "user"), ("did *", "action"), ("k=1* end", "k1"), ("did error", "error")]
    return extract_fields(logs(spark, sf_dir), rules).select("seq", "user", "action", "k1", "error")


@query(rf"WITH {LOGS_SQL} SELECT seq, regexp_extract(message, 'k=1(\S*) end', 1) AS k1 FROM logs WHERE regexp_matches(message, 'k=1(\S*) end')")
def drop_incomplete(spark, sf_dir):
    return filters.drop_incomplete(extract_fields(logs(spark, sf_dir), [("k=1* end", "k1")])).select("seq", "k1")


@query(f"WITH {_ALL_SQL} SELECT action, count(*) AS count_user, CAST(sum(CAST(k AS BIGINT)) AS BIGINT) AS sum_k FROM f GROUP BY action")
def group_stats(spark, sf_dir):
    return stats.group_stats(extracted(spark, sf_dir), KEYS, STATS)


@query(f"WITH {_ALL_SQL} SELECT {_LABEL} AS bucket, action, count(*) AS count_user, CAST(sum(CAST(k AS BIGINT)) AS BIGINT) AS sum_k FROM f GROUP BY 1, 2")
def group_stats_by_time(spark, sf_dir):
    return stats.group_stats_by_time(extracted(spark, sf_dir), KEYS, STATS, RULE)


@query(f"WITH {_ALL_SQL} SELECT action, max(CAST(k AS BIGINT)) AS max_k FROM f GROUP BY action")
def custom_statistic(spark, sf_dir):
    return stats.group_stats(extracted(spark, sf_dir), KEYS, [Stat(lambda c: F.max(c.try_cast("long")), "k", "max_k")])


@query(f"WITH {_ALL_SQL}, {_META_SQL} SELECT * FROM meta")
def group_meta(spark, sf_dir):
    return stats.group_meta(extracted(spark, sf_dir), KEYS, STATS)


@query(f"WITH {_FOUND_SQL}, {_GRID_SQL} SELECT bucket, count(b) AS search_count FROM grid LEFT JOIN (SELECT {_LABEL} AS b FROM f) ON b = bucket GROUP BY bucket")
def match_chart(spark, sf_dir):
    return stats.match_chart(matches(logs(spark, sf_dir), SPEC, START), RULE, START)


@query(f"WITH first AS (SELECT min(epoch_us(ts) // 1000) AS s FROM events) SELECT DISTINCT strftime(make_timestamp((p - p % 10000) * 1000), '%Y-%m-%d %H:%M:%S') AS bucket FROM (SELECT s + 5000 * i AS p FROM first, range(60) r(i))")
def time_grid(spark, sf_dir):
    start = logs(spark, sf_dir).agg(F.min("timestamp")).first()[0]
    return stats.time_grid(spark, stats.PRESETS["300"], start)


@query(f"""WITH {_FOUND_SQL}, {_GRID_SQL}, {_META_SQL}, g AS (SELECT {_LABEL} AS bucket, action, count(*) AS count_user, CAST(sum(CAST(k AS BIGINT)) AS BIGINT) AS sum_k FROM f GROUP BY 1, 2),
  x AS (SELECT g.bucket, meta.gid, g.count_user, g.sum_k FROM g JOIN meta ON g.action = meta.action)
  SELECT grid.bucket, gid, count_user, sum_k FROM grid LEFT JOIN x ON x.bucket = grid.bucket""")
def group_table_long(spark, sf_dir):
    return stats.group_table(matches(logs(spark, sf_dir), SPEC, START), KEYS, STATS, RULE, START)


@query(f"""WITH {_FOUND_SQL} SELECT strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d %H:%M:%S') AS timestamp, level, location, host, seq, "user", action, k, message
  FROM f ORDER BY f.timestamp // 1000 DESC, seq DESC LIMIT 100""")
def log_table(spark, sf_dir):
    return stats.log_table(matches(logs(spark, sf_dir), SPEC, START))


@query(f"WITH {_FOUND_SQL}, {_META_SQL} SELECT * FROM meta")
def log_search_meta(spark, sf_dir):
    return log_search(logs(spark, sf_dir), SPEC, START)["meta"]


@query(f"WITH {LOGS_SQL} SELECT * FROM logs ORDER BY seq DESC LIMIT 200")
def trim_buffer(spark, sf_dir):
    return stats.trim_buffer(logs(spark, sf_dir))


@query(f"WITH {LOGS_SQL} SELECT * FROM logs ORDER BY seq LIMIT 10")
def sample_head(spark, sf_dir):
    return stats.sample_head(logs(spark, sf_dir))


@query(f"WITH {LOGS_SQL} SELECT seq, timestamp, level, location, message || chr(10) || '  at ' || host AS message FROM logs")
def parse_log_line_query(spark, sf_dir):
    when = F.concat(format_time(F.col("timestamp"), "Asia/Shanghai"), F.lit(","), F.lpad((F.col("timestamp") % 1000).cast("string"), 3, "0"))
    line = F.concat(when, F.lit(" "), F.col("level"), F.lit(" "), F.col("location"), F.lit(": "), F.col("message"), F.lit("\n  at "), F.col("host"), F.lit("\n\n"))
    return logs(spark, sf_dir).select("seq", parse_log_line(line, "Asia/Shanghai").alias("p")).select("seq", "p.*")


@query("""WITH s AS (SELECT conv_id, turn, coalesce(text, '') AS text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS event FROM conversations)
  SELECT conv_id, CAST(event AS BIGINT) AS event, min(turn) AS "offset", string_agg(text, chr(10) ORDER BY turn) AS text FROM s GROUP BY 1, 2""")
def assemble_events_query(spark, sf_dir):
    return assemble_events(_table(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.col("role") == "user", line="text").drop("piece")


@query(f"WITH {LOGS_SQL} SELECT timestamp, level, location, host, message FROM logs")
def topic_round_trip(spark, sf_dir):
    sent = topics.to_topic(logs(spark, sf_dir), "app")
    return topics.from_topic(sent.withColumn("value", F.col("value").cast("binary")))


@query(f"""WITH {LOGS_SQL} SELECT CASE WHEN level = 'ERROR' THEN 'bad' ELSE 'odd' END AS topic, seq FROM logs WHERE level IN ('ERROR', 'WARN')""")
def merge_topics(spark, sf_dir):
    rows = logs(spark, sf_dir)
    parts = [topics.to_topic(rows.where(F.col("level") == level), name, ["seq"]) for level, name in (("ERROR", "bad"), ("WARN", "odd"))]
    return topics.union_all(parts).select("topic", "seq")


@query(f"WITH {TRANSFERS_SQL} SELECT seq, CASE WHEN event_type = 'click' THEN 'block' ELSE 'trace' END AS rule FROM t WHERE event_type IN ('click', 'view', 'purchase')")
def route_transfers(spark, sf_dir):
    message = F.col("message")
    rules = [("block", message.contains("Received block"), F.struct(message)), ("trace", message.contains("HDFS_"), F.struct(message))]
    return route_first_match(transfers_log(spark, sf_dir), rules).select("seq", "rule")


@query(f"WITH {TRANSFERS_SQL} SELECT timestamp, srcip, destip, filesize, tag FROM x")
def parse_transfers(spark, sf_dir):
    return traffic.parse_transfers(transfers_log(spark, sf_dir))


def _flows(spark, sf_dir):
    return traffic.flow_totals(traffic.parse_transfers(transfers_log(spark, sf_dir)))


@query(f"WITH {TRANSFERS_SQL} SELECT * FROM flows")
def flow_totals(spark, sf_dir):
    return _flows(spark, sf_dir)


_NODES = "n AS (SELECT src AS node FROM flows UNION SELECT dest FROM flows)"


@query(f"WITH {TRANSFERS_SQL}, {_NODES} SELECT a.node AS src, b.node AS dest, coalesce(dataflow, 0) AS dataflow FROM n a CROSS JOIN n b LEFT JOIN flows f ON f.src = a.node AND f.dest = b.node")
def flow_matrix(spark, sf_dir):
    return traffic.flow_matrix(_flows(spark, sf_dir))


@query(f"WITH {TRANSFERS_SQL}, {_NODES} SELECT node, CAST(coalesce(sum(dataflow), 0) AS BIGINT) AS dataflow FROM n LEFT JOIN flows ON src = node GROUP BY node")
def node_totals(spark, sf_dir):
    return traffic.node_totals(_flows(spark, sf_dir))


@query(f"WITH {TRANSFERS_SQL}, {_NODES}, m AS (SELECT coalesce(dataflow, 0) AS d FROM n a CROSS JOIN n b LEFT JOIN flows f ON f.src = a.node AND f.dest = b.node) SELECT min(d) AS min_flow, max(d) AS max_flow FROM m")
def flow_range(spark, sf_dir):
    return traffic.flow_range(_flows(spark, sf_dir))


@query(f"""WITH {TRANSFERS_SQL} SELECT '{{"info":[' || string_agg('{{"src":"' || src || '","dest":"' || dest || '","dataflow":' || dataflow || '}}', ',' ORDER BY src, dest) || ']}}' AS json FROM flows""")
def flows_to_json(spark, sf_dir):
    return traffic.flows_to_json(_flows(spark, sf_dir))


@query(f"WITH {LOGS_SQL} SELECT seq, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d/%Y%m%dT%H%M%S.%gZ.') || location AS path, timestamp AS start_ts FROM logs")
def archive_paths(spark, sf_dir):
    rows = logs(spark, sf_dir).select("seq", archive_path(F.col("location"), F.col("timestamp")).alias("path"))
    return rows.withColumn("start_ts", path_timestamp(F.col("path")))


@query(f"WITH {LOGS_SQL} SELECT seq, strftime(make_timestamp((timestamp + 28800000 - (timestamp % 10000)) * 1000), '%Y-%m-%d %H:%M:%S') AS bucket FROM logs")
def time_buckets(spark, sf_dir):
    return logs(spark, sf_dir).select("seq", time_bucket(F.col("timestamp"), 10_000, "Asia/Shanghai").alias("bucket"))


def _messages(spark, sf_dir):
    return logs(spark, sf_dir).select(F.col("location").alias("topic"), "timestamp", F.to_json(F.struct(*topics.FIELDS)).alias("value"), "seq")


def _index(messages: DataFrame) -> DataFrame:
    """A file for the third event of each topic and day."""
    day = utc_day(F.col("timestamp"))
    third = messages.groupBy("topic", day.alias("day")).agg(F.get(F.sort_array(F.collect_set("timestamp")), F.lit(2)).alias("start_ts")).where("start_ts IS NOT NULL")
    return third.select("start_ts", "topic", "day", archive_path(F.col("topic"), F.col("start_ts")).alias("path"), F.lit(0).cast("long").alias("size"), F.col("start_ts").alias("recent_ts"))


@query(f"""WITH {LOGS_SQL}, d AS (SELECT DISTINCT location, timestamp // 86400000 AS day, timestamp FROM logs),
  i AS (SELECT location, day, list(timestamp ORDER BY timestamp)[3] AS start_ts FROM d GROUP BY 1, 2 HAVING count(*) >= 3)
  SELECT seq, start_ts FROM (SELECT *, timestamp // 86400000 AS day FROM logs) l ASOF LEFT JOIN i ON l.location = i.location AND l.day = i.day AND l.timestamp >= i.start_ts""")
def assign_existing_segment(spark, sf_dir):
    messages = _messages(spark, sf_dir)
    return segments.assign_existing_segment(messages, _index(messages)).select("seq", "start_ts")


#: A walk over the messages of each topic, one a step, with all that the roll rule knows: file starts, and size and newest time of the newest file.
_WALK_SQL = """walk AS (SELECT topic, n, seq, segment_ts, starts, size, recent FROM first UNION ALL
    SELECT topic, n, seq, CASE WHEN fresh THEN timestamp ELSE goal END, CASE WHEN fresh THEN list_append(starts, timestamp) ELSE starts END,
      CASE WHEN fresh AND timestamp > newest THEN bytes WHEN NOT fresh AND goal = newest THEN size + bytes ELSE size END,
      CASE WHEN fresh AND timestamp > newest THEN timestamp WHEN NOT fresh AND goal = newest THEN greatest(recent, timestamp) ELSE recent END
    FROM (SELECT *, goal IS NULL OR goal // 86400000 <> timestamp // 86400000 OR goal = newest AND timestamp > recent AND size > 2000 AS fresh
      FROM (SELECT m.*, w.starts, w.size, w.recent, coalesce(list_max(w.starts), -1) AS newest, list_max(list_filter(w.starts, lambda x: x <= m.timestamp)) AS goal
            FROM walk w JOIN m ON m.topic = w.topic AND m.n = w.n + 1)))"""
_JSON_SQL = """'{"timestamp":' || timestamp || ',"level":"' || level || '","location":"' || location || '","host":"' || host || '","message":"' || message || '"}'"""


@query(f"""WITH RECURSIVE {LOGS_SQL}, d AS (SELECT DISTINCT location, timestamp // 86400000 AS day, timestamp FROM logs),
  i AS (SELECT location, day, list(timestamp ORDER BY timestamp)[3] AS start_ts FROM d GROUP BY 1, 2 HAVING count(*) >= 3),
  m AS (SELECT location AS topic, timestamp, seq, strlen({_JSON_SQL}) AS bytes, row_number() OVER (PARTITION BY location ORDER BY seq) AS n FROM logs),
  first AS (SELECT topic, CAST(0 AS BIGINT) AS n, CAST(-1 AS BIGINT) AS seq, CAST(NULL AS BIGINT) AS segment_ts, starts, CAST(0 AS BIGINT) AS size, list_max(starts) AS recent
            FROM (SELECT l.topic, coalesce(list(start_ts) FILTER (start_ts IS NOT NULL), []) AS starts FROM (SELECT DISTINCT topic FROM m) l LEFT JOIN i ON i.location = l.topic GROUP BY 1)),
  {_WALK_SQL} SELECT seq, topic, segment_ts FROM walk WHERE n > 0""")
def assign_segments(spark, sf_dir):
    """With files that are there already."""
    messages = _messages(spark, sf_dir)
    return segments.assign_segments(messages, 2_000, _index(messages)).select("seq", "topic", "segment_ts")


@query(f"""WITH RECURSIVE {LOGS_SQL}, m AS (SELECT location AS topic, timestamp, seq, strlen({_JSON_SQL}) AS bytes,
    row_number() OVER (PARTITION BY location ORDER BY (seq + seq * 37 % 50) * 100 + seq % 100) AS n FROM logs),
  first AS (SELECT DISTINCT topic, CAST(0 AS BIGINT) AS n, CAST(-1 AS BIGINT) AS seq, CAST(NULL AS BIGINT) AS segment_ts, CAST([] AS BIGINT[]) AS starts, CAST(0 AS BIGINT) AS size, CAST(NULL AS BIGINT) AS recent FROM m),
  {_WALK_SQL} SELECT seq, topic, segment_ts FROM walk WHERE n > 0""")
def assign_segments_late(spark, sf_dir):
    """From nothing, with messages that come up to fifty places late."""
    seq = F.col("seq")
    messages = _messages(spark, sf_dir).withColumn("arrival", (seq + seq * 37 % 50) * 100 + seq % 100)
    return segments.assign_segments(messages, 2_000, order="arrival").select("seq", "topic", "segment_ts")


@query(f"""WITH {LOGS_SQL} SELECT location AS topic, timestamp // 86400000 * 86400000 AS segment_ts, count(*) AS messages, CAST(sum(strlen(message)) AS BIGINT) AS bytes FROM logs GROUP BY 1, 2""")
def segment_sizes(spark, sf_dir):
    rows = logs(spark, sf_dir).select(F.col("location").alias("topic"), (F.col("timestamp") - F.col("timestamp") % 86_400_000).alias("segment_ts"), F.col("message").alias("value"))
    return segments.segment_sizes(rows)


@query("""SELECT 'web' AS topic, url || '#' || page_id AS first_line, 'new/' || url || '#' || page_id AS path, CAST(strlen(html) AS BIGINT) AS size,
  CASE page_id % 4 WHEN 0 THEN 'new' WHEN 1 THEN 'grown' WHEN 2 THEN 'unchanged' ELSE 'shrunk' END AS status,
  CASE page_id % 4 WHEN 0 THEN 0 WHEN 1 THEN CAST(strlen(html) AS BIGINT) - 1 END AS read_from
  FROM pages""")
def diff_manifest(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    size, name = F.octet_length("html").cast("long"), F.concat("url", F.lit("#"), "page_id")
    make = lambda prefix, grown: [F.lit("web").alias("topic"), name.alias("first_line"), F.concat(F.lit(prefix), name).alias("path"), (size + grown).alias("size")]
    kind = F.col("page_id") % 4
    old = pages.where(kind > 0).select(*make("old/", F.when(kind == 1, -1).when(kind == 3, 1).otherwise(0)))
    return files.diff_manifest(old, pages.select(*make("new/", F.lit(0))))


@query("""WITH f AS (SELECT split_part(text, chr(10), 1) AS first_line, CAST(doc_id AS VARCHAR) AS path FROM documents)
  SELECT first_line, string_agg(path, ',' ORDER BY path) AS paths FROM f GROUP BY 1 HAVING count(*) > 1""")
def duplicate_files(spark, sf_dir):
    firsts = _table(spark, sf_dir, "documents").select(F.substring_index("text", "\n", 1).alias("first_line"), F.col("doc_id").cast("string").alias("path"))
    return files.duplicate_files(firsts).select("first_line", F.array_join("paths", ",").alias("paths"))


@query("SELECT CAST(l_orderkey AS VARCHAR) AS jobid, l_returnflag AS task_type, l_linestatus AS state, count(*) AS tasks FROM lineitem GROUP BY 1, 2, 3")
def task_state_counts(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("jobid"), F.col("l_returnflag").alias("task_type"), F.col("l_linestatus").alias("state"))
    return jobs.task_state_counts(rows)


def _renamed(a: str, b: str) -> None:
    for known in (QUERIES, SQL):
        known[b] = known.pop(a)


for _a in ("extract_fields_query", "parse_log_line_query", "assemble_events_query"):
    _renamed(_a, _a.removesuffix("_query"))
