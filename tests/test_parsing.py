from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sparklogs.functions.parsing import extract_field, parse_log_line, template_regex
from sparklogs.functions.times import archive_path, format_time, parse_time, path_timestamp, time_bucket
from sparklogs.operators.events import assemble_events, parse_log_events
from sparklogs.operators.extract import extract_fields, route_first_match

TZ = "Asia/Shanghai"


def lines(spark, text, size=1):
    rows, at = [], 0
    for line in text.split("\n"):
        rows.append(("f", at, line))
        at += len(line.encode()) + 1
    return spark.createDataFrame(rows, "file string, offset long, line string").repartition(size)


def events(spark, text, chunk=None):
    found = parse_log_events(lines(spark, text, 3), tz=TZ, chunk=chunk).orderBy("offset").collect()
    return [(r.timestamp, r.level, r.location, r.message) for r in found]


def ms(*parts):
    """Epoch ms of a time in TZ; the last part is milliseconds."""
    return int(datetime(*parts[:-1], tzinfo=timezone(timedelta(hours=8))).timestamp()) * 1000 + parts[-1]


ONE = "2021-03-04 05:06:07,089 INFO store.Cache: evicted 3 pages"
TWO = "2021-03-04 05:06:08,500 INFO store.Cache: plan\n  step 1\n  step 2"
AT1, AT2 = ms(2021, 3, 4, 5, 6, 7, 89), ms(2021, 3, 4, 5, 6, 8, 500)
PLAN = "plan\n  step 1\n  step 2"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2021-03-04 05:06:07,089 FATAL main: out of disk", [(AT1, "out of disk")]),
        (f"{ONE}\n{TWO}", [(AT1, "evicted 3 pages"), (AT2, PLAN)]),
        (f"{TWO}\n{ONE}", [(AT2, PLAN), (AT1, "evicted 3 pages")]),
        (f"{ONE}\n\n", [(AT1, "evicted 3 pages")]),
        (f"tail of an older file\n{ONE}\n\tat store.Cache.evict\n\t\tat main\n", [(AT1, "evicted 3 pages\n\tat store.Cache.evict\n\t\tat main")]),
        ("prose alone", []),
        ("", []),
        ("2021-02-30 05:06:07,089 INFO a: no such day", []),
        ("2021-03-04 05:06:07,089 INFO goes on\nuntil: there", [(AT1, "there")]),
    ],
)
def test_events(spark, text, expected):
    assert [(t, m) for t, _, _, m in events(spark, text)] == expected
    assert [(t, m) for t, _, _, m in events(spark, text, F.floor(F.col("offset") / 20))] == expected  # files cut into many parts


def test_custom_parser(spark):
    parser = lambda c: F.when(c.rlike("^[0-9]"), F.struct(F.substring(c, 1, 1).cast("long").alias("timestamp"), F.lit("A").alias("level"), F.lit("L").alias("location"), F.substring(c, 2, 9).alias("message")))
    found = parse_log_events(lines(spark, "1a\n2b\nmore"), F.lit("h"), parser).orderBy("offset").collect()
    assert [(r.timestamp, r.host, r.message) for r in found] == [(1, "h", "a"), (2, "h", "b\nmore")]


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


def test_times(spark):
    for zone in ("UTC", "America/New_York"):  # the session's zone has no part in it
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert one(spark, parse_time(F.lit("2021-03-04 05:06:07,089"), TZ)) == AT1
            assert one(spark, format_time(F.lit(AT1), TZ)) == "2021-03-04 05:06:07"
            assert one(spark, time_bucket(F.lit(AT1), 5000, TZ)) == "2021-03-04 05:06:05"
            assert one(spark, archive_path(F.lit("gate"), F.lit(AT1))) == "2021-03-03/20210303T210607.089Z.gate"
            assert one(spark, path_timestamp(F.lit("/x/1961-04-12/19610412T060700.250Z.gate"))) == -275248379750
            assert one(spark, archive_path(F.lit("gate"), F.lit(-275248379750))) == "1961-04-12/19610412T060700.250Z.gate"
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one(spark, path_timestamp(F.lit("/x/other"))) is None
    assert one(spark, parse_log_line(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    ("template", "message", "expected"),
    [
        ("took * ms", "query took 412 ms in all", "412"),
        ("shard *", "moved shard s-17 away", "s-17"),
        ("a*b*c", "xa1b2cz", "1b2"),
        ("k=* end", "k= end", ""),
        ("k=* end", "j=1 end", None),
        ("word", "a word here", ""),
        ("word", "nothing", None),
        ("*x", "abx", "ab"),
    ],
)
def test_extract_field(spark, template, message, expected):
    assert one(spark, extract_field(F.lit(message), template)) == expected


def test_extract_literal_and_later_rule_wins(spark):
    df = spark.createDataFrame([("a.b(1)",)], "message string")
    assert extract_fields(df, [("b(*)", "n")], literal=True).first().n == "1"
    assert extract_fields(df, [("a*b", "n"), ("n", lambda m: F.upper(m))]).first().n == "A.B(1)"
    assert template_regex("plain") is None


def test_route_takes_the_first_rule(spark):
    df = spark.createDataFrame([(1, "xy"), (2, "y"), (3, "z"), (4, None)], "i int, message string")
    m = F.col("message")
    rules = [("x", m.contains("x"), F.struct(m)), ("y", m.contains("y"), F.struct(m))]
    assert [tuple(r) for r in route_first_match(df, rules).select("i", "rule").orderBy("i").collect()] == [(1, "x"), (2, "y")]
    assert route_first_match(df, []).count() == 0


def test_events_in_pieces(spark):
    """A file without a header is many rows; a long event with one is an error that names the file."""
    lines = [("none", 10 * i, f"text {i}") for i in range(40)]
    lines += [("some", 0, "before"), ("some", 10, "2021-03-04 05:06:07,089 INFO a: one"), ("some", 60, "more"), ("some", 75, "x"), ("some", 80, "2021-03-04 05:06:07,089 INFO a: two")]
    df = spark.createDataFrame(lines, "file string, offset long, line string")
    starts = F.col("line").startswith("2021")
    got = sorted((r.file, r.event, r.piece, r.offset, r.text) for r in assemble_events(df, ["file"], "offset", starts, F.floor(F.col("offset") / 30), piece=65).collect())
    pieces = {}
    for f, o, line in lines[:40]:
        pieces.setdefault((f, 0, o // 65), []).append((o, line))
    want = [(*k, v[0][0], "\n".join(line for _, line in v)) for k, v in pieces.items()]
    want += [("some", 0, 0, 0, "before"), ("some", 1, 0, 10, lines[41][2] + "\nmore"), ("some", 1, 1, 75, "x"), ("some", 2, 0, 80, lines[44][2])]
    assert got == sorted(want)
    whole = parse_log_events(df, piece=66)
    assert sorted(r.message for r in whole.collect()) == ["one\nmore\nx", "two"]
    with pytest.raises(Exception, match="more than 65 bytes in some"):
        parse_log_events(df, piece=65).collect()
