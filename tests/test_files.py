import pytest
from pyspark.sql import functions as F

from sparklogs.operators.events import assemble_events, parse_log_events
from sparklogs.sources import files
from sparklogs.sources.files import TopicSpec, build_manifest, collect_topics, diff_manifest, discover_files, load_manifest, read_lines, save_manifest
from sparklogs.streaming.jobs import run_collector

TZ = "Asia/Shanghai"


def put(base, **content):
    for name, text in content.items():
        path = base / name.replace("__", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def names(df):
    return [r.path.rsplit("/", 1)[1] for r in df.orderBy("file_ord").collect()]


def test_daily_and_numeric_order(spark, tmp_path):
    for f in ("svc.log.2022-11-30", "svc.log.2022-02-28", "svc.log", "old/svc.log", "k=v/svc.log", "q.log.3", "q.log.1", "q.log", "q.log.12"):
        (tmp_path / f).parent.mkdir(exist_ok=True)
        (tmp_path / f).write_text("x")
    assert names(discover_files(spark, str(tmp_path), "svc[.]log.*")) == ["svc.log.2022-02-28", "svc.log.2022-11-30", "svc.log"]
    assert names(discover_files(spark, str(tmp_path), "^q[.]log", "numeric")) == ["q.log.12", "q.log.3", "q.log.1", "q.log"]
    assert names(discover_files(spark, str(tmp_path), "^q[.]log", lambda p: [p.desc()])) == ["q.log.3", "q.log.12", "q.log.1", "q.log"]
    with pytest.raises(Exception, match="not a rolling file"):
        discover_files(spark, str(tmp_path), "svc", "numeric").collect()


def test_offsets_do_not_depend_on_splits(spark, tmp_path, monkeypatch):
    text = "".join(f"line {i} é\r\n" if i % 3 == 0 else f"{i}\n" for i in range(500)) + "last"
    (tmp_path / "a b+c").write_bytes(text.encode())
    expected, at = [], 0
    for line in text.split("\n"):
        expected.append((at, line))
        at += len(line.encode()) + 1
    for split, block in ((1 << 27, 1 << 20), (97, 30), (1, 7), (40, 1000)):
        monkeypatch.setattr(files, "SPLIT_BYTES", split)
        monkeypatch.setattr(files, "BLOCK_BYTES", block)
        got = [(r.offset, r.line) for r in read_lines(spark, [str(tmp_path / "a b+c")]).orderBy("offset").collect()]
        assert got == expected
    assert read_lines(spark, []).count() == 0


def manifest(spark, base):
    found = build_manifest(spark, discover_files(spark, str(base), "."), "t")
    return spark.createDataFrame(found.collect(), files.MANIFEST)  # as of now


@pytest.mark.parametrize(
    ("before", "after", "expected"),
    [
        ({}, {"now": "head"}, [("now", "new", 0)]),
        ({}, {"now": ""}, []),
        ({"now": "head"}, {"now": "head"}, [("now", "unchanged", None)]),
        ({"now": "head\n"}, {"now": "head\ntail\n"}, [("now", "grown", 5)]),
        ({"now": "head\n"}, {"now": "next\n", "past": "head\n"}, [("now", "new", 0), ("past", "unchanged", None)]),
        ({"now": "head\nmore"}, {"now": "head\n"}, [("now", "shrunk", None)]),
    ],
)
def test_manifest_diff(spark, tmp_path, before, after, expected):
    put(tmp_path, **before)
    old = manifest(spark, tmp_path) if before else load_manifest(spark, str(tmp_path / "none"))
    put(tmp_path, **after)
    found = diff_manifest(old, manifest(spark, tmp_path))
    assert sorted((r.path.rsplit("/", 1)[1], r.status, r.read_from) for r in found.collect()) == expected


def test_manifest_versions(spark, tmp_path):
    folder = str(tmp_path / "m")
    assert load_manifest(spark, folder).count() == 0
    for size in (1, 2):
        save_manifest(spark.createDataFrame([("t", "l", "p", size, None)], files.MANIFEST), folder)
    assert load_manifest(spark, folder).first().size == 2


def test_duplicates(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "first_line string, path string")
    assert [tuple(r) for r in files.duplicate_files(df).collect()] == [("a", ["1", "2"])]


def messages(spark, folder):
    return [r.m for r in spark.read.parquet(folder).select(F.get_json_object("value", "$.message").alias("m"), "file_ord", "offset").orderBy("file_ord", "offset").collect()]


def test_collector_sends_only_what_is_new(spark, tmp_path):
    base, out, state = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "state")
    base.mkdir()
    for d, name in enumerate(("gate.log.2022-01-07", "gate.log.2022-01-08", "gate.log"), 7):
        (base / name).write_text(f"2022-01-0{d} 12:00:00,000 WARN door.Lock: opened {d}")
    topics = {"doors": TopicSpec(str(base), "^gate[.]log.*")}
    run_collector(spark, topics, state, "h", TZ, folder=out)
    assert messages(spark, out) == ["opened 7", "opened 8", "opened 9"]
    with (base / "gate.log").open("a") as file:
        file.write("\n2022-01-09 12:00:01,000 WARN door.Lock: shut\n  by hand")
    events, _ = collect_topics(spark, topics, load_manifest(spark, state), "h", TZ)
    assert [(r.message, r.timestamp) for r in events.collect()] == [("shut\n  by hand", 1641700801000)]


def test_lines_from_an_offset(spark, tmp_path, monkeypatch):
    text = "".join(f"line {i}\n" for i in range(400))
    (tmp_path / "f").write_text(text)
    monkeypatch.setattr(files, "SPLIT_BYTES", 97)
    path = str(tmp_path / "f")
    whole = [(r.offset, r.line) for r in read_lines(spark, [path]).orderBy("offset").collect()]
    for start in (0, 1, 97, 98, 1000, len(text) - 9, len(text)):
        got = read_lines(spark, [path], spark.createDataFrame([(path, start)], "path string, read_from long")).orderBy("offset").collect()
        assert [(r.offset, r.line) for r in got] == [w for w in whole if w[0] >= start]


def test_only_new_bytes_are_read(spark, tmp_path):
    """Of unchanged files nothing, of renamed ones the first line, of grown ones the first line and what is new."""
    line = "2022-01-07 12:00:00,000 WARN door.Lock: opened {:09d}\n"
    for name, first in (("a.log.2022-01-05", 0), ("a.log.2022-01-06", 100_000), ("a.log", 200_000)):
        (tmp_path / name).write_text("".join(line.format(first + i) for i in range(60_000)))
    specs = {"doors": TopicSpec(str(tmp_path), "^a[.]log")}
    meter = spark.sparkContext.accumulator(0)
    events, old = collect_topics(spark, specs, load_manifest(spark, str(tmp_path / "none")), meter=meter)
    old = spark.createDataFrame(old.collect(), files.MANIFEST)
    assert events.count() == 180_000
    whole = sum(p.stat().st_size for p in tmp_path.iterdir())
    assert whole <= meter.value <= 2 * whole + 3 * files.BLOCK_BYTES  # lines are counted, then read
    (tmp_path / "a.log.2022-01-06").rename(tmp_path / "a.log.2022-01-04")
    with (tmp_path / "a.log").open("a") as file:
        file.write(line.format(7))
    meter.value = 0
    events, now = collect_topics(spark, specs, old, meter=meter)
    assert [r.message for r in events.collect()] == ["opened 000000007"]
    assert 0 < meter.value <= 2 * files.BLOCK_BYTES + 4 * len(line.format(0))
    meter.value = 0
    events, same = collect_topics(spark, specs, now, meter=meter)
    assert events.count() == 0 and meter.value == 0
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, now.collect()))


def test_several_topics_are_one_plan(spark, tmp_path):
    """Two orders, two parsers, two topics in one folder and one in another."""
    for name, lines in {"x/a.log.2": "old 1", "x/a.log.1": "mid 2", "x/a.log": "new 3\nmore", "x/b.log": "2022-01-07 12:00:00,000 INFO b: hello", "y/b.log.1": "2022-01-07 12:00:01,000 INFO b: other"}.items():
        put(tmp_path, **{name: lines})

    def own(c):
        number = F.regexp_extract(c, "^[a-z]+ ([0-9]+)", 1).try_cast("long")
        return F.when(number.isNotNull(), F.struct(number.alias("timestamp"), F.lit("INFO").alias("level"), F.lit("own").alias("location"), c.alias("message")))

    specs = {"a": TopicSpec(str(tmp_path / "x"), "^a[.]log", "numeric", own), "b": TopicSpec(str(tmp_path / "x"), "^b[.]log"), "c": TopicSpec(str(tmp_path / "y"), "^b[.]log", "numeric"), "twice": TopicSpec(str(tmp_path / "x"), "^b")}
    events, now = collect_topics(spark, specs, load_manifest(spark, str(tmp_path / "none")), "h")
    got = sorted((r.topic, r.file_ord, r.offset, r.message) for r in events.collect())
    assert got == [("a", 1, 0, "old 1"), ("a", 2, 0, "mid 2"), ("a", 3, 0, "new 3\nmore"), ("b", 1, 0, "hello"), ("c", 1, 0, "other"), ("twice", 1, 0, "hello")]
    assert now.count() == 6


def test_events_of_files_take_many_tasks_and_no_line_is_sent_to_all(spark, tmp_path):
    for k in range(6):
        (tmp_path / f"app.log.{k}").write_text("".join(f"2024-01-0{k + 1} 06:30:00,000 INFO a.b: m{i}\n  at x\n" for i in range(50)))
    paths = [str(tmp_path / f"app.log.{k}") for k in range(6)]
    lines = read_lines(spark, paths)
    assert lines.select(F.spark_partition_id()).distinct().count() > 1
    assert files.first_lines(files._listed(spark, paths)).select(F.spark_partition_id()).distinct().count() > 1
    events = parse_log_events(lines, F.lit("box"))
    kept = events.toDF(*events.columns)
    assert len(kept.collect()) == 300
    assert "BroadcastExchange" not in kept._jdf.queryExecution().executedPlan().toString()


def test_numbers_of_null_keys_and_chunks(spark):
    rows = spark.createDataFrame([(None, 0, "+"), (None, 1, "a"), (None, 70000, "+"), ("x", 0, "b"), ("x", 90000, "+")], "file string, offset long, line string")
    got = assemble_events(rows, ["file"], "offset", F.col("line") == "+").select("file", "event", "offset", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1, 0, "+\na"), (None, 2, 70000, "+"), ("x", 0, 0, "b"), ("x", 1, 90000, "+")], key=str)


def test_no_regex_over_the_path_of_each_line(spark, tmp_path):
    put(tmp_path, app__log="2024-01-01 06:30:00,000 INFO a.b: m\n")
    events, _ = collect_topics(spark, {"t": TopicSpec(str(tmp_path), "^app[.]log")}, load_manifest(spark, str(tmp_path / "none")), "box")
    assert events.count() == 1
    assert "([^/]*)$" not in events._jdf.queryExecution().optimizedPlan().toString()
