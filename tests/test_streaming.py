import random

import pytest
from pyspark.sql import functions as F

from sparklogs.operators.extract import extract_fields
from sparklogs.operators.filters import drop_incomplete, keyword_filter
from sparklogs.operators.stats import PRESETS, Stat
from sparklogs.plans.search import SearchSpec, log_search
from sparklogs.shared import children
from sparklogs.sources.topics import from_topic, read_topics, to_topic, union_all, write_topic
from sparklogs.streaming import jobs
from sparklogs.streaming.jobs import stream_flow_totals, stream_group_stats, stream_late_split, stream_search

NOW = 1_700_000_040_000


def logs(spark, rows):
    return spark.createDataFrame(rows, "timestamp long, message string").select("timestamp", F.lit("INFO").alias("level"), F.lit("l").alias("location"), F.lit("h").alias("host"), "message")


def run(df, tmp_path, name):
    query = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    query.awaitTermination(120)


def test_topics_round_trip(spark, tmp_path):
    folder = str(tmp_path / "t")
    for topic in ("a", "b", "c"):
        write_topic(to_topic(logs(spark, [(1, f"m\n{topic}")]), topic), folder=folder)
    run(read_topics(spark, ["a", "b"], folder=folder, max_per_batch=1), tmp_path, "round")
    found = from_topic(spark.table("round"), ["topic"]).orderBy("topic").collect()
    assert [(r.topic, r.message) for r in found] == [("a", "m\na"), ("b", "m\nb")]
    assert from_topic(spark.createDataFrame([("{broken",)], "value string")).first().message is None


def test_search_and_series(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = [(NOW - 30_000 + 1000 * i, f"got k={i % 2} end") for i in range(10)] + [(NOW - 500_000, "got k=9 end")]
    write_topic(to_topic(logs(spark, rows), "a"), folder=folder)
    stream = read_topics(spark, ["a"], folder=folder)
    spec = SearchSpec("got", PRESETS["60"], [("k=* end", "k")], ["k"], [Stat("count", "k")])
    stream_search(stream, spec, str(tmp_path / "out"), str(tmp_path / "c"), trigger={"availableNow": True}, now_ms=lambda: NOW).awaitTermination(120)
    meta = spark.read.parquet(f"{tmp_path}/out/meta").orderBy("gid").collect()
    assert [(r.k, r.count_k, r.query_time) for r in meta] == [("0", 5, NOW), ("1", 5, NOW)]
    run(stream_group_stats(from_topic(stream), ["level"], [Stat("count", "n")], "5 seconds", "0 seconds"), tmp_path, "series")
    total = spark.table("series").agg(F.sum("count_n")).first()[0]
    assert 0 < total <= 11


def test_search_over_batches_and_cut_minutes(spark, tmp_path):
    """The tables of each batch against the search over all rows so far; a batch runs again, windows begin and end inside minutes."""
    rng = random.Random(4)
    spec = SearchSpec("got", PRESETS["300"], [("k=* end", "k"), ("v=* end", "v")], ["k"], [Stat("count", "k"), Stat("sum", "v")])
    rows = [(i, NOW - 700_000 + 4_000 * i + rng.randrange(-90_000, 90_000), f"got k={rng.randrange(3)} end v={rng.randrange(50)} end" if i % 7 else "none") for i in range(240)]
    batches = []

    class Writer:
        def foreachBatch(self, function):
            batches.append(function)
            return self

        def __getattr__(self, name):
            return lambda *a, **k: self

    clock = [0]
    out = str(tmp_path / "s")
    frames = {n: spark.createDataFrame(rows[80 * n : 80 * n + 80], "seq long, timestamp long, message string").selectExpr("timestamp", "'INFO' AS level", "'l' AS location", "'h' AS host", "message", "seq") for n in range(3)}

    class Stream:
        columns = ["topic", "offset", "value"]

    def matching(df):
        return drop_incomplete(extract_fields(keyword_filter(df, "got"), spec.extracts))

    class Found:
        writeStream = Writer()

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(jobs, "from_topic", lambda *a: None)
        patch.setattr(jobs, "search_filter", lambda *a: None)
        patch.setattr(jobs, "keyword_match", lambda *a: None)
        patch.setattr(jobs, "extract_fields", lambda *a: None)
        patch.setattr(jobs, "drop_incomplete", lambda *a: Found())
        stream_search(Stream(), spec, out, "state", now_ms=lambda: clock[0], limit=20)
    seen = []
    for n, now in ((0, NOW - 400_017), (1, NOW - 100_000), (1, NOW - 100_000), (2, NOW + 60_001)):
        clock[0] = now
        batches[0](matching(frames[n]).withColumnRenamed("seq", "offset"), n)
        seen += [n] * (n not in seen)
        want = log_search(union_all([frames[k] for k in seen]), spec, now - 300_000, limit=20)
        for name, table in want.items():
            got = spark.read.parquet(f"{out}/{name}/query_time={now}").select(*[f"`{c}`" for c in table.columns])
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, table.collect()), key=repr), (n, name)
    assert children(spark, f"{out}/_rows") == children(spark, f"{out}/_panes") and "batch=0" not in children(spark, f"{out}/_rows")
    with pytest.raises(ValueError, match="add up"):
        stream_search(Stream(), SearchSpec("got", PRESETS["60"], [], ["k"], [Stat(F.max, "k", "top")]), out, "state")


def test_a_folder_has_no_start(spark, tmp_path):
    with pytest.raises(ValueError, match="no start"):
        read_topics(spark, ["a"], folder=str(tmp_path), starting="latest")


def test_flows(spark, tmp_path):
    folder = str(tmp_path / "t")
    line = "src: /10.0.0.1:1, dest: /10.0.0.2:2, bytes: 5, op: HDFS_READ, x"
    write_topic(to_topic(logs(spark, [(NOW, line), (NOW + 1, line), (NOW + 90_000, line)]), "a"), folder=folder)
    flows = stream_flow_totals(from_topic(read_topics(spark, ["a"], folder=folder)), delay="1 seconds", now=F.lit(NOW + 90_000))
    run(flows, tmp_path, "flows")
    rows = spark.table("flows").where(f"window_start <= {NOW} AND window_end > {NOW + 1}").collect()
    assert rows and all((r.src, r.dest, r.dataflow) == ("10.0.0.1", "10.0.0.2", 10) for r in rows)


def test_late_rows_are_told(spark, tmp_path):
    """Three batches of two topics; a batch that runs again decides as it did."""
    times = [("a", 100), ("a", 40), ("b", 10), ("b", 500), ("a", 89), ("a", 90), ("a", None), ("b", 489), ("b", 600), ("a", 95), ("a", 300), ("b", 590), ("c", 0)]
    rows = [(t, i, f'{{"timestamp":{ts},"message":"m"}}' if ts is not None else "{broken") for i, (t, ts) in enumerate(times)]
    frames = [spark.createDataFrame(rows[i : i + 4], "topic string, offset long, value string") for i in (0, 4, 8)] + [spark.createDataFrame(rows[12:], "topic string, offset long, value string")]
    batches = []

    class Writer:
        def foreachBatch(self, function):
            batches.append(function)
            return self

        def __getattr__(self, name):
            return lambda *a, **k: self

    class Stream:
        writeStream = Writer()

    out = str(tmp_path / "late")
    stream_late_split(Stream(), out, "state", 10)
    for n in (0, 1, 1, 2, 1, 2, 3):
        batches[0](frames[n], n)
    newest, want = {}, {}
    for n in range(4):
        part = times[4 * n : 4 * n + 4]
        for k, (t, ts) in enumerate(part):
            if ts is not None:
                want[4 * n + k] = ts < newest.get(t, ts) - 10
        for t, ts in part:
            newest[t] = max(newest.get(t, ts or 0), ts or 0)
    got = {r.offset: late for name, late in (("late", True), ("in_time", False)) for r in spark.read.parquet(f"{out}/{name}").collect()}
    assert got == want and sum(got.values()) == 2
