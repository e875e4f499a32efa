import pytest
from pyspark.sql import functions as F

from sparklogs.operators import filters, stats
from sparklogs.operators.stats import PRESETS, Stat, TimeRule
from sparklogs.plans.search import SearchSpec, kept_search, log_search

TZ, START = "Asia/Shanghai", 1_650_000_004_000
TIMES = [START + late for late in (150, 12_000, 23_000, 31_000)]


@pytest.fixture(scope="module")
def logs(spark):
    rows = [(t, "INFO", "l", "h", f"job took 01{i + 1} ms on shard s-7 now", i) for i, t in enumerate(TIMES)]
    return spark.createDataFrame(rows, "timestamp long, level string, location string, host string, message string, seq long")


def spec(keyword="", keys=("p1", "p2"), fn="sum"):
    return SearchSpec(keyword, PRESETS["60"], [("took * ms", "p1"), ("shard * now", "p2")], list(keys), [Stat(fn, "p1")])


def test_search(logs):
    out = log_search(logs, spec(keys=("p2",)), START, TZ)
    assert [tuple(r) for r in out["meta"].collect()] == [(0, "s-7", 50)]
    chart = {r.bucket: r.search_count for r in out["matchchart"].collect()}
    assert len(chart) == 12
    assert sum(chart.values()) == 4
    assert chart["2022-04-15 13:20:00"] == 1
    grid = [r.bucket for r in out["grouptable"].collect()]
    assert grid == sorted(grid)
    table = out["logtable"].collect()
    assert [r.p1 for r in table] == ["014", "013", "012", "011"]
    assert out["logtable"].columns == ["timestamp", "level", "location", "host", "seq", "p1", "p2", "message"]
    assert {r.bucket: r.sum_p1 for r in out["grouptable"].collect() if r.gid is not None}["2022-04-15 13:20:00"] == 11


def test_keyword_and_groups(logs):
    out = log_search(logs, spec(" 013 ", fn="count"), START, TZ)
    assert [tuple(r) for r in out["meta"].collect()] == [(0, "013", "s-7", 1)]
    nested = stats.group_table(filters.keyword_filter(logs, "").withColumn("k", F.lit("a")), ["k"], [Stat("count", "k")], PRESETS["60"], START, TZ, nested=True)
    assert nested.where("size(events) = 1").count() == 4


def test_kept_search_lets_go(spark, logs):
    found = {name: table.count() for name, table in log_search(logs, spec(), now_ms=lambda: START + 60_000).items()}
    with kept_search(logs, spec(), START) as tables:
        assert {name: table.count() for name, table in tables.items()} == found
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_group_numbers_follow_the_order_of_keys(spark):
    rows = [(f"{c}{i % 7}", i % 3 if i % 4 else None) for i in range(60) for c in ("a", "ab", "b", "é")] + [(None, 1)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(5)
    meta = stats.group_meta(df, ["k", "n"], [Stat("count", "k")]).orderBy("gid").collect()
    keys = [(r.k, r.n) for r in meta]
    assert [r.gid for r in meta] == list(range(len(set(rows))))
    assert keys == sorted(set(rows), key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1] is not None, x[1] or 0))
    numbers = stats.group_meta(df.where("n IS NOT NULL"), ["n"], [Stat("count", "k")]).orderBy("gid").collect()
    assert [(r.gid, r.n) for r in numbers] == [(0, 0), (1, 1), (2, 2)]


def test_rows_after_the_grid_are_in_no_bucket(spark):
    rows = [(START + 59_999,), (START,), (START + 60_000,), (None,)]
    df = spark.createDataFrame(rows, "timestamp long").withColumn("message", F.lit("m")).withColumn("seq", F.lit(1))
    out = log_search(df, SearchSpec("m", PRESETS["60"], [], [], [Stat("count", "m")]), START)
    assert out["logtable"].count() == 1  # strict bounds
    assert sum(r.search_count for r in out["matchchart"].collect()) == 0
    assert out["meta"].count() == 0


@pytest.mark.parametrize(("preset", "late", "n"), [("60", 0, 12), ("300", 0, 30), ("300", 6000, 31)])
def test_grid(spark, preset, late, n):
    assert stats.time_grid(spark, PRESETS[preset], START - 4000 + late).count() == n


def test_filters(spark):
    df = spark.createDataFrame([(1, "ERROR Disk"), (2, None), (3, "Received block x"), (4, "clienttrace")], "timestamp long, message string")
    assert [r.timestamp for r in filters.keyword_filter(df, " error ").collect()] == [1]
    assert filters.keyword_filter(df, " ").count() == 4
    assert filters.search_filter(df, []).count() == 4
    assert [r.timestamp for r in filters.drop_noise(df).orderBy("timestamp").collect()] == [1, 2]
    assert [r.timestamp for r in filters.recent(df, 3, 2, 1).collect()] == [2, 3]
    assert filters.drop_incomplete(df).count() == 3


def test_stats_errors_and_numbers(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "x"), ("b", "08"), (None, "2")], "k string, v string")
    found = {r.k: (r.sum_v, r.count_v) for r in stats.group_stats(df, ["k"], [Stat("SUM", "v"), Stat("count", "v")]).collect()}
    assert found == {"a": (1, 2), "b": (8, 1), None: (2, 1)}
    with pytest.raises(ValueError):
        stats.group_stats(df, ["none"], [])
    with pytest.raises(ValueError):
        stats.group_stats(df, ["k"], [Stat("median", "v")])
    assert stats.group_stats(df, ["k"], [Stat(F.max, "v")]).columns == ["k", "max_v"]


@pytest.mark.parametrize(("n", "kept"), [(0, 0), (499, 499), (500, 200), (900, 200)])
def test_trim_buffer(spark, n, kept):
    df = spark.range(n).withColumnRenamed("id", "seq")
    rows = stats.trim_buffer(df).collect()
    assert len(rows) == kept
    assert not rows or max(r.seq for r in rows) == n - 1


def test_log_table_orders_by_second_then_arrival(spark):
    df = spark.createDataFrame([(1999, "a", 1), (1001, "b", 2), (2000, "c", 0)], "timestamp long, message string, seq long")
    assert [r.message for r in stats.log_table(df).collect()] == ["c", "b", "a"]
    assert stats.match_chart(df, TimeRule(5000, 5000), 0).first().search_count == 3
