"""The log of messages: batches that count messages, starts, restarts, several topics."""

import pytest
from pyspark.sql import functions as F

from sparklogs.shared import children, put_new
from sparklogs.sources.messages import _Reader, publish, read_messages


def frame(spark, topic, numbers):
    return spark.createDataFrame([(topic, f"m{i}", i) for i in numbers], "topic string, value string, n long").repartition(3)


def run(stream, folder, until=None):
    """Batches (topic, offset, value) of a stream until its source is read; `until` runs after the start."""

    def keep(df, number):
        df.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/{number}")

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/state").start()
    try:
        query.processAllAvailable()
        if until:
            until()
            query.processAllAvailable()
    finally:
        query.stop()
        query.awaitTermination(60)
    spark = stream.sparkSession
    found = [spark.read.parquet(f"{folder}/out/{n}") for n in children(spark, f"{folder}/out")]
    return sorted((r.batch, r.offset, r.topic, r.value) for df in found for r in df.collect())


def test_batches_count_messages(spark, tmp_path):
    log = str(tmp_path / "log")
    assert publish(frame(spark, "a", range(25)), log, ["n"], per_file=4) == 25
    assert publish(frame(spark, "b", range(7)), log, ["n"]) == 7
    assert publish(frame(spark, "a", []), log) == 0
    assert publish(frame(spark, "a", range(25, 30)), log, ["n"]) == 5
    got = run(read_messages(spark, log, ["a"], str(tmp_path / "p1"), "earliest", 10), str(tmp_path / "one"))
    assert got == [(i // 10, i, "a", f"m{i}") for i in range(30)]
    both = run(read_messages(spark, log, ["a", "b"], str(tmp_path / "p2"), "earliest", 20), str(tmp_path / "two"))
    assert [(b, o) for b, o, _, _ in both] == [(i // 20, i) for i in range(37)]
    assert [(t, v) for _, _, t, v in both] == [("a", f"m{i}") for i in range(25)] + [("b", f"m{i}") for i in range(7)] + [("a", f"m{i}") for i in range(25, 30)]


def test_from_newest_and_from_a_checkpoint(spark, tmp_path):
    """What was there before the first start doesn't come; what comes while the query is down does, in whole batches."""
    log, folder = str(tmp_path / "log"), str(tmp_path / "query")
    publish(frame(spark, "a", range(5)), log, ["n"])
    stream = lambda: read_messages(spark, log, ["a"], f"{folder}/position", "latest", 4)
    assert [o for _, o, _, _ in run(stream(), folder, lambda: publish(frame(spark, "a", range(5, 11)), log, ["n"]))] == list(range(5, 11))
    publish(frame(spark, "a", range(11, 20)), log, ["n"])
    got = run(stream(), folder)
    assert [(o, v) for _, o, _, v in got] == [(i, f"m{i}") for i in range(5, 20)]
    sizes = [sum(b == n for b, *_ in got) for n in range(max(got)[0] + 1)]
    assert [n for n in sizes if n] == [4, 2, 4, 4, 1]


def test_a_start_before_any_batch_is_kept(spark, tmp_path):
    log, folder = str(tmp_path / "log"), str(tmp_path / "query")
    publish(frame(spark, "a", range(5)), log, ["n"])
    stream = lambda: read_messages(spark, log, ["a"], f"{folder}/position", "latest", 4)
    query = stream().writeStream.format("noop").option("checkpointLocation", f"{folder}/state").start()
    query.processAllAvailable()
    query.stop()
    publish(frame(spark, "a", range(5, 8)), log, ["n"])
    assert [o for _, o, _, _ in run(stream(), folder)] == [5, 6, 7]


def test_many_batches_of_a_micro_batch(spark, tmp_path):
    """Each keeps its bound and its number, also after a restart; a short one comes where the log ended."""
    log, folder = str(tmp_path / "log"), str(tmp_path / "query")
    publish(frame(spark, "a", range(25)), log, ["n"], per_file=4)
    stream = lambda: read_messages(spark, log, ["a"], f"{folder}/position", "earliest", 4, per_trigger=5)

    def batches():
        keep = lambda df, n: df.withColumn("micro", F.lit(n)).write.mode("overwrite").parquet(f"{folder}/out/{n}")
        query = stream().writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/state").start()
        query.processAllAvailable()
        query.stop()
        query.awaitTermination(60)
        return sorted((r.offset, r.value, r.batch, r.micro) for r in spark.read.parquet(f"{folder}/out/*").collect())

    got = batches()
    assert got == [(i, f"m{i}", i // 4, i // 20) for i in range(25)]
    publish(frame(spark, "a", range(25, 32)), log, ["n"])
    assert batches() == got + [(i, f"m{i}", 7 + (i - 25) // 4, 2) for i in range(25, 32)]


def test_a_task_reads_many_files(spark, tmp_path):
    log = str(tmp_path / "log")
    publish(frame(spark, "a", range(50)), log, ["n"], per_file=1)
    reader = _Reader({"folder": log, "topics": '["a"]', "starting": "earliest", "per_batch": "100", "position": str(tmp_path / "p")})
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert len(parts) == 3
    assert sorted(o for p in parts for b in reader.read(p) for o in b.column(1).to_pylist()) == list(range(50))


def test_wrong_settings(spark, tmp_path):
    for more in ({"starting": "yesterday"}, {"max_per_batch": 0}):
        with pytest.raises(ValueError):  # noqa: PT011
            read_messages(spark, str(tmp_path), ["a"], "p", **more)


def test_names_are_taken_once(spark, tmp_path):
    path = str(tmp_path / "index" / "000")
    assert put_new(spark, path, "first")
    assert not put_new(spark, path, "second")
    assert (tmp_path / "index" / "000").read_text() == "first"
    assert [p.name for p in (tmp_path / "index").iterdir() if not p.name.startswith(".")] == ["000"]
