import random
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from sparklogs.operators import segments
from sparklogs.operators.segments import assign_existing_segment, assign_segments, segment_sizes
from sparklogs.sources import archive
from sparklogs.sources.archive import read_archive, scan_archive, write_archive
from sparklogs.streaming.jobs import stream_archive

INDEX = "start_ts long, topic string, day string, path string, size long, recent_ts long"
DAY = 86_400_000


def frame(spark, rows):
    return spark.createDataFrame(rows, "seq long, topic string, timestamp long, value string")


def model(rows, limit, index=(), per_topic=True):
    """The roll rule, one message after another."""
    files, out = {}, {}
    for start, topic, size, recent in index:
        files.setdefault(topic if per_topic else "", {})[start] = [size, recent]
    for seq, topic, ts, value in sorted(rows):
        known = files.setdefault(topic if per_topic else "", {})
        starts = sorted(known)
        k = bisect_right(starts, ts) - 1
        if k >= 0:
            size, recent = known[starts[k]]
            roll = k == len(starts) - 1 and ts > recent and size > limit
            if not roll and starts[k] // DAY == ts // DAY:
                known[starts[k]] = [size + len(value), max(recent, ts)]
                out[seq] = starts[k]
                continue
        known[ts] = [len(value), ts]
        out[seq] = ts
    return out


@pytest.mark.parametrize("kind", ["any order", "in order", "late", "very late"])
def test_segments_follow_the_rule(spark, monkeypatch, kind):
    """Also where a day is many chunks of the order, of bytes and of time."""
    rng = random.Random(kind)
    span = DAY // 2 if kind == "very late" else 3 * DAY
    rows = [(i, rng.choice("ab"), rng.randrange(span) - DAY, "x" * rng.randrange(9)) for i in range(150)]
    if kind != "any order":
        late = {"in order": 1, "late": span // 15, "very late": span // 2}[kind]
        times = [t - rng.randrange(late) if rng.random() < 0.5 else t for t in sorted(r[2] for r in rows)]
        rows = [(i, t, ts, v) for (i, t, _, v), ts in zip(rows, times, strict=True)]
        for name, size in (("CHUNK_ROWS", 7), ("CHUNK_BYTES", 20), ("CHUNK_MS", DAY // 24)):
            monkeypatch.setattr(segments, name, size)
    index = [(rng.randrange(span) - DAY, rng.choice("ab"), rng.randrange(30), None) for _ in range(4)] if kind in ("any order", "late") else []
    index = [(s, t, z, s + rng.randrange(1000)) for s, t, z, _ in {(i[0], i[1]): i for i in index}.values()]
    files = spark.createDataFrame([(s, t, None, None, z, r) for s, t, z, r in index], INDEX)
    per_topic = kind != "in order"
    got = {r.seq: r.segment_ts for r in assign_segments(frame(spark, rows), 15, files, per_topic=per_topic).collect()}
    assert got == model(rows, 15, index, per_topic)
    assert len(set(got.values())) > 5


def test_segments_of_odd_messages(spark):
    rows = [(1, None, 5, "x" * 20), (2, None, 6, None), (3, None, 7, ""), (4, "a", None, "gone"), (5, None, 5, "late")]
    got = {r.seq: r.segment_ts for r in assign_segments(frame(spark, rows), 15).collect()}
    assert got == {1: 5, 2: 6, 3: 6, 5: 5}
    assert assign_segments(frame(spark, []), 15).collect() == []


def test_a_day_of_more_files_takes_no_more_jobs(spark):
    """Pointers are followed inside blocks, not by a pair of jobs for each doubling."""
    took = []
    for files in (3, 200):
        rows = [(i, "a", i * 1000, "x" * 10) for i in range(files * 3)]
        spark.sparkContext.setJobGroup(group := f"{files} files", group)
        got = assign_segments(frame(spark, rows).repartition(2), 25)
        took.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        spark.sparkContext.setJobGroup("", "")
        assert {r.seq: r.segment_ts for r in got.collect()} == model(rows, 25)
    assert took[1] <= took[0] + 3


def test_chunks_of_a_sparse_day_are_long():
    assert segments.chunk_ms(0) == segments.chunk_ms(9_000) == DAY
    assert segments.chunk_ms(1 << 20) == DAY // 64 and segments.chunk_ms(1 << 40) == segments.CHUNK_MS


def test_existing_segments(spark):
    files = spark.createDataFrame([(s, t, None, None, 0, s) for s, t in ((10, "a"), (20, "a"), (15, "b"))], INDEX)
    rows = [(1, "a", 9, ""), (2, "a", 10, ""), (3, "a", 25, ""), (4, "a", DAY + 1, ""), (5, "b", 14, ""), (6, "a", None, "")]
    got = {r.seq: r.start_ts for r in assign_existing_segment(frame(spark, rows), files).collect()}
    assert got == {1: None, 2: 10, 3: 20, 4: None, 5: None, 6: None}


def test_existing_segments_over_a_day(spark):
    rng = random.Random(3)
    starts = sorted(rng.sample(range(3 * DAY), 40))
    files = spark.createDataFrame([(s, "a", None, None, 0, s) for s in starts], INDEX)
    rows = [(i, "a", rng.choice([rng.randrange(3 * DAY), rng.choice(starts)]), "") for i in range(500)]
    got = {r.seq: r.start_ts for r in assign_existing_segment(frame(spark, rows), files).collect()}
    assert got == {i: max((s for s in starts if s <= t and s // DAY == t // DAY), default=None) for i, _, t, _ in rows}


#: 1961-04-12 06:07:00.250 UTC, and the last millisecond of that day.
T0, NIGHT = -275248379750, -275184000001


@pytest.mark.parametrize(
    ("times", "limit", "paths"),
    [
        ([T0], 100, ["1961-04-12/19610412T060700.250Z.gate"]),
        ([T0, T0 + 1500], 1 << 20, ["1961-04-12/19610412T060700.250Z.gate"]),
        ([T0, T0 + 1500], 10, ["1961-04-12/19610412T060700.250Z.gate", "1961-04-12/19610412T060701.750Z.gate"]),
        ([NIGHT, NIGHT + 1], 1 << 20, ["1961-04-12/19610412T235959.999Z.gate", "1961-04-13/19610413T000000.000Z.gate"]),
        ([T0, T0 + 2000, T0 + 700], 1 << 20, ["1961-04-12/19610412T060700.250Z.gate"]),
    ],
)
def test_write_scan_read(spark, tmp_path, times, limit, paths):
    base = str(tmp_path / "a")
    values = [f'{{"timestamp":{t},"level":"INFO","location":"l","message":"m{i}"}}' for i, t in enumerate(times)]
    assert scan_archive(spark, base).count() == 0
    for i, (t, v) in enumerate(zip(times, values, strict=True)):  # one write a message: the state is what lies in the archive
        write_archive(frame(spark, [(i, "gate", t, v)]), base, limit)
    index = scan_archive(spark, base).orderBy("start_ts").collect()
    assert [r.path[len(base) + 1 :] for r in index] == paths
    assert sum(r.size for r in index) == sum(len(v) + 1 for v in values)
    assert max(r.recent_ts for r in index) == max(times)
    assert read_archive(spark, base, min(times), max(times) + 1).count() == len(times)
    assert read_archive(spark, base, min(times), max(times)).count() == len(times) - 1
    once = assign_segments(frame(spark, [(i, "gate", t, v) for i, (t, v) in enumerate(zip(times, values, strict=True))]), limit)
    assert segment_sizes(once).count() == len(paths)


def test_stream_archive(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("gate", f'{{"timestamp":{i},"message":"m"}}') for i in range(5)], "topic string, value string").write.parquet(source)
    stream = spark.readStream.schema("topic string, value string").parquet(source)
    stream_archive(stream, base, str(tmp_path / "c"), trigger={"availableNow": True}).awaitTermination(120)
    assert read_archive(spark, base, 0, 10).where(F.col("message") == "m").count() == 5


def test_a_batch_that_runs_again_leaves_what_one_run_leaves(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "a")
    rows = frame(spark, [(i, "ab"[i % 2], i * 1000, f'{{"timestamp":{i * 1000},"message":"m{i}"}}') for i in range(8)])
    write_archive(rows, base, 40, batch="0")
    more = frame(spark, [(i, "ab"[i % 2], i * 1000, f'{{"timestamp":{i * 1000},"message":"m{i}"}}') for i in range(8, 16)])
    moved = []

    def fail_at_second(spark, source, goal, move=archive.move):
        if moved:
            raise OSError("lost")
        moved.append(goal)
        move(spark, source, goal)

    with monkeypatch.context() as patch:
        patch.setattr(archive, "move", fail_at_second)
        with pytest.raises(OSError, match="lost"):
            write_archive(more, base, 40, batch="1")
    first = write_archive(more, base, 40, batch="1").orderBy("seq").collect()
    again = write_archive(more, base, 40, batch="1").orderBy("seq").collect()
    assert moved and first == again
    kept = archive.load_index(spark, base).select("start_ts", "topic", "day", "path", "size", "recent_ts")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, scan_archive(spark, base).collect()))
    with monkeypatch.context() as patch:  # a write reads one version of the index and lists nothing
        patch.setattr(archive, "scan_archive", None)
        for k in range(2, 5):
            write_archive(frame(spark, [(k, "a", 20_000 + k, "{}")]), base, 40, batch=str(k))
    assert len(archive._versions(spark, base)) == archive.KEPT_VERSIONS + 1
    assert sorted(r.message for r in read_archive(spark, base, 0, 20_000).collect()) == sorted(f"m{i}" for i in range(16))
    newest = {(r.topic, r.start_ts): r.recent_ts for r in scan_archive(spark, base).collect()}
    for r in scan_archive(spark, base, newest_only=True).collect():
        last = r.start_ts == max(start for topic, start in newest if topic == r.topic)
        assert r.recent_ts == (newest[r.topic, r.start_ts] if last else None)


def test_a_finished_batch_writes_no_files_again(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "a")
    rows = frame(spark, [(i, "gate", i * 1000, f'{{"timestamp":{i * 1000},"message":"m{i}"}}') for i in range(8)])
    first = write_archive(rows, base, 40, batch="0").orderBy("seq").collect()
    before = sorted(map(tuple, scan_archive(spark, base).collect()))
    with monkeypatch.context() as patch:
        patch.setattr(archive, "_move", None)
        assert write_archive(rows, base, 40, batch="0").orderBy("seq").collect() == first
    assert sorted(map(tuple, scan_archive(spark, base).collect())) == before and len(before) > 2
    write_archive(frame(spark, [(8, "gate", 8000, '{"timestamp":8000,"message":"m8"}')]), base, 40, batch="1")
    assert sorted(r.message for r in read_archive(spark, base, 0, 9_000).collect()) == [f"m{i}" for i in range(9)]


def test_a_replay_with_other_partitions_leaves_one_copy(spark, tmp_path):
    """Messages keep the order of their offsets, so that they go where they went before."""
    rows = [(i, f'{{"timestamp":{(i * 7919) % 50 + 20 * i},"message":"{i}"}}') for i in range(60)]
    base, stream = str(tmp_path / "a"), None
    for part in (1, 7):
        frames = spark.createDataFrame([("gate", o, v) for o, v in rows], "topic string, offset long, value string").repartition(part, "value")

        class Once:
            """A stream whose one batch is given again."""

            def foreachBatch(self, function, frames=frames):
                function(frames, 0)
                return self

            def __getattr__(self, name):
                return lambda *a, **k: self

        class Stream:
            writeStream = Once()

        stream_archive(Stream(), base, "state", 400)
        found = sorted(int(r.message) for r in read_archive(spark, base, 0, 10_000).collect())
        assert found == list(range(60))
        stream = sorted((r.start_ts, r.size) for r in scan_archive(spark, base).collect()) if stream is None else stream
    assert sorted((r.start_ts, r.size) for r in scan_archive(spark, base).collect()) == stream and len(stream) > 3


def test_a_failed_rename_loses_nothing(spark, tmp_path):
    from sparklogs.shared import move

    (tmp_path / "a").write_text("x")
    with pytest.raises(Exception):  # noqa: B017  the goal's folder can't be made below a file
        move(spark, str(tmp_path / "a"), str(tmp_path / "a" / "b"))
    assert (tmp_path / "a").read_text() == "x"
