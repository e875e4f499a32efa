"""Line dedup: cuckoo filters, and an index against brute force over inserts and deletions."""

import random

import numpy as np
import pytest

from sparklogs.llm import line_dedup
from sparklogs.llm.cuckoo import CuckooFilter, key_words
from sparklogs.llm.line_dedup import LineIndex
from sparklogs.shared import new_folder

SPACE = " \t\n\x0b\x0c\r"
UPPER = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def key(line):
    return "".join(UPPER.get(c, c) for c in line.strip(SPACE))


def brute(docs, held):
    """`docs` deduped against the documents `held`: (id, lines, dropped, kept)."""
    where = {}
    for i, text in held:
        for line in (text or "").split("\n"):
            where.setdefault(key(line), set()).add(float("inf") if i is None else i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        at = float("inf") if i is None else i
        drop = [len(key(x)) >= 10 and len(where.get(key(x), ())) > 1 and min(where[key(x)]) < at for x in lines]
        out.append((i, len(lines), sum(drop), "\n".join(x for x, gone in zip(lines, drop, strict=True) if not gone)))
    return sorted(out, key=repr)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "shard", 1) for i, t in docs], "doc_id long, text string, key string, refs long")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def texts(seed, n):
    rand = random.Random(seed)
    lines = [" A line of words %d " % k for k in range(12)] + ["short", "", "\t", "exactly 10", "nine char", "żółta łódź", "żółta łód", "ÄÖÜ ÄÖÜ ÄÖÜ", "\x85 not space", "with\rreturn inside it\r"]
    return [(i, "\n".join(rand.choice(lines) for _ in range(rand.randrange(6)))) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_cuckoo_filter(n):
    rand = np.random.default_rng(n)
    words = key_words(rand.bytes(16 * n))
    filter_ = CuckooFilter.of(words)
    assert len(filter_) == n and filter_.contains(words).all()
    filter_.remove(words[::2])
    assert len(filter_) == n - len(words[::2]) and filter_.contains(words[1::2]).all()
    again = CuckooFilter(table=filter_.tobytes())
    assert again.add(words[::2]) and again.contains(words).all()
    assert CuckooFilter.of(words).contains(key_words(rand.bytes(160_000))).mean() < 0.002


def test_full_cuckoo_filter_stays_as_it_was():
    words = key_words(np.random.default_rng(0).bytes(16 * 300))
    filter_ = CuckooFilter(64)
    assert filter_.add(words[:100])
    before = filter_.tobytes()
    assert not filter_.add(words[100:])
    assert filter_.tobytes() == before
    with pytest.raises(KeyError):
        CuckooFilter(64).remove(words[:1])


def test_index_grows_and_shrinks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 5)
    held = texts(1, 30) + [(None, " a LINE of words 3"), (None, "with\rreturn inside it\nx"), (4, "a line of words 1"), (5, None)]
    index = LineIndex(spark, new_folder(spark, "lines"))
    assert rows(index.dedup(frame(spark, held))) == brute(held, [])
    index.insert(frame(spark, held[:12]))
    assert rows(index.dedup(frame(spark, held))) == brute(held, held[:12])
    index.insert(frame(spark, held[8:]))  # four of them again
    assert rows(index.dedup(frame(spark, held))) == brute(held, held)
    first = [d for d in held if d[0] not in (0, 1, 2, 5, None)]
    index.delete(frame(spark, [(i, "") for i in (0, 1, 2, 5, None, 999)]))
    assert rows(index.dedup(frame(spark, held))) == brute(held, first)
    counts = {bytes(k): (n, f) for k, n, f in index.counts().collect()}
    want = {}
    for i, text in first:
        for line in text.split("\n"):
            if k := line_dedup.line_key(line.encode()):
                want.setdefault(k, set()).add(i)
    assert counts == {k: (len(v), min(v)) for k, v in want.items()}
    _, shards = index.state()
    assert shards > 1
    cells = {(r["kind"], r["shard"]): CuckooFilter(table=bytes(r["cells"])) for r in index.filters().collect()}
    assert sum(len(f) for (kind, _), f in cells.items() if kind == "known") == len(want)
    assert sum(len(f) for (kind, _), f in cells.items() if kind == "shared") == sum(len(v) > 1 for v in want.values())
    index.insert(frame(spark, [d for d in held if d not in first]))
    assert rows(index.dedup(frame(spark, held))) == brute(held, held)
    index.delete(frame(spark, [(i, "") for i, _ in held]))
    assert index.counts().isEmpty()
    assert rows(index.dedup(frame(spark, held))) == brute(held, [])


def test_broken_run_leaves_no_version(spark):
    docs = texts(2, 8)
    index = LineIndex(spark, new_folder(spark, "lines")).insert(frame(spark, docs[:4]))
    spark.createDataFrame([(b"0" * 16, 3, 2)], "key binary, doc long, at int").write.parquet(f"{index.folder}/postings/2")
    assert rows(index.dedup(frame(spark, docs))) == brute(docs, docs[:4])
    index.insert(frame(spark, docs[4:]))
    assert rows(index.dedup(frame(spark, docs))) == brute(docs, docs)


def test_long_text_and_empty_table(spark):
    long = "the same line again\n" * 60_000 + "x" * 2_000_000
    docs = [(1, "the same line again"), (2, long), (3, long)]
    index = LineIndex(spark, new_folder(spark, "lines")).insert(frame(spark, docs))
    assert rows(index.dedup(frame(spark, docs))) == brute(docs, docs)
    nothing = LineIndex(spark, new_folder(spark, "lines")).insert(frame(spark, []))
    assert nothing.dedup(frame(spark, [])).collect() == []
    assert rows(nothing.dedup(frame(spark, docs))) == brute(docs, [])
