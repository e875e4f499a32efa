"""Ranked lexical search against brute force, over lots of items, blocks and owners of any size."""

import math
import random
import re
from collections import Counter

import pytest

from sparklogs.llm import lexical_search
from sparklogs.llm.lexical_search import lexical_search as search

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items, top=10):
    """(item_id, rank, doc_id, score) as it is worded; rows of equal ids are told apart by their place."""
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, tf, n in held:
            m = 100 - 75 + (75 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms(text) if tf[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "y") for i, t in rows], "doc_id long, text string, score int, item string").repartition(3)


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "item_id string, text string, doc_id int, rank int")


def told(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def texts(seed, n, size):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 90}" for _ in range(400)] + ["É", "é", "İ", "x1_y2", "a-b", "中文字", "\x85", "ſ"]
    join = [" ", ", ", "\n", "\x00", ".", "`"]
    return ["".join(rng.choice(words).upper() + rng.choice(join) if rng.random() < 0.2 else rng.choice(words) + rng.choice(join) for _ in range(rng.randrange(size))) for _ in range(n)]


ODD = [(None, "w1 w2 null id"), (None, None), (5, "w1 twice"), (5, "w1 twice"), (6, ""), (7, "., -"), (8, "w3 " * 200_000)]


@pytest.mark.parametrize("block, lot, owners", [(1024, 4 << 20, 4), (3, 200, 4), (16, 1 << 20, 1), (1, 1 << 20, 7)])
def test_search_is_brute_force(spark, monkeypatch, block, lot, owners):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", lot)
    monkeypatch.setattr(lexical_search, "OWNERS", owners)
    docs = [*enumerate(texts(block, 60, 50)), *ODD]
    items = [(f"i{k}", t) for k, t in enumerate(texts(owners, 12, 15))] + [("none", None), ("blank", " "), ("unknown", "zzz"), (None, "w1 w1 w2 W1")]
    for top in (1, 10):
        assert told(search(docs_frame(spark, docs), items_frame(spark, items), top)) == brute(docs, items, top)


def test_blocks_end_at_postings(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", 5)
    docs, items = list(enumerate(texts(3, 40, 30))), [("a", "w1 w2 w3 w5"), ("b", "é É")]
    assert told(search(docs_frame(spark, docs), items_frame(spark, items))) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "a b"), (2, None)], [("x", "a")]
    assert told(search(docs_frame(spark, []), items_frame(spark, items))) == []
    assert told(search(docs_frame(spark, docs), items_frame(spark, []))) == []
    assert told(search(docs_frame(spark, [(1, None)]), items_frame(spark, items))) == []
    assert told(search(docs_frame(spark, docs), items_frame(spark, items))) == brute(docs, items)


def test_documents_leave_bundles_only_when_they_can(spark):
    """Many ties and a document that only the last owner's frequent terms bring up."""
    docs = [(i, "common " * (i % 5) + f"rare{i % 3} filler{i}") for i in range(200)] + [(999, "common " * 60)]
    items = [("a", "common rare1"), ("b", "common " * 500 + "rare2"), ("c", "common")]
    assert told(search(docs_frame(spark, docs), items_frame(spark, items))) == brute(docs, items)
