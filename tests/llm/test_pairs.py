"""Operators on pairs and copies against brute force, with nulls, ties, repeats, empty tables and clashing column names."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparklogs.llm import embedding_dedup, exact_dedup, jaccard_join, suffix_dedup
from sparklogs.llm.common import components, without_ids
from sparklogs.llm.shingles import shingle_sets

DOCS = "doc_id long, text string, n long, id long, kept string, node long, a int, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 4, "y") for r in rows], DOCS).repartition(3)


def words(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def smallest(ids, links):
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(group[a], group[b])
            if group[a] != low or group[b] != low:
                group[a] = group[b] = low
                changed = True
    return group


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(20)] + [(200, i) for i in range(201, 230)] + [(7, 7), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    known = [e for e in edges if e[0] is not None]
    assert got == smallest({i for e in known for i in e}, known)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_ids(spark):
    df = frame(spark, [(i, "t") for i in range(50)] + [(None, "t")])
    left = without_ids(df, spark.createDataFrame([(i,) for i in range(0, 50, 3)] + [(None,)], "id long"))
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [i for i in range(50) if i % 3]
    assert left.where("doc_id IS NULL").count() == 1


def test_exact_dedup(spark):
    rng = random.Random(2)
    texts = ["a b", "ab", "a\tb\n", "ab ", "", None, "  ", "x" * 5000, *[f"t{rng.randrange(9)}{' ' * rng.randrange(3)}" for _ in range(200)]]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(frame(spark, rows)).collect()}
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    for text, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (keep, len(members), i == keep, hashlib.sha256(text.encode()).hexdigest())
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0
    twice = exact_dedup.exact_dedup(frame(spark, [(1, "a"), (1, "a"), (None, "a")])).collect()
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in twice) == [(0, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True)]


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def test_shingle_sets():
    texts = ["", None, "A b", "a B c d e", "a b\x0bc d e f", "É é", "x " * 3000, "long" * 200_000 + " b c d e"]
    got = shingle_sets([None if t is None else t.encode() for t in texts], 4)
    assert [len(s) for s in got] == [len(shingles(t, 4)) for t in texts]
    same = shingle_sets([b"A b C d", b"q", b"a B c D"], 4)
    assert same[0].tolist() == same[2].tolist()
    keyed = [shingle_sets([b"A b C d"], 4, k)[0].tolist() for k in (b"1", b"1", b"2")]
    assert keyed[0] == keyed[1] != keyed[2]


def test_words_made_to_collide(spark):
    """Pairs that met under the unkeyed hash of an earlier version: no link."""
    pairs = [("abcdefghijklmnop", "_z>.(-07hw#@q7q="), ("a\0", "a"), ("abcdefgh\0", "abcdefgh"), ("x" * 600, "x" * 601)]
    for tail in ("", " x y z", " x y z w v"):
        rows = [(i, w + tail) for i, w in enumerate(w for pair in pairs for w in pair)]
        got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 85, 4).collect()}
        assert got == {i: i for i, _ in rows}


@pytest.mark.parametrize(("percent", "width"), [(85, 4), (80, 5)])
def test_jaccard(spark, monkeypatch, percent, width):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)  # so that buckets have several blocks
    rng = random.Random(percent)
    base = [words(rng, rng.choice([3, 9, 40, 120])).split() for _ in range(12)]
    rows = [(0, None), (1, ""), (2, "one"), (3, "ONE"), (4, "one two"), (5, " \t\n")]
    for i in range(6, 150):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 2, 4, 9])):
            w[rng.randrange(len(w))] = f"v{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    rng.shuffle(rows)
    sets = {i: shingles(t, width) for i, t in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    group = smallest(sets, links)
    got = jaccard_join.jaccard_components(frame(spark, rows), percent, width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), group[i]) for i in sets}


def test_jaccard_edges(spark):
    assert jaccard_join.jaccard_components(frame(spark, [])).count() == 0
    got = jaccard_join.jaccard_components(frame(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (2, None)])).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, None), (2, 2), (3, 3), (3, 3)]


def test_long_words_of_equal_sums(spark):
    """Two words that agree in every polynomial modulo a power of two are different words."""
    a = "a"
    for _ in range(10):
        a += a.translate(str.maketrans("ab", "ba"))
    rows = [(1, a + " x y z"), (2, a.translate(str.maketrans("ab", "ba")) + " x y z"), (3, a + " x y z "), (4, "c" * 600 + " x y z"), (5, "c" * 601 + " x y z")]
    got = jaccard_join.jaccard_components(frame(spark, rows), 85, 4).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def some_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, rng.integers(1, 900), np.uint64)) for _ in range(20)]
    for s in list(sets):
        for share in (0.99, 0.95, 0.9, 0.7):
            sets.append(np.unique(np.append(s[rng.random(len(s)) < share], rng.integers(0, 1 << 63, 3, np.uint64))))
    return sets


@pytest.mark.parametrize("percent", [30, 85])
@pytest.mark.parametrize("halves", [False, True])
def test_traversal_joins_what_is_linked(percent, halves):
    sets = some_sets()
    walk = jaccard_join.Traversal(sets, list(range(len(sets))), percent)
    everything = list(range(len(sets)))
    left, right = (everything[::2], everything[1::2]) if halves else (everything, None)
    walk.run(left, right)
    links = []
    for i, j in combinations(everything, 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        assert both == jaccard_join.overlap(sets[i], sets[j])
        if (100 + percent) * both >= percent * (len(sets[i]) + len(sets[j])) and (right is None or (i in left) != (j in left)):
            links.append((i, j))
    assert {tuple(sorted(p)) for p in walk.links} <= set(links)
    assert smallest(everything, walk.links) == smallest(everything, links)
    assert walk.checked < len(sets) ** 2 / 8


def test_traversal_of_copies_is_linear():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 300, np.uint64)
    sets = [np.unique(np.append(base[rng.random(300) < 0.99], rng.integers(0, 1 << 63, 1, np.uint64))) for _ in range(2000)]
    walk = jaccard_join.Traversal(sets, list(range(2000)), 85)
    walk.run(list(range(2000)))
    assert len(walk.links) == 1999 and walk.checked < 3 * 2000


def cut(rows, depth=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - depth + 1):
            first[b[p : p + depth]] = min(i, first.get(b[p : p + depth], i))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - depth + 1):
            if first[b[p : p + depth]] < i:
                gone[p : p + depth] = b"\1" * depth
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out[i] = (len(b), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def test_suffix_dedup(spark):
    rng = random.Random(4)
    base = [words(rng, 80) for _ in range(6)] + ["é" * 60, "ab" * 400, "\0" * 70, "a" * 49, "b" * 50]
    rows = [(0, None), (1, ""), (2, "short")]
    for i in range(3, 60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            b = rng.choice(base)
            s = rng.randrange(len(b))
            parts.append(b[s : s + rng.randrange(20, 400)])
        rows.append((i, rng.choice(["", "-", words(rng, 5)]).join(parts)))
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in suffix_dedup.repeated_passages(frame(spark, rows)).collect()}
    expected = cut(rows)
    assert got == expected
    assert sum(bool(s) for _, s, _ in expected.values()) > 20


def test_suffix_dedup_edges(spark):
    assert suffix_dedup.repeated_passages(frame(spark, [])).count() == 0
    t = "0123456789" * 6
    got = suffix_dedup.repeated_passages(frame(spark, [(None, t), (2, t), (2, t), (1, "x" + t)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (2, 60), (2, 60)]


def beside_a_line(rng, n):
    """Documents that share a line between words of their own, and in part more."""
    line = "this line of some sixty bytes stands in very many documents."
    near = [words(rng, 4) for _ in range(5)]
    return [(i, f"{words(rng, 6)} {rng.choice(near)} {line} {rng.choice(near)} {words(rng, 6)}") for i in range(n)]


def test_suffix_dedup_hot_grams(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 400)
    rows = beside_a_line(random.Random(6), 60)
    got = {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in suffix_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert got == cut(rows)


def test_hot_grams_never_share_a_suffix_array(monkeypatch):
    """The steps of op2 in one process: no array is longer than a block and the most that one gram may have."""
    rows = beside_a_line(random.Random(7), 3000)
    limit = 20_000
    sizes = []
    exact = suffix_dedup.repeated_windows
    monkeypatch.setattr(suffix_dedup, "BLOCK", limit)
    monkeypatch.setattr(suffix_dedup, "repeated_windows", lambda strings, docs: sizes.append(sum(map(len, strings))) or exact(strings, docs))
    table = pa.record_batch({"id": pa.array([i for i, _ in rows], pa.int64()), "text": [t for _, t in rows]})
    met = [r for b in suffix_dedup._meet((b.select(["bucket", "payload"]) for b in suffix_dedup._deal(1)([table]) if b.column(2)[0].as_py() < 0), limit) for r in b.to_pylist()]
    hot = np.concatenate([np.frombuffer(r["payload"], "<u4") for r in met if r["kind"] == suffix_dedup._HOT])
    loads = {}
    for r in met:
        if r["kind"] == suffix_dedup._READ:
            loads.setdefault(r["doc"], []).append(r["payload"])
    wanted = pa.record_batch({"id": pa.array(list(loads), pa.int64()), "text": [rows[i][1] for i in loads], "loads": list(loads.values())})
    assert len(hot)
    found = list(suffix_dedup._compare(suffix_dedup._read(3, hot)([wanted])))
    assert found and sizes and max(sizes) <= 2 * limit


@pytest.mark.parametrize("depth", [2, 5, 9])
def test_bounded_suffix_arrays(depth):
    rng = np.random.default_rng(depth)
    for _ in range(40):
        k = int(rng.integers(1, 7))
        strings = [bytes(rng.integers(0, 3, rng.integers(0, 40)).astype(np.uint8)) for _ in range(k)]
        docs = rng.integers(0, 4, k)
        got = suffix_dedup.repeated_windows(strings, docs, depth)
        for i, s in enumerate(strings):
            assert list(got[i]) == [p for p in range(len(s) - depth + 1) if any(docs[j] < docs[i] and s[p : p + depth] in strings[j] for j in range(k))]


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 4)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((8, 16))
    rows = []
    for i in range(120):
        v = base[rng.integers(8)] + rng.standard_normal(16) * rng.choice([0, 0.02, 0.05, 0.08])
        rows.append((i, [float(x) for x in v * rng.choice([1, 3])], int(rng.integers(2))))
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [1.0, None], 1), (203, [float("nan")] * 16, 1), (204, [float("inf")] + [1.0] * 15, 1), (205, rows[0][1], None), (206, rows[0][1][:8], rows[0][2]), (207, [], 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, id string, links int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()}
    links = []
    for (i, a, k), (j, b, m) in combinations(rows[:120], 2):
        if k == m and np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98:
            links.append((i, j))
    group = smallest([r[0] for r in rows], links)
    for i, _, _ in rows:
        assert got[i] == (sum(i in e for e in links), group[i], group[i] == i)
    assert len(links) > 50
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    keys = embedding_dedup.bucket_keys(np.array([[1.0, 2.0], [2.0, 4.0]]))
    assert (keys[0] == keys[1]).all()
    assert df.select(F.count("*")).first()[0] == len(got)


def test_embeddings_of_any_scale(spark):
    rows = [(1, [3e200, 1e200], 1), (2, [6e200, 2e200], 1), (3, [3e-200, 1e-200], 1), (4, [1e-200, -3e-200], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}


def test_very_long_texts(spark):
    """One text of a million letters without a space, one of 200,000 words, and copies with a change."""
    rng = random.Random(11)
    many, solid = words(rng, 200_000, 5000), "".join(rng.choice("abcdefgh") for _ in range(1_000_000))
    rows = [(1, many), (2, f"{many} end"), (3, solid), (4, f"{solid[:-1]}z")]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(frame(spark, rows), 85, 4).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    cut_ = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert cut_[2] == (len(many) + 4, len(many)) and cut_[4] == (1_000_000, 999_999)
