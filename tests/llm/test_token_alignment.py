"""Token alignment against the libraries and brute force."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from sparklogs.llm import token_alignment
from sparklogs.llm.bpe import byte_letters
from sparklogs.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "  two  spaces\n\n\ttab ", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "é🎉żółć 中文 ͸", "\0\x01\x7f", "1234567 x=y;", "thatthatthat" * 40, "ÅéÅ é", " nbsp　wide", "x" * 3000, "word " * 2000 + "🎉" * 500]


@pytest.fixture(scope="module")
def sides():
    a, b = tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {c: i for i, c in enumerate(byte_letters())}
    return a, b, letters


def tokens(sides, text):
    a, b, letters = sides
    whole = (" " + (text or "")).encode()
    if not text:
        return [], []
    side_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    side_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        side_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    if any(b"".join(t for _, t in side) != whole for side in (side_a, side_b)):
        return [], []
    return side_a, side_b


def brute(sides, texts):
    """For each text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    found, counts = [], Counter()
    for text in texts:
        side_a, side_b = tokens(sides, text)
        ends = []
        for side in (side_a, side_b):
            at, here = 0, []
            for i, t in side:
                at += len(t)
                here.append((at, i))
            ends.append(here)
        both = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        groups, last = [], 0
        for e in both:
            groups.append("|".join(",".join(str(i) for x, i in here if last < x <= e) for here in ends))
            last = e
        links = [(i, j) for e in both for x, i in ends[0] if x == e for y, j in ends[1] if y == e] if len(both) < 200 else None
        if links is None:
            of_a, of_b = dict(ends[0]), dict(ends[1])
            links = [(of_a[e], of_b[e]) for e in both]
        counts.update(links)
        found.append((len(side_a), len(side_b), groups, links))
    top = Counter()
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    return [
        (a, b, len(g), len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for a, b, g, links in found
    ]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, n_a int, pairs string").repartition(3)


def told(df):
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


@pytest.mark.parametrize("stretch", [1, 5, 256])
def test_common_ends(monkeypatch, stretch):
    monkeypatch.setattr(token_alignment, "STRETCH", stretch)
    rng = np.random.default_rng(stretch)
    for _ in range(60):
        n = int(rng.integers(1, 700))
        ends = np.cumsum(rng.integers(1, 4, n))
        last = np.arange(n) == n - 1
        a, b = ends[(rng.random(n) < rng.random() + 0.1) | last], ends[(rng.random(n) < 0.9) | last]
        in_a, in_b = token_alignment.common_ends(a, b)
        assert (in_a == np.isin(a, b)).all() and (in_b == np.isin(b, a)).all()
    nothing = np.zeros(0, np.int64)
    assert [len(x) for x in token_alignment.common_ends(nothing, nothing)] == [0, 0]


def test_report_is_brute_force(spark, sides):
    rows = [*enumerate(ODD), (3, "a"), (3, "a"), (None, "null id"), (None, None)]
    want = brute(sides, [t for _, t in rows])
    assert told(token_alignment.alignment_report(frame(spark, rows), A, B)) == sorted(((i, *w) for (i, _), w in zip(rows, want, strict=True)), key=repr)
    assert token_alignment.alignment_report(frame(spark, []), A, B).collect() == []


def test_query_is_brute_force(spark, sf, sides):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = brute(sides, texts.values())
    assert told(QUERIES["op12_token_alignment"](spark, sf)) == sorted(((i, *w) for i, w in zip(texts, want, strict=True)), key=repr)


def test_groups_and_counts(spark, sides):
    rows = [(1, "hello world, 12345"), (2, ""), (3, "hello")]
    got = {r.doc_id: r.groups for r in token_alignment.aligned_groups(frame(spark, rows), A, B).collect()}
    for i, text in rows:
        side_a, side_b = tokens(sides, text)
        assert [x for g in got[i] for x in g.a] == [x for x, _ in side_a]
        assert [x for g in got[i] for x in g.b] == [x for x, _ in side_b]
    counts = {(r.a, r.b): r.n for r in token_alignment.pair_counts(frame(spark, rows), A, B).collect()}
    assert sum(counts.values()) == sum(map(len, got.values()))
    assert counts[got[3][0].a[-1], got[3][0].b[-1]] == 2


def test_a_million_letters(spark):
    rows = [(1, "ab cd" * 200_000), (2, "\n" * 300_000), (3, "A" * 100_000)]
    got = {r.doc_id: r for r in token_alignment.alignment_report(frame(spark, rows), A, B).collect()}
    assert all(got[i].n_groups > 0 for i, _ in rows)
