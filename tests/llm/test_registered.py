"""Each registered query without SQL, run over a whole small table, against brute force or the library."""

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from sparklogs.llm import license_scan, packing, secret_scan
from sparklogs.llm.queries import QUERIES


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def rows(spark, sf, name):
    found = QUERIES[name](spark, sf).collect()
    by_doc = {r.doc_id: r for r in found}
    assert len(by_doc) == len(found)
    return by_doc


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op2(spark, sf, texts):
    raw = {i: t.encode() for i, t in texts.items()}
    first = {}
    for i, b in raw.items():
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(i, first.get(b[p : p + 50], i))
    got = rows(spark, sf, "op2_suffix_dedup")
    assert got.keys() == raw.keys()
    for i, b in raw.items():
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))


def base_spans(text):
    """The fixed patterns as they are worded."""
    names = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else "_?" for c in w) for w in ("password", "passwd", "secret", "token", "api_key"))
    found = [(m.start(), 0, m.end()) for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


def test_op4(spark, sf, texts):
    got = rows(spark, sf, "op4_secret_scan")
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        base = base_spans(t)
        told = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in base)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (*(sum(k == kind for _, k, _ in base) for kind in range(3)), sha(told))
        assert r.spans == ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e, _ in secret_scan.scan(t))
        assert {x for x in told.split(",") if x} <= set(r.spans.split(","))


def test_base_spans_of_odd_texts():
    rng = np.random.default_rng(4)
    parts = ["password", "PassWd", "secret", "tokeN", "api_key", "apikey", "API KEY", '"', "'", " ", ":", "=", "AKIA", "ABCDEF0123456789", "deadbeef", "0123456789abcdef", "\n", "é", "x"]
    for _ in range(3000):
        t = "".join(parts[k] for k in rng.integers(0, len(parts), rng.integers(1, 25)))
        assert secret_scan.base_spans(t) == base_spans(t)


def best_fit_decreasing(lengths, capacity):
    """Sequences of the plain form: longest first, each into the fullest sequence that it fits."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(left) if room >= n]
        if fits:
            left[min(fits, key=lambda k: left[k])] -= n
        else:
            left.append(capacity - n)
    return len(left)


def test_op5(spark, sf, texts):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = QUERIES["op5_packing"](spark, sf).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == texts.keys()
    for i, t in texts.items():
        ids, at = [*library.encode(t, add_special_tokens=False).ids, 0], 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 2048)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at : at + r.length]))
            at += r.length
        assert at == len(ids) and len(pieces[i]) == -(-len(ids) // 2048)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(sequences) == best_fit_decreasing([r.length for r in found], 2048)


@pytest.mark.parametrize("seed", range(5))
def test_placing_is_best_fit(seed):
    lengths = np.random.default_rng(seed).integers(1, 60, 300)
    sequence, _ = packing.place(lengths, (100.0, 300.0, 1e6), (1.0, 0.0, 0.0), "norm")
    assert len(set(sequence.tolist())) == best_fit_decreasing(lengths.tolist(), 100)


def test_op7(spark, sf, texts):
    got = rows(spark, sf, "op7_toxicity")
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    known = [(got[i].score, t) for i, t in labels.items() if i in got and t is not None]
    assert np.mean([s for s, t in known if t]) > 0.5 + np.mean([s for s, t in known if not t])


def test_op8(spark, sf, texts):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = rows(spark, sf, "op8_bpe")
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        r = got[i]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(library.decode(ids, skip_special_tokens=False)))


def test_op10(spark, sf, texts):
    got = rows(spark, sf, "op10_license_scan")
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        found = license_scan.scan(t)
        assert (got[i].n_licenses, got[i].spans) == (len(found), ",".join(f"{f['license']}:{f['start']}:{f['end']}" for f in found))


def test_every_license_is_found_wherever_it_stands():
    """All templates, whole or with a tenth of their plain words replaced, among prose; and prose alone."""
    rng = np.random.default_rng(10)
    prose = "the river runs past old mills where children sell copies of permission slips and software under a free bridge".split()
    told = lambda n: " ".join(prose[k] for k in rng.integers(0, len(prose), n))
    for name, templates in license_scan.TEMPLATES.items():
        for template in templates:
            words = template.split(" ")
            changed = list(words)
            plain = [k for k, w in enumerate(words) if w.isalpha() and w.islower() and len(w) > 3 and w not in license_scan.IDENTIFYING]
            for k in rng.permutation(plain)[: len(words) // 12]:
                changed[k] = "Xyzzy"
            for form in (words, changed):
                text = f"{told(40)}.\n{' '.join(form)}\n{told(40)}"
                assert [f["license"] for f in license_scan.scan(text)] == [name], text
    assert all(license_scan.scan(told(200)) == [] for _ in range(20))
    assert [f["license"] for f in license_scan.scan("Released under the MIT License.\nLicensed under CC BY 4.0.")] == ["MIT", "CC-BY-4.0"]
    assert license_scan.scan("copyright:\nLicensed widgets are sold under the table to CC clerks BY the dozen for 4.0 euros") == []
