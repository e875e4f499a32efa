"""Alignment of the tokens that two tokenizers make of one text, by diagonal run skipping.

Token ends are byte offsets, so both tokenizers' ends of a text can be compared.
Where tokens go one to one, the ends at the current index shift are equal: runs of
them are probed with doubling widths and jumped over. Where they don't, the two
sides step on to the next end they share, and the shift is what it then is. Texts
are cut at shared ends into stretches that go on side by side.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.bpe import byte_letters
from sparklogs.llm.common import table
from sparklogs.llm.packing import PATTERN
from sparklogs.shared import new_folder

#: Tokens of a stretch.
STRETCH = 256
#: Bytes of texts aligned at a time.
CHUNK = 1 << 20

_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For strictly increasing ends `a` and `b` with the same last one: which of them are in the other too."""
    in_a, in_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    if not len(a):
        return in_a, in_b
    # stretches: from one shared end to another
    at = np.arange(STRETCH - 1, len(a), STRETCH)
    there = np.searchsorted(b, a[at])
    shared = b[there] == a[at]
    stop_i, stop_j = np.append(at[shared] + 1, len(a)), np.append(there[shared] + 1, len(b))
    i, j = np.append(0, stop_i[:-1]), np.append(0, stop_j[:-1])
    probe = np.ones(len(i), np.int64)  # 0: inside an irregular group
    while True:
        on = i < stop_i
        if not on.all():
            i, j, stop_i, stop_j, probe = i[on], j[on], stop_i[on], stop_j[on], probe[on]
        if not len(i):
            return in_a, in_b
        run = np.flatnonzero(probe)
        if len(run):
            # a probe: how far the ends go on to be equal at the shift j - i
            width = np.minimum(probe[run], np.minimum(stop_i[run] - i[run], stop_j[run] - j[run]))
            begin = np.cumsum(width) - width
            step = np.arange(begin[-1] + width[-1]) - np.repeat(begin, width)
            here_a, here_b = np.repeat(i[run], width) + step, np.repeat(j[run], width) + step
            equal = a[here_a] == b[here_b]
            far = np.minimum.reduceat(np.where(equal, STRETCH * 4, step), begin)
            far = np.minimum(far, width)
            jumped = step < np.repeat(far, width)
            in_a[here_a[jumped]] = True
            in_b[here_b[jumped]] = True
            i[run] += far
            j[run] += far
            probe[run] = np.where(far == width, 2 * probe[run], 0)
        lost = np.flatnonzero((probe == 0) & (i < stop_i))
        if len(lost):
            # an irregular group: the side that is behind steps on
            x, y = a[i[lost]], b[j[lost]]
            met = lost[x == y]
            in_a[i[met]] = True
            in_b[j[met]] = True
            probe[met] = 1  # the shift is j - i from here on
            i[lost] += x <= y
            j[lost] += y <= x


def _labels(size: int, mark: str) -> np.ndarray:
    """Each id in decimal with a mark after it, padded with zero bytes."""
    return np.char.add(np.arange(size).astype("S"), mark.encode())


class Pair:
    """Two tokenizers as token ids and token bytes: A, a byte-level BPE file, takes a space and the text; B, a sentencepiece model, adds that space itself."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(of_letter[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.pieces = pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(pieces.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(t) for t in known], np.int64) for known in (self.bytes_a, self.bytes_b))
        self.inner_a, self.last_a = _labels(len(self.bytes_a), ","), _labels(len(self.bytes_a), "|")
        self.inner_b, self.last_b = _labels(len(self.bytes_b), ","), _labels(len(self.bytes_b), ";")

    def link_bound(self) -> int:
        """The most id pairs that can ever be linked: of two tokens that end together one is an end of the other."""
        return sum(map(len, self.bytes_a)) + sum(map(len, self.bytes_b))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and B of each text; none where the text is empty or a side doesn't give back a space and the text."""
        none = np.zeros(0, np.int64)
        side_a, side_b = [], []
        for text, ids in zip(texts, self.pieces.encode(texts, num_threads=1), strict=True):
            whole = (" " + text).encode()
            if not text or b"".join([self.bytes_b[i] for i in ids]) != whole:
                side_a.append(none)
                side_b.append(none)
                continue
            of_a = self.coder.encode_ordinary(" " + text)
            if b"".join([self.bytes_a[i] for i in of_a]) != whole:
                of_a = ids = none
            side_a.append(np.array(of_a, np.int64))
            side_b.append(np.array(ids, np.int64))
        return side_a, side_b

    def align(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]]:
        """For each text (ids of A, ids of B, linked ids of A, linked ids of B, groups as `a1,a2|b1;a3|b2,b3`)."""
        side_a, side_b = self.encode(texts)
        a, b = np.concatenate(side_a), np.concatenate(side_b)
        # one sequence of ends over all texts: each text ends where both sides do
        in_a, in_b = common_ends(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
        # tokens of A and B in turn, group by group
        before_a = np.cumsum(in_a) - in_a  # groups that end before each token
        before_b = np.cumsum(in_b) - in_b
        ends_a, ends_b = np.append(0, np.flatnonzero(in_a) + 1), np.append(0, np.flatnonzero(in_b) + 1)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + ends_b[before_a]] = np.arange(len(a))
        order[np.arange(len(b)) + ends_a[before_b + 1]] = len(a) + np.arange(len(b))
        told = np.concatenate([np.where(in_a, self.last_a[a], self.inner_a[a]), np.where(in_b, self.last_b[b], self.inner_b[b])])[order]
        out, i, j = [], 0, 0
        for x, y in zip(side_a, side_b, strict=True):
            of_a, of_b = slice(i, i + len(x)), slice(j, j + len(y))
            groups = told[i + j : i + j + len(x) + len(y)].tobytes().translate(None, b"\0")[:-1]
            out.append((x, y, x[in_a[of_a]], y[in_b[of_b]], groups))
            i, j = of_a.stop, of_b.stop
        return out


@lru_cache(maxsize=2)
def loaded(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _chunks(texts: list[str]):
    """Slices of a list with CHUNK characters in all, or one text."""
    start = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield slice(start, k)
            start, size = k, 0
        size += len(text)
    if texts:
        yield slice(start, len(texts))


def aligned_groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, groups): one row per row of `docs`; groups are an array of structs of the ids of A and of B that cover the same bytes.

    Null and empty texts have none, nor have texts that a tokenizer doesn't give
    back byte by byte. `path_a` and `path_b` are files that every executor has.
    """

    def each(batches):
        pair = loaded(path_a, path_b)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = []
            for part in _chunks(texts):
                for *_, groups in pair.align(texts[part]):
                    sides = [g.split(b"|") for g in groups.split(b";")] if groups else []
                    found.append([{"a": list(map(int, x.split(b","))), "b": list(map(int, y.split(b",")))} for x, y in sides])
            kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "groups"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(each, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


def _aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of `_ALIGNED` of `docs (doc_id, text)`; pairs are distinct linked ids (A * 2^32 + B), times how often each is linked."""

    def each(batches):
        pair = loaded(path_a, path_b)
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for part in _chunks(texts):
                rows = []
                for x, y, link_a, link_b, groups in pair.align(texts[part]):
                    pairs, times = np.unique(link_a << 32 | link_b, return_counts=True)
                    rows.append((len(x), len(y), len(link_a), len(link_a), hashlib.sha256(groups).hexdigest() if groups else "", pairs.tobytes(), times.astype(np.int32).tobytes()))
                cols = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), [*[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()], strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(part.start, part.stop - part.start), *cols], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return docs.mapInArrow(each, _ALIGNED)


def _counted(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many links of all documents hold a pair, a sum in each task first."""

    def each(batches):
        pairs, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            got = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64)
            n = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32)
            pairs, place = np.unique(np.concatenate([pairs, got]), return_inverse=True)
            sums = np.bincount(place, np.concatenate([sums, n]), len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(sums)], ["pair", "n"])

    return aligned.select("pairs", "times").mapInArrow(each, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, n): in how many links of all documents ids of A and B are linked, those whose tokens end at the same byte."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    low = F.lit((1 << 32) - 1)
    return _counted(_aligned(rows, path_a, path_b)).select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(low).alias("b"), "n")


def alignment_report(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row per row of `docs`.

    A link is two tokens of A and B that end at the same byte; its count is that of
    its id pair over all documents. `n_best`: links whose count is the highest of
    their B id, ties included; `count_sum`: the counts of all links. Null and empty
    texts, and such as a tokenizer doesn't give back byte by byte, have no tokens:
    zeros and an empty digest. Ids may be null or repeat: every row counts. Other
    columns are not read; an empty table gives an empty result; texts of any length
    are aligned whole.

    What texts give is written below the shared folder once, then read for the
    counts and for the report. The counts come to the driver and go to all tasks:
    they are bounded by the vocabularies, not by the documents, as of two tokens
    that end together one is an end of the other (`Pair.link_bound`, some 440,000
    pairs or 7 MB for the registered tokenizers).
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "aligned")
    _aligned(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), path_a, path_b).write.parquet(folder)
    aligned = spark.read.schema(_ALIGNED).parquet(folder)
    counts = _counted(aligned).toArrow()
    pairs, n = counts["pair"].to_numpy(), counts["n"].to_numpy()
    if len(pairs) > loaded(path_a, path_b).link_bound():
        raise ValueError("more linked pairs than the vocabularies allow")
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    of_b = pairs & ((1 << 32) - 1)
    highest = np.zeros(int(of_b.max()) + 1 if len(of_b) else 1, np.int64)
    np.maximum.at(highest, of_b, n)
    known = spark.sparkContext.broadcast((pairs, n, n == highest[of_b]))

    def each(batches):
        pairs, n, best = known.value
        for batch in batches:
            got, times = (np.frombuffer(b"".join(batch.column(c).to_pylist()), kind).astype(np.int64) for c, kind in ((6, np.int64), (7, np.int32)))
            sizes = np.array([len(p) // 8 for p in batch.column(6).to_pylist()], np.int64)
            at = np.searchsorted(pairs, got)
            cut = np.append(0, np.cumsum(sizes))
            total = lambda x: np.diff(np.append(0, np.cumsum(x))[cut])
            cols = [pa.array(total(times * best[at])), pa.array(total(times * n[at]))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *cols, batch.column(5)], [*batch.schema.names[:5], "n_best", "count_sum", "groups_sha256"])

    return aligned.mapInArrow(each, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
