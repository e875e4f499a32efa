"""Vector best-fit packing of tokenised documents into training sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of
squared lengths). Pieces are dealt at random into shards of a bounded size; in a
shard they are placed longest first, each into the open sequence that fits it
under every constraint and is best by residual norm or weighted dot product.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.bpe import byte_letters
from sparklogs.llm.common import checkpoint, table

CAPACITY = 2048
#: Pieces in a shard, on average: what one task packs at a time.
SHARD = 4096
#: The token that ends a document.
END = 0
#: Fixed value: how the tokenizer splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def encoder(path: str):
    """(function from text to ids) of a byte-level BPE file in which a token's id is its merge rank; special tokens are matched in texts."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    of_letter = {c: b for b, c in enumerate(byte_letters())}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(of_letter[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    marks = set(special)

    def encode(text: str) -> list[int]:
        if any(m in text for m in marks):
            return coder.encode(text, allowed_special=marks)
        return coder.encode_ordinary(text)

    return encode


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `total` tokens: full ones, but for the first, which takes what is left over."""
    first = total - (-(-total // capacity) - 1) * capacity
    return [(0, first), *((at, capacity) for at in range(first, total, capacity))]


def tokenised_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): documents as token pieces of at most `capacity`.

    A document is its ids and then END, so that null and empty texts have one
    token. Only documents longer than `capacity` are cut; their first piece may be
    shorter. `ids` are little-endian unsigned 32-bit integers. Ids may be null or
    repeat; other columns of `docs` are not read.
    """

    def each(batches):
        encode = encoder(path)
        for batch in batches:
            doc, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = np.array([*(encode(text) if text else ()), END], "<u4")
                for k, (at, n) in enumerate(cut(len(tokens), capacity)):
                    raw = tokens[at : at + n].tobytes()
                    doc.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(raw))
                    if with_ids:
                        ids.append(raw)
            cols = {"doc_id": pa.array(doc, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                cols["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(cols)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(each, PIECES + (", ids binary" if with_ids else ""))


def place(lengths: np.ndarray, capacities: tuple[float, float, float], weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece: longest first, into the best sequence that fits under every capacity, or a new one.

    rule "norm": the least weighted norm of what stays free; "dot": the largest
    weighted dot product of the piece and what is free. A piece above a capacity
    gets a sequence of its own.
    """
    cap = np.array(capacities, float)
    need = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2], 1)
    free = np.zeros((len(lengths) + 1, 3))  # of the open sequences, the first `opened` rows
    name = np.zeros(len(lengths) + 1, np.int64)
    used: list[int] = []
    scale = np.array(weights, float) / cap**2
    shortest = need.min(axis=0) if len(need) else need
    out, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened = 0
    for i in np.argsort(-lengths, kind="stable"):
        want, room = need[i], free[:opened]
        fits = np.flatnonzero((room >= want).all(axis=1))
        if len(fits):
            if rule == "norm":
                best = fits[np.argmin((scale * (room[fits] - want) ** 2).sum(axis=1))]
            else:
                best = fits[np.argmax((scale * room[fits] * want).sum(axis=1))]
        else:
            best, opened = opened, opened + 1
            free[best], name[best] = cap, len(used)
            used.append(0)
        out[i], offset[i] = name[best], used[name[best]]
        used[name[best]] += int(lengths[i])
        free[best] -= want
        if (free[best] < shortest).any():  # nothing fits any more: the last open one takes its row
            opened -= 1
            free[best], name[best] = free[opened], name[opened]
    return out, offset


def best_fit(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    max_docs: int | None = None,
    max_attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    rule: str = "norm",
    shard: int = SHARD,
) -> DataFrame:
    """`pieces` (with a column `length`) and (sequence_id, offset): gapless places in sequences.

    By default neither documents nor attention cost bind, and the fewest sequences
    come out. Shards are dealt by row, not by key, so that equal or repeated rows
    spread evenly; at most one sequence or so a shard stays half empty. An empty
    table gives an empty result. A column named sequence_id or offset is replaced.
    """
    caps = (float(capacity), float(max_docs or capacity), float(max_attention or capacity * capacity))
    pieces = checkpoint(pieces.drop("sequence_id", "offset"))
    shards = max(1, round(pieces.count() / shard))
    name = next(n for n in (f"_shard{k}" for k in range(len(pieces.columns) + 1)) if n not in pieces.columns)
    dealt = pieces.withColumn(name, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def pack(key, group):
        sequence, offset = place(group["length"].to_numpy(), caps, weights, rule)
        numbered = pa.array(sequence + (key[0].as_py() << 32))
        return group.drop_columns([name]).append_column("sequence_id", numbered).append_column("offset", pa.array(offset))

    return dealt.groupBy(name).applyInArrow(pack, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit(tokenised_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
