"""Ranked lexical search by pipelined term partitioning.

Terms are dealt to owners, rare terms to the first. The postings of an owner are
split by blocks of documents, so that no frequent term is in one place. Bundles,
one for each item and block, carry sparse accumulators (documents and their scores
so far) from owner to owner; at each stage they meet the owner's postings of their
block and take up its contributions. A document that can't be among the best of
its block any more, whatever the later owners add, leaves its bundle.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparklogs.llm.common import table
from sparklogs.shared import new_folder

#: Owners of terms, and so stages of a search.
OWNERS = 4
#: Documents of a block; a block also ends when it holds so many postings.
BLOCK_DOCS, BLOCK_POSTINGS = 1024, 1 << 20
#: Bytes of item texts that are searched for together: what every task knows of the items.
ITEM_BYTES = 4 << 20
TOP = 10

#: Fixed value: bytes that end a term are blanks, A-Z are lower-cased; bytes of other characters than ASCII are parts of terms.
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(128)).lower() + bytes(range(128, 256))

_BLOCK = "block long, ids binary, nulls binary, sizes binary, terms binary, docs binary, times binary"
_PART = "block long, ids binary, nulls binary, sizes binary, terms binary, docs binary, times binary"
_BUNDLE = "block long, item int, docs binary, scores binary"
_FOUND = "item int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: the longest runs of letters and digits, A-Z lower-cased; every other character beyond ASCII counts as a letter."""
    return text.translate(_FOLD).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def contribution(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's occurrences count for in a document of length factor m, before its weight."""
    return 1_000_000_000 * times // (1000 * times + 8 * m)


def _blocks(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """Inverted blocks of `docs (doc_id, text)`: postings of the terms in `vocab`, sorted by term, over documents that have any terms at all."""

    def pack(block, ids, sizes, terms, docs, times):
        terms, docs, times = (np.concatenate(x).astype(kind) for x, kind in ((terms, np.int32), (docs, np.int32), (times, np.int32)))
        order = np.argsort(terms, kind="stable")
        none = np.array([i is None for i in ids])
        known = np.array([0 if i is None else i for i in ids], np.int64)
        return {"block": block, "ids": known.tobytes(), "nulls": none.tobytes(), "sizes": np.array(sizes, np.int64).tobytes(), "terms": terms[order].tobytes(), "docs": docs[order].tobytes(), "times": times[order].tobytes()}

    names = [c.split()[0] for c in _BLOCK.split(", ")]
    schema = pa.schema([(n, pa.int64() if n == "block" else pa.binary()) for n in names])

    def each(batches):
        number = TaskContext.get().partitionId() << 32
        ids, sizes, terms, docs, times, held = [], [], [], [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms_of(text or b"")
                if not words:
                    continue
                found = Counter(filter(None.__ne__, map(vocab.get, words)))
                terms.append(np.fromiter(found.keys(), np.int32, len(found)))
                times.append(np.fromiter(found.values(), np.int32, len(found)))
                docs.append(np.full(len(found), len(ids), np.int32))
                ids.append(i)
                sizes.append(len(words))
                held += len(found)
                if len(ids) == BLOCK_DOCS or held >= BLOCK_POSTINGS:
                    yield pa.RecordBatch.from_pylist([pack(number, ids, sizes, terms, docs, times)], schema)
                    ids, sizes, terms, docs, times, held = [], [], [], [], [], 0
                    number += 1
        if ids:
            yield pa.RecordBatch.from_pylist([pack(number, ids, sizes, terms, docs, times)], schema)

    return docs.mapInArrow(each, _BLOCK)


def _statistics(blocks: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents with terms, their terms in all, document frequency of each term of the vocabulary): a sum in each task first."""

    def each(batches):
        sums = np.zeros(size + 2, np.int64)
        for batch in batches:
            for sizes, terms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sizes = np.frombuffer(sizes, np.int64)
                sums[size] += len(sizes)
                sums[size + 1] += sizes.sum()
                sums[:size] += np.bincount(np.frombuffer(terms, np.int32), minlength=size)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["what", "n"])

    got = blocks.select("sizes", "terms").mapInArrow(each, "what long, n long").groupBy("what").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(size + 2, np.int64)
    sums[got["what"].to_numpy()] = got["n"].to_numpy()
    return int(sums[size]), int(sums[size + 1]), sums[:size]


def _owners(df: np.ndarray) -> np.ndarray:
    """The owner of each term: by document frequency, rare terms first, so that owners have about equal shares of the postings."""
    owner = np.zeros(len(df), np.int64)
    order = np.argsort(df, kind="stable")
    total = max(1, int(df.sum()))
    owner[order] = np.minimum(OWNERS - 1, (np.cumsum(df[order]) - df[order]) * OWNERS // total)
    return owner


def _part(blocks: DataFrame, owner: np.ndarray, k: int) -> DataFrame:
    """Owner k's postings, a row a block."""

    def each(batches):
        for batch in batches:
            cols = batch.columns
            for i in range(batch.num_rows):
                terms = np.frombuffer(cols[4][i].as_py(), np.int32)
                mine = owner[terms] == k
                if not mine.any() and k < OWNERS - 1:
                    continue
                parts = [terms, *(np.frombuffer(cols[c][i].as_py(), np.int32) for c in (5, 6))]
                yield pa.RecordBatch.from_arrays([*(c.slice(i, 1) for c in cols[:4]), *(pa.array([p[mine].tobytes()], pa.binary()) for p in parts)], batch.schema.names)

    return blocks.mapInArrow(each, _PART)


class _Search:
    """What a stage needs of the items: their terms and weights, and what later owners can still add."""

    def __init__(self, items: list[Counter], weights: np.ndarray, owner: np.ndarray, n: int, total: int, top: int):
        self.n, self.total, self.top = n, max(1, total), top
        self.terms, self.rest = [], []
        # no document gets more from one term than its weight times this
        most = int(contribution(np.int64(1 << 31), np.int64(25)))
        for item in items:
            terms = np.fromiter(item.keys(), np.int64, len(item))
            factor = np.fromiter(item.values(), np.int64, len(item)) * weights[terms]
            self.terms.append([(terms[owner[terms] == k], factor[owner[terms] == k]) for k in range(OWNERS)])
            self.rest.append([int(factor[owner[terms] > k].sum()) * most for k in range(OWNERS)])

    def length_factor(self, sizes: np.ndarray) -> np.ndarray:
        return 25 + 75 * sizes * self.n // self.total

    def stage(self, k: int, held: dict[int, tuple[np.ndarray, np.ndarray]], part: dict | None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """(documents, scores) of each item after owner k."""
        if part is None:
            return held
        terms, docs = part["terms"], part["docs"]
        counts = contribution(part["times"].astype(np.int64), self.length_factor(part["sizes"])[docs])
        known, start = np.unique(terms, return_index=True)
        bounds = np.append(start, len(terms))
        out = {}
        score = np.zeros(len(part["sizes"]), np.int64)
        for item, by_owner in enumerate(self.terms):
            mine, factor = by_owner[k]
            at = np.minimum(np.searchsorted(known, mine), max(0, len(known) - 1))
            there = known[at] == mine if len(known) else np.zeros(len(mine), bool)
            if not there.any() and item not in held:
                continue
            score[:] = 0
            if item in held:
                score[held[item][0]] = held[item][1]
            for i, f in zip(at[there].tolist(), factor[there].tolist(), strict=True):
                span = slice(bounds[i], bounds[i + 1])
                score[docs[span]] += f * counts[span]
            got = np.flatnonzero(score)
            if len(got) > self.top:
                tenth = np.partition(score[got], -self.top)[-self.top]
                got = got[score[got] + self.rest[item][k] >= tenth]
            out[item] = (got, score[got])
        return out


def _staged(search: _Search, k: int, bundles: DataFrame, part: DataFrame) -> DataFrame:
    """Bundles after owner k; after the last owner, the best of each block instead, as `_FOUND`."""
    last = k == OWNERS - 1

    def meet(bundles: pa.Table, part: pa.Table) -> pa.Table:
        held = {i: (np.frombuffer(d, np.int32), np.frombuffer(s, np.int64)) for i, d, s in zip(*(bundles[c].to_pylist() for c in ("item", "docs", "scores")), strict=True)}
        arrays = None
        if part.num_rows:
            kinds = {"ids": np.int64, "nulls": bool, "sizes": np.int64, "terms": np.int32, "docs": np.int32, "times": np.int32}
            arrays = {c: np.frombuffer(part[c][0].as_py(), kind) for c, kind in kinds.items()}
        after = search.stage(k, held, arrays)
        if not last:
            block = (bundles if bundles.num_rows else part)["block"][0].as_py()
            rows = [(block, i, d.astype(np.int32).tobytes(), s.tobytes()) for i, (d, s) in after.items() if len(d)]
            kinds = [("block", pa.int64()), ("item", pa.int32()), ("docs", pa.binary()), ("scores", pa.binary())]
            return pa.table([pa.array([r[c] for r in rows], kind) for c, (_, kind) in enumerate(kinds)], pa.schema(kinds))
        items, ids, scores = [], [], []
        for i, (d, s) in after.items():
            best = np.lexsort((arrays["ids"][d], arrays["nulls"][d], -s))[: search.top]
            items += [i] * len(best)
            ids += [None if none else x for x, none in zip(arrays["ids"][d[best]].tolist(), arrays["nulls"][d[best]].tolist(), strict=True)]
            scores += s[best].tolist()
        return pa.table({"item": pa.array(items, pa.int32()), "doc_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.int64())})

    return bundles.groupBy("block").cogroup(part.groupBy("block")).applyInArrow(meet, _FOUND if last else _BUNDLE)


def lexical_search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of `items` the `top` rows of `docs` with the highest scores above 0.

    Terms, weights and scores are whole numbers: see `terms_of`, `weight`,
    `contribution` and the README. Equal scores go by id, null ids last. Rows are
    what is counted: documents or items with equal ids, or none, are rows of their
    own. Null and empty texts have no terms: such documents are never found, such
    items find nothing, and empty tables give an empty result. Other columns are not
    read; texts of any length are read whole.

    Items are searched for in lots of about `ITEM_BYTES` of text, so that what tasks
    know of them is bounded; for each lot the documents are read once, and their
    postings of the lot's terms written below the shared folder.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("binary").alias("text")).where("text IS NOT NULL")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lots = -(-size // ITEM_BYTES)
    kept = new_folder(spark, "items")
    asked.withColumn("lot", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, lots))).cast("int")).write.parquet(kept)
    out = spark.createDataFrame([], f"item_id {items.schema[item_col].dataType.simpleString()}, rank int, doc_id long, score long")
    for lot in range(lots):
        mine = spark.read.parquet(kept).where(F.col("lot") == lot).select("item_id", "text").collect()
        out = out.unionByName(_searched(rows, mine, items.schema[item_col], top)) if lots > 1 else _searched(rows, mine, items.schema[item_col], top)
    return out


def _searched(rows: DataFrame, asked: list, item_field, top: int) -> DataFrame:
    spark = rows.sparkSession
    texts = [Counter(terms_of(bytes(r["text"]))) for r in asked]
    vocab = {t: i for i, t in enumerate(sorted({t for c in texts for t in c}))}
    items = [Counter({vocab[t]: n for t, n in c.items()}) for c in texts]
    folder = new_folder(spark, "postings")
    _blocks(rows, vocab).write.parquet(folder)
    blocks = spark.read.schema(_BLOCK).parquet(folder)
    n, total, df = _statistics(blocks, len(vocab))
    owner = _owners(df)
    search = _Search(items, np.array([weight(n, int(d)) for d in df], np.int64), owner, n, total, top)
    bundles = spark.createDataFrame([], _BUNDLE)
    for k in range(OWNERS):
        bundles = _staged(search, k, bundles, _part(blocks, owner, k))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = bundles.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(asked)], f"item int, item_id {item_field.dataType.simpleString()}")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = rf"""
WITH d AS (SELECT doc_id, {_TERMS_SQL} AS terms FROM documents),
     c AS (SELECT count(*) AS all_docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM d WHERE len(terms) > 0),
     q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY 1, 2),
     p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3),
     w AS (SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), c),
     s AS (SELECT item_id, doc_id, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * all_docs) // all_terms))))) AS BIGINT) AS score
           FROM p JOIN w USING (term) JOIN q USING (term), c GROUP BY 1, 2),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
