"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks.

Normalised vectors are projected on Gaussian directions, shifted and cut into
cells; several cells together are a bucket, in several tables. Vectors that share
a bucket (and a label and a dimension) are compared exactly, in blocks. A pair is
counted in the first table in which it meets, so counts need no list of pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.common import checkpoint, components, partitions, table

MIN_COSINE = 0.98
#: Unit vectors at cosine 0.98 are 0.2 apart and share a cell of WIDTH with probability 0.84, a bucket with 0.84 ** CELLS;
#: all TABLES miss such a pair once in 200,000 times, closer ones more seldom. Unrelated vectors share a bucket with 2e-6.
WIDTH, CELLS, TABLES = 1.0, 10, 64
SEED = 20240229
#: Vectors of one bucket that are compared with another such block at a time.
BLOCK = 512

_HASHED = "cid long, keys array<int>"
_FOUND = "cid long, id long, root long, links long"


def _usable(vector: Column) -> Column:
    """Not null, not zero, no null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _planes(dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions, shifts and mixing factors; the same for the same dimension everywhere."""
    rng = np.random.default_rng([SEED, dim])
    return rng.standard_normal((dim, TABLES * CELLS)), rng.uniform(0, WIDTH, TABLES * CELLS), rng.integers(0, 1 << 63, CELLS, np.uint64) * np.uint64(2) + np.uint64(1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled to length 1; first by their largest component, so that no square leaves the range of doubles."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def bucket_keys(vectors: np.ndarray) -> np.ndarray:
    """(rows, TABLES) 32-bit bucket keys of vectors, which are scaled to length 1 first."""
    planes, shift, mix = _planes(vectors.shape[1])
    cells = np.floor((_unit(vectors) @ planes + shift) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(vectors), TABLES, CELLS)
    mixed = (cells * mix).sum(axis=2, dtype=np.uint64)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _hash(batches):
    for batch in batches:
        vectors, cid = batch.column(1), batch.column(0).to_numpy()
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        flat, ends = vectors.flatten().to_numpy(zero_copy_only=False).astype(float), np.cumsum(sizes)
        for dim in np.unique(sizes):
            rows = np.flatnonzero(sizes == dim)
            keys = bucket_keys(flat[(ends[rows] - dim)[:, None] + np.arange(dim)])
            yield pa.RecordBatch.from_arrays([pa.array(cid[rows]), pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), TABLES).cast(pa.list_(pa.int32()))], ["cid", "keys"])


def _compare(rows: dict[str, np.ndarray], vectors: np.ndarray, keys: np.ndarray, min_cosine: float) -> dict[str, np.ndarray] | None:
    """Links of one pair of blocks: for each linked class, its local root and how many vectors it links to."""
    unit = _unit(vectors)
    t = int(rows["tab"][0])
    i, j = np.nonzero(np.triu(unit @ unit.T >= min_cosine, 1))
    a, b = rows["blk"][i], rows["blk"][j]
    lo, hi = rows["lo"][i], rows["hi"][i]
    right = np.where(lo == hi, True, a != b) & (rows["cid"][i] != rows["cid"][j])
    right &= (rows["tab"][i] == t) & (rows["tab"][j] == t) & (rows["label"][i] == rows["label"][j]) & (keys[i, t] == keys[j, t])
    i, j = i[right], j[right]
    new = np.arange(len(i))
    for before in range(t):
        if not len(new):
            break
        new = new[keys[i[new], before] != keys[j[new], before]]
    i, j = i[new], j[new]
    if not len(i):
        return None
    links = np.bincount(i, rows["n"][j], len(unit)) + np.bincount(j, rows["n"][i], len(unit))
    root = rows["id"].copy()
    while True:  # smallest id along the links
        low = np.minimum(root[i], root[j])
        if (low == root[i]).all() and (low == root[j]).all():
            break
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
    hit = np.flatnonzero(links)
    return {"cid": rows["cid"][hit], "id": rows["id"][hit], "root": root[hit], "links": links[hit].astype(np.int64)}


def _blocks(min_cosine: float):
    """Streams rows sorted by `pair`; the rows of one pair of blocks are at most a few times BLOCK."""

    def run(batches):
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            rows = rows.combine_chunks()
            pair = rows["pair"].to_numpy()
            cut = np.flatnonzero(pair[1:] != pair[:-1]) + 1
            last = int(cut[-1]) if len(cut) else 0
            kept = rows.slice(last)
            yield from found(rows.slice(0, last), min_cosine)
        if kept is not None:
            yield from found(kept, min_cosine)

    def found(rows: pa.Table, min_cosine: float):
        if not len(rows):
            return
        rows = rows.combine_chunks()
        cols = {c: rows[c].to_numpy() for c in ("pair", "cid", "id", "n", "label", "tab", "blk", "lo", "hi")}
        vectors, keys = rows["vector"].combine_chunks(), rows["keys"].combine_chunks()
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        flat, ends = vectors.flatten().to_numpy(zero_copy_only=False).astype(float), np.cumsum(sizes)
        keys = keys.flatten().to_numpy(zero_copy_only=False).reshape(-1, TABLES)
        edge = np.flatnonzero(np.append(True, cols["pair"][1:] != cols["pair"][:-1]))
        out = []
        for s, e in zip(edge, [*edge[1:], len(sizes)], strict=True):
            for dim in np.unique(sizes[s:e]):
                at = s + np.flatnonzero(sizes[s:e] == dim)
                if len(at) > 1:
                    got = _compare({c: v[at] for c, v in cols.items()}, flat[(ends[at] - dim)[:, None] + np.arange(dim)], keys[at], min_cosine)
                    if got:
                        out.append(got)
        if out:
            yield pa.RecordBatch.from_pydict({c: pa.array(np.concatenate([o[c] for o in out])) for c in out[0]})

    return run


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of `vectors`.

    Rows link when their labels are equal and not null, their dimensions are equal
    and the cosine is `min_cosine` or more. Vectors that are null, zero or hold null
    or non-finite components, and rows with a null id or label, link with nothing:
    n_links 0, component_id their own id. Equal vectors of a label are one class
    and are compared once, however many there are. Rows that share an id are one
    node of the links. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vector"))
    usable = _usable(F.col("vector")) & F.col("id").isNotNull() & F.col("label").isNotNull()
    rows = checkpoint(rows.withColumn("digest", F.when(usable, F.md5(F.col("vector").cast("string").cast("binary")))))
    good = rows.where("digest IS NOT NULL")
    classes = good.groupBy("label", "digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min_by("vector", "id").alias("vector"))
    classes = checkpoint(checkpoint(classes).withColumn("cid", F.monotonically_increasing_id()))
    hashed = checkpoint(classes.select("cid", "vector").mapInArrow(_hash, _HASHED))
    named = classes.select("cid", F.xxhash64("label").alias("label"), F.size("vector").alias("dim"))
    spots = hashed.join(named, "cid").select("cid", "label", F.posexplode("keys").alias("tab", "key"), "dim")
    spots = checkpoint(spots.select("cid", "tab", F.xxhash64("label", "dim", "tab", "key").alias("bucket")))
    full = checkpoint(spots.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    spots = spots.join(full, "bucket").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    spots = spots.withColumn("blk", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    spots = spots.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spots = spots.select("cid", "tab", "blk", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "bucket")
    spots = spots.withColumn("pair", F.xxhash64("bucket", "lo", "hi")).drop("bucket")
    data = classes.select("cid", F.col("rep").alias("id"), "n", F.xxhash64("label").alias("label"), "vector").join(hashed, "cid")
    met = spots.join(data, "cid").select("pair", "cid", "id", "n", "label", "tab", "blk", "lo", "hi", "vector", "keys")
    met = met.repartition(partitions(vectors.sparkSession), "pair").sortWithinPartitions("pair")
    found = checkpoint(met.mapInArrow(_blocks(min_cosine), _FOUND))
    linked = checkpoint(found.groupBy("cid").agg(F.sum("links").alias("links")))
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).distinct())
    classes = classes.select("label", "digest", "rep", "n", "cid").join(linked, "cid", "left").join(joined, F.col("rep") == joined["id"], "left")
    classes = checkpoint(classes.select("label", "digest", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component")))
    out = rows.select("id", "label", "digest").join(classes, ["label", "digest"], "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                     WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                       AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
               WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
     walk AS (SELECT a, a AS b FROM links UNION SELECT w.a, l.b FROM walk w JOIN links l ON w.b = l.a),
     low AS (SELECT a, min(b) AS component_id FROM walk GROUP BY a),
     cnt AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN low ON low.a = vec_id LEFT JOIN cnt ON cnt.a = vec_id
"""
