"""Self join of documents by the Jaccard coefficient of their word shingles, with signature trees.

Sets that can reach the threshold share a shingle among their first ones in any
common order of shingles, so documents meet in one bucket for each such shingle;
the order puts common shingles last, which keeps buckets small. The members of a
bucket form a tree whose nodes hold OR-combined bitmaps and size ranges. A dual
traversal drops pairs of nodes whose largest possible overlap is too small, or
that are linked already; pairs of sets that are left are intersected exactly.

First each set that shares much with a bucket goes through the trees of that one,
which joins families of near copies. Buckets whose members then are in one group
are done. In the others, trees over the shared shingles alone find the pairs of
different groups that meet and how often; pairs that meet often enough in all are
intersected. A bucket of many members is cut into blocks: one member of each group
of a block goes on to trees of the next round, and what then is in several groups
is compared across blocks whose size ranges allow a link and which aren't one and
the same group.
"""

from __future__ import annotations

import hashlib
import secrets
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.common import checkpoint, components, free, likely_rows, partitions, table
from sparklogs.llm.shingles import shingle_sets

#: Per cent of the union that the intersection must reach, and words in a shingle.
PERCENT, WIDTH = 80, 5
#: First shingles that linked sets share at least: so many, or one in SHARE of a set (fewer only if a set needs fewer for a link).
SHARED, SHARE = 8, 8
#: Common shingles known by name, at most 8 MB of them: the order is as good without the rest, and right with any choice of them.
COMMON, COMMON_FROM, COMMON_IN_BATCH = 1 << 19, 16, 3
#: Shingles of a task among which common ones are counted at a time.
COMMON_SPAN = 4_000_000
#: Members of a tree; fan-out; bits for a shingle, least and most bits of a bitmap.
BLOCK, FANOUT, BITS = 256, 8, (8, 512, 1 << 16)
#: Postings of a common shingle that share a bucket of the shuffle, and postings of a bucket, about.
_SPREAD, _POSTINGS = 2048, 4_000_000

_DOC_ROWS = "id long, n long, node binary, count long"
_BLOBS = "bucket int, payload binary"
_NODE = "V16"


def shared_at_least(n: int, percent: int) -> int:
    """How many of its first shingles a set of n shares with a partner that isn't smaller."""
    return min(max(SHARED, n // SHARE), (percent * n + 99) // 100)


def first_shingles(n: int, percent: int) -> int:
    """How many shingles of a set of n, in the common order, are sure to hold `shared_at_least` of any such partner's.

    A partner has percent / 100 * n of them or more, so at most the rest of them come
    before the first shared one, and so on.
    """
    return n - (percent * n + 99) // 100 + shared_at_least(n, percent)


def _node(shingles: np.ndarray) -> bytes:
    """The name of a set, 128 bits."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


@dataclass(frozen=True)
class Shingling:
    """Words of a shingle, and the key of its hashes, the same in all tasks of a run."""

    width: int
    key: bytes

    def sets(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        return shingle_sets([t.as_py() for t in batch.column(1).cast(pa.binary())], self.width, self.key)


def document_sets(docs: DataFrame, how: Shingling) -> DataFrame:
    """(id, n, node, count): size and name of each set; and, with n = -1, (id = shingle, count) of shingles that are common within a part of a task."""

    def often(sets: list[np.ndarray]) -> pa.RecordBatch:
        everything = np.sort(np.concatenate(sets))
        at = np.flatnonzero(np.append(True, everything[1:] != everything[:-1])) if len(everything) else np.zeros(0, int)
        count = np.diff(np.append(at, len(everything)))
        keep = count >= COMMON_IN_BATCH
        k = int(keep.sum())
        return pa.RecordBatch.from_arrays([pa.array(everything[at[keep]].view(np.int64)), pa.array(np.full(k, -1)), pa.nulls(k, pa.binary()), pa.array(count[keep])], ["id", "n", "node", "count"])

    def each(batches):
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            sets = how.sets(batch)
            n = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.array([_node(s) if len(s) else None for s in sets], pa.binary()), pa.nulls(len(sets), pa.int64())], ["id", "n", "node", "count"])
            held += sets
            size += sum(map(len, sets))
            if size >= COMMON_SPAN:
                yield often(held)
                held, size = [], 0
        if held:
            yield often(held)

    return docs.mapInArrow(each, _DOC_ROWS)


def common_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, counts) of the most common ones, at most COMMON, by shingle."""
    top = rows.where("n = -1").groupBy("id").agg(F.sum("count").alias("df")).where(F.col("df") >= COMMON_FROM)
    got = top.orderBy(F.desc("df"), "id").limit(COMMON).toArrow()
    names, df = got["id"].to_numpy().view(np.uint64), got["df"].to_numpy()
    order = np.argsort(names)
    return names[order], df[order]


def _width(n: int) -> int:
    """Bits of the bitmap of n shingles."""
    return min(max(1 << (BITS[0] * n - 1).bit_length(), BITS[1]), BITS[2])


def bitmap(shingles: np.ndarray) -> bytes:
    bits = _width(len(shingles))
    out = np.zeros(bits, np.uint8)
    out[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def postings(docs: DataFrame, how: Shingling, percent: int, common: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """First shingles of every distinct set of a batch, packed by bucket."""
    names, df = common

    def each(batches):
        for batch in batches:
            sets = {_node(s): s for s in how.sets(batch) if len(s)}
            firsts, owner, salts = [], [], []
            for k, s in enumerate(sets.values()):
                want = first_shingles(len(s), percent)
                at = np.minimum(np.searchsorted(names, s), max(len(names) - 1, 0))
                often = names[at] == s if len(names) else np.zeros(len(s), bool)
                got, salt = s[~often][:want], 0
                if len(got) < want:
                    at = at[often]
                    at = at[np.lexsort((names[at], df[at]))][: want - len(got)]
                    salt = -(-df[at] // _SPREAD)  # very common shingles are spread over several buckets
                    got = np.concatenate([got, names[at]])
                firsts.append(got)
                salts.append(np.concatenate([np.zeros(len(got) - np.size(salt), np.int64), salt]) if np.size(salt) > 1 or np.any(salt) else np.zeros(len(got), np.int64))
                owner.append(np.full(len(got), k, np.uint32))
            if not sets:
                continue
            node = np.frombuffer(b"".join(sets), _NODE)
            turn = np.frombuffer(b"".join(sets), np.uint64)[::2]
            flat, own, salt = np.concatenate(firsts), np.concatenate(owner), np.concatenate(salts)
            move = np.where(salt > 1, (turn[own] % np.maximum(salt, 1).astype(np.uint64)).astype(np.int64) + 1, 0)
            bucket = ((flat >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            bucket = (bucket + move * 7919) % buckets
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            which, load = [], []
            for b in np.flatnonzero(np.diff(cut)):
                at = order[cut[b] : cut[b + 1]]
                which.append(b)
                load.append(np.int64(len(at)).tobytes() + flat[at].tobytes() + node[own[at]].tobytes() + (salt[at] > 0).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(load, pa.binary())], ["bucket", "payload"])

    return docs.mapInArrow(each, _BLOBS)


def _unpack(batches):
    """Shingles of a bucket that more than one set has, or that are common: (token, node)."""
    flat, node, often = [], [], []
    for batch in batches:
        for load in batch.column(1).to_pylist():
            n = int(np.frombuffer(load, np.int64, 1)[0])
            flat.append(np.frombuffer(load, np.uint64, n, 8))
            node.append(np.frombuffer(load, np.uint64, 2 * n, 8 + 8 * n).reshape(-1, 2))
            often.append(np.frombuffer(load, bool, n, 8 + 24 * n))
    if flat:
        flat, node, often = np.concatenate(flat), np.concatenate(node), np.concatenate(often)
        order = np.lexsort((node[:, 1], node[:, 0], flat))
        flat, node, often = flat[order], node[order], often[order]
        new = np.append(True, (flat[1:] != flat[:-1]) | (node[1:] != node[:-1]).any(axis=1))
        flat, node, often = flat[new], node[new], often[new]
        same = np.append(flat[1:] == flat[:-1], False)
        keep = same | np.append(False, same[:-1]) | often
        for at in np.array_split(np.flatnonzero(keep), max(1, int(keep.sum()) // 50_000)):
            names = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(at), [None, pa.py_buffer(node[at].tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(flat[at].view(np.int64)), names.cast(pa.binary())], ["token", "node"])


class _Branch:
    """A node of a signature tree: OR of its bitmaps, sizes from and to, largest excess of shingles over bits, the one group it is known to belong to or None."""

    __slots__ = ("bits", "excess", "few", "group", "many", "parts")

    def __init__(self, parts, bits, few, many, excess, group):
        self.parts, self.bits, self.few, self.many, self.excess, self.group = parts, bits, few, many, excess, group


def _tree(leaves: list[_Branch]) -> _Branch:
    level = leaves
    while len(level) > 1:
        above = []
        for i in range(0, len(level), FANOUT):
            parts = level[i : i + FANOUT]
            bits = 0
            for p in parts:
                bits |= p.bits
            above.append(_Branch(parts, bits, min(p.few for p in parts), max(p.many for p in parts), max(p.excess for p in parts), None))
        level = above
    return level[0]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common shingles of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


class Traversal:
    """Dual traversals over the sets of one or two blocks; `links` are verified pairs (positions), as many as join the groups."""

    def __init__(self, sets: list[np.ndarray], groups: list[int], percent: int, sizes: list[int] | None = None):
        self.sets, self.percent, self.sizes = sets, percent, sizes or [len(s) for s in sets]
        numbers: dict[int, int] = {}
        self.of = [numbers.setdefault(g, len(numbers)) for g in groups]
        self.up = list(range(len(numbers)))
        self.links: list[tuple[int, int]] = []
        self.checked = 0

    def need(self, a: _Branch, b: _Branch) -> int:
        """The overlap that a link asks for at least."""
        return -(-self.percent * (a.few + b.few) // (100 + self.percent))

    def compare(self, a: _Branch, b: _Branch) -> None:
        i, j = a.parts, b.parts
        if overlap(self.sets[i], self.sets[j]) >= self.need(a, b):
            self.links.append((i, j))
            self.up[self.find(self.of[i])] = self.find(self.of[j])

    def find(self, g: int) -> int:
        up = self.up
        while up[g] != g:
            up[g] = up[up[g]]
            g = up[g]
        return g

    def group(self, branch: _Branch) -> int | None:
        """The group of all sets below, None if there are several."""
        if branch.group is None:
            own = None
            for p in branch.parts:
                g = self.group(p)
                if g is None or (own is not None and g != own):
                    return None
                own = g
            branch.group = own
        return self.find(branch.group)

    def leaves(self, members: list[int], width: int, bits: dict[int, int]) -> list[_Branch]:
        out = []
        for i in members:
            one, own = bits[i], max(width, _width(len(self.sets[i])))
            while own > width:  # a shorter bitmap is the OR of its halves
                own //= 2
                one = (one >> own) | (one & ((1 << own) - 1))
            n = self.sizes[i]
            out.append(_Branch(i, one, n, n, len(self.sets[i]) - one.bit_count(), self.of[i]))
        return out

    def run(self, left: list[int], right: list[int] | None = None) -> None:
        """Every pair of `left`, or of `left` and `right`: members by the width of their bitmaps, those of a larger one folded to the smaller."""
        bits = {i: int.from_bytes(bitmap(self.sets[i]), "little") for i in {*left, *(right or ())}}
        order = lambda members, w: sorted((i for i in members if _width(len(self.sets[i])) == w), key=lambda i: (self.sizes[i], i))
        widths = sorted({_width(len(self.sets[i])) for i in bits})
        for k, width in enumerate(widths):
            for other in widths[k:]:
                if other == width and right is None:
                    tree = _tree(self.leaves(order(left, width), width, bits))
                    self.traverse(tree, tree)
                    continue
                for one, two in ((left, left if right is None else right), *([(right, left)] if right is not None and other != width else [])):
                    one, two = order(one, width), order(two, other)
                    if one and two:
                        self.traverse(_tree(self.leaves(one, width, bits)), _tree(self.leaves(two, width, bits)))

    def traverse(self, a: _Branch, b: _Branch) -> None:
        stack = [(a, b)]
        percent = self.percent
        while stack:
            a, b = stack.pop()
            g = self.group(a)
            if g is not None and (a is b or g == self.group(b)):
                continue
            if a is b:
                parts = a.parts
                stack += [(parts[i], parts[j]) for i in range(len(parts)) for j in range(i + 1, len(parts))]
                stack += [(p, p) for p in parts]  # first each part in itself: then one link may join two parts
                continue
            if 100 * a.many < percent * b.few or 100 * b.many < percent * a.few:
                continue
            if (a.bits & b.bits).bit_count() + min(a.excess, b.excess) < self.need(a, b):
                continue
            if a.parts.__class__ is list:
                if b.parts.__class__ is list and b.many - b.few > a.many - a.few:
                    stack += [(a, p) for p in b.parts]
                else:
                    stack += [(p, b) for p in a.parts]
            elif b.parts.__class__ is list:
                stack += [(a, p) for p in b.parts]
            else:
                self.checked += 1
                self.compare(a, b)


class Meetings(Traversal):
    """Traversals over the shingles that sets share in a bucket; `links` are pairs of different groups that share some, `shared` how many."""

    def __init__(self, sets: list[np.ndarray], groups: list[int], percent: int, sizes: list[int]):
        super().__init__(sets, groups, percent, sizes)
        self.shared: list[int] = []

    def need(self, a: _Branch, b: _Branch) -> int:
        return 1

    def compare(self, a: _Branch, b: _Branch) -> None:
        i, j = a.parts, b.parts
        if n := overlap(self.sets[i], self.sets[j]):
            self.links.append((i, j))
            self.shared.append(n)


def _by_tree(percent: int, roots: bool):
    """What the trees of each pair of blocks (lead, lo, hi) link; rows come sorted by that, and those of a pair are at most a few times BLOCK.

    Rows (lead, a, b): each member and the smallest one linked with it, itself
    perhaps (`roots`), or the links found.
    """

    def run(batches):
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            new = _edges(rows)
            kept = rows.slice(new[-1]) if new else rows
            yield from links(rows.slice(0, new[-1] if new else 0), new[:-1])
        if kept is not None:
            new = _edges(kept)
            yield from links(kept, new)

    def _edges(rows: pa.Table) -> list[int]:
        change = np.zeros(max(0, len(rows) - 1), bool)
        for c in ("lead", "lo", "hi"):
            key = rows[c].to_numpy()
            change |= key[1:] != key[:-1]
        return (np.flatnonzero(change) + 1).tolist()

    def links(rows: pa.Table, edges: list[int]):
        found = []
        for s, e in zip([0, *edges], [*edges, len(rows)], strict=True):
            if e - s > 1 or (roots and e > s):
                some = rows.slice(s, e - s)
                lead = some["lead"][0].as_py()
                ids, groups, far = (some[c].to_pylist() for c in ("id", "grp", "far"))
                walk = Traversal([np.frombuffer(v.as_py(), np.uint64) for v in some["value"]], groups, percent)
                left, right = [i for i, f in enumerate(far) if not f], [i for i, f in enumerate(far) if f]
                if left:
                    walk.run(left, right or None)
                if roots:
                    first: dict[int, int] = {}
                    for i in sorted(range(len(ids)), key=ids.__getitem__):
                        first.setdefault(walk.find(walk.of[i]), ids[i])
                    found += [(lead, ids[i], first[walk.find(walk.of[i])]) for i in range(len(ids))]
                else:
                    found += [(lead, ids[i], ids[j]) for i, j in walk.links]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["lead", "a", "b"])

    return run


def _meetings(percent: int):
    """Rows (a, b, shared, few, many), the last two their sizes, of pairs of different groups that meet in a bucket of at most a block, whose rows (lead, id, n, grp, token) come sorted by lead and id."""

    def run(batches):
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            lead = rows["lead"].to_numpy()
            change = np.flatnonzero(lead[1:] != lead[:-1])
            last = int(change[-1]) + 1 if len(change) else 0
            kept = rows.slice(last)
            yield from pairs(rows.slice(0, last))
        if kept is not None:
            yield from pairs(kept)

    def pairs(rows: pa.Table):
        lead, ident, n, grp, token = (rows[c].to_numpy() for c in ("lead", "id", "n", "grp", "token"))
        at = np.flatnonzero(np.append(True, (lead[1:] != lead[:-1]) | (ident[1:] != ident[:-1]))[: len(lead)])
        stop = np.append(at[1:], len(lead))
        of = np.flatnonzero(np.append(True, lead[at][1:] != lead[at][:-1])[: len(at)])
        a, b, shared, few, many = [], [], [], [], []
        for s, e in zip(of.tolist(), [*of[1:].tolist(), len(at)][: len(of)], strict=True):
            if e - s > 1:
                walk = Meetings([np.sort(token[at[k] : stop[k]].view(np.uint64)) for k in range(s, e)], grp[at[s:e]].tolist(), percent, n[at[s:e]].tolist())
                walk.run(list(range(e - s)))
                ids = ident[at[s:e]].tolist()
                a += [min(ids[i], ids[j]) for i, j in walk.links]
                b += [max(ids[i], ids[j]) for i, j in walk.links]
                shared += walk.shared
                few += [min(walk.sizes[i], walk.sizes[j]) for i, j in walk.links]
                many += [max(walk.sizes[i], walk.sizes[j]) for i, j in walk.links]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, shared, few, many)], ["a", "b", "shared", "few", "many"])

    return run


def _shingles_of(docs: DataFrame, ids: DataFrame, how: Shingling) -> DataFrame:
    """(id, value): the sets of the documents in `ids (id)`, whose texts alone are shuffled."""

    def each(batches):
        seen = set()  # rows of one id meet in a task, which the join brings about; more of them would do no harm
        for batch in batches:
            ids = batch.column(0).to_pylist()
            new = [i not in seen and not seen.add(i) for i in ids]
            batch = batch.filter(pa.array(new, pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in how.sets(batch)], pa.binary())], ["id", "value"])

    texts = likely_rows(docs, ids).join(ids.hint("shuffle_hash"), "id", "left_semi")
    return checkpoint(texts.mapInArrow(each, "id long, value binary"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, buckets: int, roots: bool) -> DataFrame:
    """What the trees of the members `pairs (lead, lo, hi, far, id, grp)` link, as `_by_tree` gives it."""
    met = pairs.join(sets, "id").repartition(buckets, "lead", "lo", "hi").sortWithinPartitions("lead", "lo", "hi")
    met = met.select("lead", "lo", "hi", "far", "id", "grp", "value")
    return checkpoint(met.mapInArrow(_by_tree(percent, roots), "lead long, a long, b long"))


def _in_blocks(members: DataFrame) -> DataFrame:
    """`members (lead, id, grp)` of each bucket dealt to blocks of BLOCK: (lead, lo, hi, far, id, grp)."""
    blocks = checkpoint(members.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")))
    blk = F.pmod(F.xxhash64("id"), F.col("blocks")).alias("lo")
    return members.join(blocks, "lead").select("lead", blk, blk.alias("hi"), F.lit(False).alias("far"), "id", "grp")


def _across_blocks(members: DataFrame, percent: int) -> DataFrame:
    """`members (lead, id, grp, n)` of buckets with several groups, once for each pair of blocks that may hold a link that matters.

    A group with more than a block of members has blocks of its own in each range
    of sizes, of which no two are compared; the others share blocks.
    """
    step = np.log(100 / percent) if percent < 100 else 1.0
    members = members.withColumn("band", F.floor(F.log("n") / F.lit(float(step))))
    sizes = members.groupBy("lead", "band", "grp").agg(F.count(F.lit(1)).alias("m"))
    sizes = sizes.withColumn("own", F.when(F.col("m") > BLOCK, F.col("grp")))
    totals = checkpoint(sizes.groupBy("lead", "band", "own").agg(F.ceil(F.sum("m") / BLOCK).alias("blocks")))
    big = sizes.where("own IS NOT NULL").select("lead", "band", "grp", "own")
    members = members.join(checkpoint(big), ["lead", "band", "grp"], "left")
    members = members.join(totals.withColumnRenamed("own", "_own"), (members["lead"] == totals["lead"]) & (members["band"] == totals["band"]) & members["own"].eqNullSafe(F.col("_own"))).select(
        members["lead"], "id", "grp", "n", "own", F.xxhash64(members["band"], "own", F.pmod(F.xxhash64("id"), F.col("blocks"))).alias("blk")
    )
    members = checkpoint(members)
    one = F.when((F.count("own") == F.count(F.lit(1))) & (F.min("own") == F.max("own")), F.min("own"))
    blocks = checkpoint(members.groupBy("lead", "blk").agg(F.min("n").alias("few"), F.max("n").alias("many"), one.alias("own")))
    a, b = (blocks.select("lead", *[F.col(c).alias(f"{c}_{x}") for c in ("blk", "few", "many", "own")]) for x in "ab")
    met = a.join(b, "lead").where("blk_a <= blk_b").where(100 * F.col("many_a") >= percent * F.col("few_b")).where(100 * F.col("many_b") >= percent * F.col("few_a"))
    met = met.where(F.coalesce(F.col("own_a") != F.col("own_b"), F.lit(True)))
    met = met.withColumn("blk", F.explode(F.array_distinct(F.array("blk_a", "blk_b")))).select("lead", F.col("blk_a").alias("lo"), F.col("blk_b").alias("hi"), "blk")
    return members.join(checkpoint(met), ["lead", "blk"]).select("lead", "lo", "hi", (F.col("blk") != F.col("lo")).alias("far"), "id", "grp")


def _verified(pairs: DataFrame, docs: DataFrame, how: Shingling, percent: int) -> DataFrame:
    """`pairs (a, b)` whose sets reach the threshold, by intersecting them."""
    sets = _shingles_of(docs, checkpoint(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()), how)

    def each(batches):
        for batch in batches:
            hit = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                hit.append(overlap(one, two) * (100 + percent) >= percent * (len(one) + len(two)))
            yield batch.filter(pa.array(hit, pa.bool_())).select(["a", "b"])

    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return checkpoint(both.mapInArrow(each, "a long, b long"))


def _least(n: Column, percent: int) -> Column:
    """`shared_at_least` as a column."""
    return F.least(F.greatest(F.lit(SHARED), F.floor(n / SHARE)), F.ceil(n * percent / 100))


def tree_links(posts: DataFrame, docs: DataFrame, how: Shingling, percent: int, buckets: int) -> DataFrame:
    """Edges (a, b) that join whatever is linked, from `posts (lead, token, id, n)`: the first shingles that sets share, and the buckets these are in.

    A pair of different groups either is in a bucket of several blocks, where it is
    compared, or all that it shares is in small ones, where it is counted.
    """
    spark = posts.sparkSession
    members = checkpoint(posts.groupBy("lead", "id").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("shared")))
    home = members.groupBy("id").agg(F.max(F.struct("shared", "lead")).alias("best"), F.first("n").alias("n"))
    home = checkpoint(home.where(2 * F.col("best.shared") >= _least(F.col("n"), percent)).select("best.lead", "id", F.col("id").alias("grp")))
    found = _linked(_in_blocks(home), _shingles_of(docs, home.select("id"), how), percent, buckets, True)
    free(spark)
    edges = found.select("a", "b").where("a <> b")
    rest = members.join(found.select(F.col("a").alias("id"), F.col("b").alias("grp")), "id", "left")
    rest = checkpoint(rest.select("lead", "id", "n", F.coalesce("grp", "id").alias("grp")))
    sizes = rest.groupBy("lead").agg(F.count(F.lit(1)).alias("m"), F.min("grp").alias("g"), F.max("grp").alias("h")).where("g < h")
    rest = checkpoint(rest.join(checkpoint(sizes.select("lead", "m")), "lead"))

    small = posts.join(rest.where(F.col("m") <= BLOCK).select("lead", "id", "grp"), ["lead", "id"]).select("lead", "id", "n", "grp", "token")
    met = small.repartition(buckets, "lead").sortWithinPartitions("lead", "id").mapInArrow(_meetings(percent), "a long, b long, shared long, few long, many long")
    met = met.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.first("few").alias("few"), F.first("many").alias("many"))
    met = met.where(F.col("shared") >= _least(F.col("few"), percent)).where(100 * F.col("few") >= percent * F.col("many"))
    edges = edges.union(_verified(checkpoint(met.select("a", "b")), docs, how, percent))
    free(spark)

    rest = checkpoint(rest.where(F.col("m") > BLOCK).drop("m"))
    if rest.isEmpty():
        return edges
    sets = _shingles_of(docs, checkpoint(rest.select("id").distinct()), how)
    most = None
    while True:
        groups = checkpoint(rest.groupBy("lead").agg(F.countDistinct("grp").alias("m")).where("m > 1"))
        now = groups.agg(F.max("m")).first()[0]
        if now is None:
            return edges
        rest = checkpoint(rest.join(groups.select("lead"), "lead", "left_semi"))
        if most is not None and (most <= BLOCK or 2 * now > most):
            break
        some = checkpoint(rest.select("lead", F.col("grp").alias("id"), "grp").distinct())
        found = _linked(_in_blocks(some), sets, percent, buckets, True).withColumnsRenamed({"a": "grp", "b": "to"})
        free(spark)
        edges = edges.union(found.select(F.col("grp").alias("a"), F.col("to").alias("b")).where("a <> b"))
        rest = rest.join(found, ["lead", "grp"]).select("lead", "id", "n", F.col("to").alias("grp"))
        most = now
    across = _linked(_across_blocks(rest, percent), sets, percent, buckets, False)
    free(spark)
    return edges.union(across.select("a", "b"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of `docs`.

    A document's set is its distinct `width`-word shingles (see `shingle_sets`;
    their 64-bit hashes stand for them, and sets go by 128 bits; the hashes' key is
    drawn anew for each call, so that no text can be made to collide). Documents link
    when 100 * intersection >= `percent` * union; component_id is the smallest id
    reachable. Null and empty texts have no shingles and link with nothing. Rows
    with a null id link with nothing and have a null component; rows that share an
    id should share a text. Equal sets are one class and compared once. Other
    columns of `docs` are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    how = Shingling(width, secrets.token_bytes(32))
    rows = checkpoint(document_sets(docs, how))
    named = rows.where("n >= 0")
    classes = named.where("node IS NOT NULL AND id IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    classes = checkpoint(classes)
    firsts = named.agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + _least(F.col("n"), percent))).first()[0] or 0
    buckets = max(partitions(spark), int(firsts) // _POSTINGS, 12)

    packed = postings(docs, how, percent, common_shingles(rows), buckets)
    posts = checkpoint(packed.repartitionById(buckets, "bucket").mapInArrow(_unpack, "token long, node binary"))
    del packed
    free(spark)
    enough = posts.groupBy("node").agg(F.count(F.lit(1)).alias("met")).join(classes, "node").where(F.col("met") >= _least(F.ceil(F.col("n") * percent / 100), percent))
    sets = checkpoint(enough.select("node", "id", "n"))
    posts = checkpoint(posts.join(sets, "node").select("token", "id", "n"))

    # buckets with the same smallest member are one, which the sets in many of the same buckets enter once
    lead = checkpoint(posts.groupBy("token").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("m")).where("m > 1").select("token", "lead"))
    posts = checkpoint(posts.join(lead, "token").select("lead", "token", "id", "n"))
    free(spark)
    group = components(tree_links(posts, docs, how, percent, buckets))

    reps = checkpoint(classes.join(group, "id", "left").select("node", F.coalesce("component", "id").alias("component_id")))
    out = named.join(reps, "node", "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), percent=85, width=4)


_WORDS_SQL = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
     s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                               ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS shingle FROM w),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
     pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
     links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
     walk AS (SELECT a, a AS b FROM links UNION SELECT walk.a, links.b FROM walk JOIN links ON walk.b = links.a),
     low AS (SELECT a, min(b) AS low FROM walk GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, d.doc_id) AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.a = d.doc_id
"""
