"""Removal of long repeated passages across documents, by bounded suffix arrays.

Windows of MIN_BYTES are dealt by their smallest inner gram, so that equal windows
of any two documents meet; neighbouring windows with the same gram travel as one
segment. Equal segments are told by hashes and only the one in the smallest
document goes on. Segments of one gram that differ go through a Burrows-Wheeler
transform of their texts: a breadth-first backward extension of intervals finds
the boundaries of common prefixes in increasing length and stops at MIN_BYTES;
suffixes without a boundary between them share a window. The segments of a gram
that many have, as beside a common line, go on window by window instead, dealt
by hashes of the windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.common import checkpoint, free, likely_rows, partitions, table
from sparklogs.llm.shingles import mixed

#: Bytes of a window, and of the grams that deal windows out.
MIN_BYTES, GRAM = 50, 16
_SPAN = MIN_BYTES - GRAM + 1
_LEFT = (MIN_BYTES - GRAM) // 2
_RIGHT = MIN_BYTES - GRAM - _LEFT + 1
#: Bytes hashed at a time; bytes of segments that share a suffix array, more only if one gram has more.
CHUNK, BLOCK = 1 << 18, 1 << 19
#: Bytes of texts for which there is a bucket.
BUCKET = 64 << 20
#: Bytes of segments of one gram, above which its windows are dealt one by one; bytes of such segments in a batch of windows.
HOT, HOT_CHUNK = 1 << 21, 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_C1, _C2 = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
#: Windows in a segment: longer runs, as of periodic text, are cut.
_RUN = 255


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(int(_BASE), -1, 1 << 64)
_POWERS, _INVERSES = _powers(int(_BASE), 1 << 20), _powers(_INVERSE, 1 << 20)


def segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, start, windows, gram, hash, left, right) of the segments of texts: runs of windows with the same smallest gram.

    A segment's bytes are [start, start + windows + MIN_BYTES - 1); its hash covers
    all of them. left and right are 8-bit hashes of the bytes next to the gram: a
    window that two segments share holds _LEFT bytes before it or _RIGHT after it.
    0 stands for a side too short for that, 1 on both sides for a gram that repeats.
    """
    found = []
    first = held = 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > CHUNK:
            found.append(_segments(texts[first:i], first))
            first, held = i, 0
        held += len(text)
    found.append(_segments(texts[first:], first))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _segments(texts: list[bytes], first: int) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = b"".join(texts) + bytes(16)
    n = len(raw) - 16
    if n < MIN_BYTES:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none.astype(np.uint8), none.astype(np.uint8)
    words = np.ndarray(n + 9, "<u8", raw, strides=(1,))
    grams = mixed(words[: n - GRAM + 1] * _C1 ^ mixed(words[8 : n - GRAM + 9] * _C2))
    low = grams
    width = 1
    while width * 2 <= _SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < _SPAN:
        low = np.minimum(low[: len(low) - (_SPAN - width)], low[_SPAN - width :])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(low)]
    inside = np.arange(len(low)) + MIN_BYTES <= ends[owner]
    new = np.append(True, (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])) & inside
    new |= np.append(False, ~inside[:-1]) & inside
    at = np.flatnonzero(new)
    stop = np.minimum(np.append(at[1:], len(low)), ends[owner[at]] - MIN_BYTES + 1)
    if len(at) and int((stop - at).max()) > _RUN:
        parts = -(-(stop - at) // _RUN)
        step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        last = np.repeat(stop, parts)
        at = np.repeat(at, parts) + step * _RUN
        stop = np.minimum(at + _RUN, last)
    powers, inverses = (_POWERS, _INVERSES) if len(grams) < len(_POWERS) else (_powers(int(_BASE), len(grams) + 1), _powers(_INVERSE, len(grams) + 1))
    total = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(grams * powers[: len(grams)], out=total[1:])
    whole = mixed((total[stop + _SPAN - 1] - total[at]) * inverses[at] ^ (stop - at).astype(np.uint64))
    left, right = _sides(grams, low, at, stop, total, powers, inverses)
    return owner[at] + first, at - (ends - sizes)[owner[at]], stop - at, low[at], whole, left, right


def _sides(grams, low, at, stop, total, powers, inverses) -> tuple[np.ndarray, np.ndarray]:
    """The hashes beside each segment's gram, by the grams that lie within _LEFT bytes before it and _RIGHT after it."""
    high, width = low, 1  # a gram is smallest in some window if no window over it has a smaller one
    high = np.concatenate([np.zeros(_SPAN - 1, np.uint64), low, np.zeros(_SPAN - 1, np.uint64)])
    while width * 2 <= _SPAN:
        high = np.maximum(high[:-width], high[width:])
        width *= 2
    if width < _SPAN:
        high = np.maximum(high[: len(high) - (_SPAN - width)], high[_SPAN - width :])
    spots = np.flatnonzero(high[: len(grams)] == grams)
    value = low[at]
    k = np.searchsorted(spots, at)
    gram, times = np.full(len(at), -1), np.zeros(len(at), np.int64)
    rest = np.arange(len(at))
    while len(rest):
        rest = rest[k[rest] < len(spots)]
        rest = rest[spots[k[rest]] <= stop[rest] + _SPAN - 2]
        hit = rest[grams[spots[k[rest]]] == value[rest]]
        gram[hit] = spots[k[hit]]
        times[hit] += 1
        k[rest] += 1

    def beside(start: np.ndarray, stop: np.ndarray, ok: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ok), np.uint8)
        sums = mixed((total[stop[ok]] - total[start[ok]]) * inverses[start[ok]])
        out[ok] = (sums >> np.uint64(56)).astype(np.uint8) | np.uint8(2)
        return out

    left = beside(gram - _LEFT, gram + 1, gram - _LEFT >= at)
    right = beside(gram, gram + _RIGHT + 1, gram + GRAM + _RIGHT <= stop + MIN_BYTES - 1)
    left[times > 1] = right[times > 1] = 1
    return left, right


def boundaries(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For the suffixes of `text` in `order`: whether each shares less than `depth` symbols with the one before it.

    `text` holds symbols above 0, and 0 where a string ends; `order` sorts suffixes
    at least to `depth`. Prefixes are extended backwards on the Burrows-Wheeler
    transform: an interval of suffixes that begin with w splits by the symbol
    before them into intervals of cw, whose upper bounds are boundaries with
    common prefix |w|. An interval whose bound is known already is not followed.
    """
    n = len(text)
    before = text[order - 1]  # order 0 wraps to the final 0
    by_symbol = np.argsort(before, kind="stable")
    back = np.empty(n, np.int64)
    back[by_symbol] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    rows = np.arange(n)  # suffixes in intervals that are followed, in order
    starts = np.zeros(n, np.int64)  # the first row of the interval of each
    for _ in range(depth):
        real = before[rows] > 0
        rows, starts = rows[real], starts[real]
        if not len(rows):
            break
        to = back[rows]
        turn = np.argsort(to)
        to, origin, symbol = to[turn], starts[turn], before[rows[turn]]
        head = np.append(True, (origin[1:] != origin[:-1]) | (symbol[1:] != symbol[:-1]))
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(to)))
        bound = to[at] + size
        fresh = ~known[bound]
        known[bound[fresh]] = True
        follow = np.repeat(fresh, size)
        rows, starts = to[follow], np.repeat(to[at], size)[follow]
    return known[:n]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of `text` (see `boundaries`) sorted to `depth` symbols or more, by prefix doubling."""
    n = len(text)
    left = np.flatnonzero(text == 0)
    room = left[np.searchsorted(left, np.arange(n))] - np.arange(n)  # symbols before the end of the string
    key = np.zeros(n, np.uint64)
    padded = np.append(text, np.zeros(8, text.dtype)).astype(np.uint64)
    for k in range(7):
        key = key << np.uint64(9) | np.where(k < room, padded[k : n + k], 0)
    _, rank = np.unique(key, return_inverse=True)
    done = 7
    while done < depth:
        rest = np.zeros(n, np.int64)
        has = np.flatnonzero(room > done)
        rest[has] = rank[has + done] + 1
        _, rank = np.unique(rank.astype(np.int64) * (n + 1) + rest, return_inverse=True)
        done *= 2
    return np.argsort(rank, kind="stable")


def repeated_windows(strings: list[bytes], docs: np.ndarray, depth: int = MIN_BYTES) -> list[np.ndarray]:
    """For each string the starts of its windows of `depth` bytes that a string of a smaller document also holds."""
    sizes = np.array([len(s) for s in strings], np.int64)
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    text = raw.astype(np.int16) + 1
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 0
    order = suffix_order(text, depth)
    group = np.cumsum(boundaries(text, order, depth))
    owner = np.repeat(np.arange(len(strings)), sizes + 1)[order]
    fits = order + depth <= ends[owner]
    order, group, owner = order[fits], group[fits], owner[fits]
    if not len(order):
        return [np.zeros(0, np.int64)] * len(strings)
    lowest = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, group, docs[owner])
    hit = lowest[group] < docs[owner]
    at, own = order[hit], owner[hit]
    turn = np.argsort(at)
    at, own = at[turn], own[turn]
    cut = np.searchsorted(own, np.arange(len(strings) + 1))
    begin = ends - sizes
    return [at[cut[k] : cut[k + 1]] - begin[k] for k in range(len(strings))]


#: A segment on its way to its bucket, a range of windows of a document, and a segment whose text is wanted.
_SEGMENT = np.dtype([("gram", "<u4"), ("hash", "V6"), ("doc", "<u4"), ("start", "<u4"), ("windows", "u1"), ("left", "u1"), ("right", "u1")])
_RANGE = np.dtype([("start", "<u4"), ("windows", "u1")])
_WANTED = np.dtype([("start", "<u4"), ("windows", "u1"), ("gram", "<u4")])

_ROWS = "bucket int, doc long, kind int, payload binary"
_WINDOW = np.dtype([("key", "<u8"), ("more", "<u4"), ("doc", "<i8"), ("start", "<u4")])
#: Kinds of rows: packed windows, packed segments or strings, ranges to remove, wanted segments, grams with more than HOT bytes.
_WINDOWS, _PACKED, _REMOVE, _READ, _HOT = -2, -1, 0, 1, 2


def _rows(bucket=(), doc=(), kind=None, payload=()) -> pa.RecordBatch:
    n = len(payload)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket, pa.int32()) if len(bucket) else pa.nulls(n, pa.int32()),
            pa.array(doc, pa.int64()) if len(doc) else pa.nulls(n, pa.int64()),
            pa.array([kind] * n, pa.int32()),
            pa.array(payload, pa.binary()),
        ],
        ["bucket", "doc", "kind", "payload"],
    )


def _by_doc(docs: np.ndarray, items: np.ndarray, kind: int):
    """One row for each document with its items."""
    order = np.argsort(docs, kind="stable")
    docs, items = docs[order], items[order]
    at = np.flatnonzero(np.append(True, docs[1:] != docs[:-1])) if len(docs) else np.zeros(0, int)
    for some in np.array_split(np.arange(len(at)), max(1, len(at) // 10_000)):
        if len(some):
            cut = np.append(at, len(docs))
            yield _rows(doc=docs[at[some]], kind=kind, payload=[items[cut[k] : cut[k + 1]].tobytes() for k in some])


def _ranges(start: np.ndarray, windows: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), _RANGE)
    out["start"], out["windows"] = start, windows
    return out


def _columns(packed: np.ndarray, names: list[str]) -> bytes:
    """Column by column, which the shuffle compresses better."""
    return b"".join(np.ascontiguousarray(packed[n]).tobytes() for n in names)


def _deal(buckets: int):
    """Segments of whole texts to the buckets of their grams. Of equal ones in a batch only that of the smallest document goes; windows of the others are removed."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            owner, start, windows, gram, whole, left, right = segments(batch.column(1).cast(pa.binary()).to_pylist())
            order = np.lexsort((ids[owner], whole, gram))
            owner, start, windows, gram, whole, left, right = (c[order] for c in (owner, start, windows, gram, whole, left, right))
            doc = ids[owner]
            at = np.flatnonzero(np.append(True, (gram[1:] != gram[:-1]) | (whole[1:] != whole[:-1]))) if len(doc) else np.zeros(0, int)
            lowest = np.repeat(doc[at], np.diff(np.append(at, len(doc))))
            later = doc > lowest
            yield from _by_doc(doc[later], _ranges(start[later], windows[later]), _REMOVE)
            at = np.flatnonzero(~later)  # a document may hold a segment more than once
            bucket = ((gram[at] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            at = at[np.lexsort((start[at], owner[at], bucket))]
            bucket = ((gram[at] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            packed = np.empty(len(at), _SEGMENT)
            packed["gram"], packed["start"], packed["windows"] = gram[at] & np.uint64(0xFFFFFFFF), start[at], windows[at]
            packed["hash"] = np.ascontiguousarray(whole[at].view(np.uint8).reshape(-1, 8)[:, :6]).view("V6").ravel()
            packed["left"], packed["right"] = left[at], right[at]
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            which, load = np.flatnonzero(np.diff(cut)), []
            for b in which:
                part = packed[cut[b] : cut[b + 1]]
                some, part["doc"] = np.unique(owner[at[cut[b] : cut[b + 1]]], return_inverse=True)
                load.append(np.array([len(part), len(some)], np.int64).tobytes() + ids[some].tobytes() + _columns(part, list(_SEGMENT.names)))
            yield _rows(bucket=which, kind=_PACKED, payload=load)

    return run


def _read_segments(load: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = np.frombuffer(load, np.int64, 2).tolist()
    ids, at, out = np.frombuffer(load, np.int64, m, 16), 16 + 8 * m, np.empty(n, _SEGMENT)
    for name in _SEGMENT.names:
        kind = _SEGMENT[name]
        out[name] = np.frombuffer(load, kind, n, at)
        at += n * kind.itemsize
    return ids[out["doc"]], out


def _meet(batches, hot: int = HOT):
    """All segments of a bucket: later copies are removed, and the texts of those that may share windows with others are asked for; names the grams of which more than `hot` bytes are."""
    got = [_read_segments(load) for batch in batches for load in batch.column(1).to_pylist()]
    if not got:
        return
    doc, seg = np.concatenate([d for d, _ in got]), np.concatenate([s for _, s in got])
    del got
    if not len(seg):
        return
    wide = np.zeros((len(seg), 8), np.uint8)
    wide[:, :6] = np.ascontiguousarray(seg["hash"]).view(np.uint8).reshape(-1, 6)
    whole, gram = wide.view("<u8").ravel(), seg["gram"]
    order = np.lexsort((doc, whole, gram))
    doc, seg, whole, gram = doc[order], seg[order], whole[order], gram[order]
    head = np.append(True, (gram[1:] != gram[:-1]) | (whole[1:] != whole[:-1]))
    at = np.flatnonzero(head)
    later = doc > np.repeat(doc[at], np.diff(np.append(at, len(doc))))
    yield from _by_doc(doc[later], _ranges(seg["start"][later], seg["windows"][later]), _REMOVE)
    string = (np.cumsum(head) - 1)[~later]  # which distinct string each occurrence in its smallest document is
    every_doc, every = doc[~later], seg[~later]
    gram, seg = gram[at], seg[at]
    keep = np.zeros(len(gram), bool)
    for side in ("left", "right"):
        some = np.flatnonzero(seg[side] > 1)
        if not len(some):
            continue
        key = gram[some].astype(np.int64) << 8 | seg[side][some]
        some = some[np.argsort(key, kind="stable")]
        key = gram[some].astype(np.int64) << 8 | seg[side][some]
        same = np.append(key[1:] == key[:-1], False)
        keep[some[same | np.append(False, same[:-1])]] = True
    keep |= np.isin(gram, gram[seg["left"] == 1])
    first = np.append(True, gram[1:] != gram[:-1])
    keep &= np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1] > 1
    keep = keep[string]
    wanted = np.empty(int(keep.sum()), _WANTED)
    for name in _WANTED.names:
        wanted[name] = every[name][keep]
    yield from _by_doc(every_doc[keep], wanted, _READ)
    named, at = np.unique(wanted["gram"], return_inverse=True)
    much = named[np.bincount(at, wanted["windows"].astype(np.int64) + MIN_BYTES - 1, len(named)) > hot]
    if len(much):
        yield _rows(kind=_HOT, payload=[much.tobytes()])


def window_hashes(strings: list[bytes]) -> tuple[np.ndarray, ...]:
    """(string, offset, key, more) of all windows of strings; key and more are 96 bits of hashes of a window's bytes."""
    sizes = np.array([len(s) for s in strings], np.int64)
    raw = b"".join(strings) + bytes(8)
    words = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    per = np.maximum(sizes - MIN_BYTES + 1, 0)
    owner = np.repeat(np.arange(len(strings)), per)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    at = (np.cumsum(sizes) - sizes)[owner] + offset
    key, more = np.zeros(len(at), np.uint64), np.ones(len(at), np.uint64)
    for k in [*range(0, MIN_BYTES - 8, 8), MIN_BYTES - 8]:
        word = words[at + k]
        key, more = mixed(key * _C1 ^ word), mixed(more * _C2 ^ mixed(word))
    return owner, offset, key, (more >> np.uint64(32)).astype(np.uint32)


def _first_windows(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal windows those in the smallest document, and the others."""
    windows = windows[np.lexsort((windows["doc"], windows["more"], windows["key"]))]
    if not len(windows):
        return windows, windows
    at = np.flatnonzero(np.append(True, (windows["key"][1:] != windows["key"][:-1]) | (windows["more"][1:] != windows["more"][:-1])))
    later = windows["doc"] > np.repeat(windows["doc"][at], np.diff(np.append(at, len(windows))))
    return windows[~later], windows[later]


def _removed(windows: np.ndarray):
    """Rows that remove windows, those in a row of a document as one range."""
    windows = windows[np.lexsort((windows["start"], windows["doc"]))]
    doc, start = windows["doc"], windows["start"].astype(np.int64)
    head = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1))[: len(doc)]
    run = np.flatnonzero(head)
    place = np.arange(len(doc)) - np.repeat(run, np.diff(np.append(run, len(doc))))
    at = np.flatnonzero(place % _RUN == 0)
    yield from _by_doc(doc[at], _ranges(start[at], np.diff(np.append(at, len(doc)))), _REMOVE)


def _deal_windows(strings: list[bytes], doc: np.ndarray, start: np.ndarray, buckets: int):
    """Windows of segments to the buckets of their hashes. Of equal ones in a part of HOT_CHUNK bytes only those in the smallest document go; the others are removed."""
    part = np.cumsum([len(s) for s in strings]) // HOT_CHUNK
    for some in np.split(np.arange(len(strings)), np.flatnonzero(np.diff(part)) + 1):
        owner, offset, key, more = window_hashes([strings[k] for k in some])
        windows = np.empty(len(owner), _WINDOW)
        windows["key"], windows["more"], windows["doc"], windows["start"] = key, more, doc[some][owner], start[some][owner] + offset
        windows, later = _first_windows(windows)
        yield from _removed(later)
        bucket = (windows["key"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        which = np.flatnonzero(np.diff(cut))
        yield _rows(bucket=which, kind=_WINDOWS, payload=[_columns(windows[order[cut[b] : cut[b + 1]]], list(_WINDOW.names)) for b in which])


def _read_windows(load: bytes) -> np.ndarray:
    out, at = np.empty(len(load) // _WINDOW.itemsize, _WINDOW), 0
    for name in _WINDOW.names:
        out[name] = np.frombuffer(load, _WINDOW[name], len(out), at)
        at += len(out) * _WINDOW[name].itemsize
    return out


def _read(buckets: int, hot: np.ndarray):
    """The texts of wanted segments, packed by the bucket of their grams; those of `hot` grams as windows."""

    def run(batches):
        for batch in batches:
            doc, windows, start, gram, strings = [], [], [], [], []
            for i, text, loads in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
                raw, items = text.as_py(), np.frombuffer(b"".join(loads), _WANTED)
                for s, w in zip(items["start"].tolist(), items["windows"].tolist(), strict=True):
                    strings.append(raw[s : s + w + MIN_BYTES - 1])
                doc.append(np.full(len(items), i))
                start.append(items["start"])
                windows.append(items["windows"])
                gram.append(items["gram"])
            if not strings:
                continue
            doc, start, gram = np.concatenate(doc), np.concatenate(start), np.concatenate(gram)
            much = np.isin(gram, hot)
            if much.any():
                at = np.flatnonzero(much)
                yield from _deal_windows([strings[k] for k in at], doc[at], start[at], buckets)
                at = np.flatnonzero(~much)
                strings, doc, start, gram = [strings[k] for k in at], doc[at], start[at], gram[at]
            bucket = gram.astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            which, load = np.flatnonzero(np.diff(cut)), []
            for b in which:
                at = order[cut[b] : cut[b + 1]]
                some = [strings[k] for k in at]
                load.append(np.int64(len(at)).tobytes() + gram[at].astype("<u4").tobytes() + doc[at].tobytes() + start[at].astype("<u4").tobytes() + np.array([len(s) for s in some], "<u4").tobytes() + b"".join(some))
            yield _rows(bucket=which, kind=_PACKED, payload=load)

    return run


def _compare(batches):
    """Windows of a bucket that a smaller document also has: of packed strings by suffix arrays, of packed windows by their hashes; ranges to remove pass."""
    windows: list[np.ndarray] = []
    passing: list[pa.RecordBatch] = []

    def strings():
        for batch in batches:
            kind = batch.column(2).to_numpy()
            passing.append(batch.filter(pa.array(kind == _REMOVE)))
            windows.extend(_read_windows(load) for load in batch.filter(pa.array(kind == _WINDOWS)).column(3).to_pylist())
            yield batch.filter(pa.array(kind == _PACKED)).select(["bucket", "payload"])

    yield from _transform(strings())
    yield from passing
    if windows:
        yield from _removed(_first_windows(np.concatenate(windows))[1])


def _transform(batches):
    """Windows that a smaller document also has, by suffix arrays over blocks of whole gram groups."""
    gram, doc, start, strings = [], [], [], []
    for batch in batches:
        for load in batch.column(1).to_pylist():
            n = int(np.frombuffer(load, np.int64, 1)[0])
            gram.append(np.frombuffer(load, "<u4", n, 8))
            doc.append(np.frombuffer(load, np.int64, n, 8 + 4 * n))
            start.append(np.frombuffer(load, "<u4", n, 8 + 12 * n))
            ends = np.cumsum(np.frombuffer(load, "<u4", n, 8 + 16 * n).astype(np.int64)) + 8 + 20 * n
            strings += [load[a:b] for a, b in zip([8 + 20 * n, *ends[:-1].tolist()], ends.tolist(), strict=True)]
    if not gram:
        return
    gram, doc, start = np.concatenate(gram), np.concatenate(doc), np.concatenate(start).astype(np.int64)
    order = np.argsort(gram, kind="stable")
    found_doc, found = [], []
    block, size = [], 0
    for k, i in enumerate(order.tolist()):
        block.append(i)
        size += len(strings[i])
        ended = k + 1 == len(order) or gram[order[k + 1]] != gram[i]
        if ended and (size >= BLOCK or k + 1 == len(order)):
            for i, hit in zip(block, repeated_windows([strings[i] for i in block], doc[block]), strict=True):
                if len(hit):
                    a = np.flatnonzero(np.append(True, np.diff(hit) > 1))
                    found_doc.append(np.full(len(a), doc[i]))
                    found.append(_ranges(start[i] + hit[a], np.diff(np.append(a, len(hit)))))
            block, size = [], 0
    if found:
        yield from _by_doc(np.concatenate(found_doc), np.concatenate(found), _REMOVE)


def _cut(batches):
    """What is left of texts without the bytes of their removed windows, as spans and a digest."""
    for batch in batches:
        out = {"removed": [], "spans": [], "kept": []}
        for text, loads in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
            raw, items = text.as_py(), np.frombuffer(b"".join(loads), _RANGE)
            edge = np.zeros(len(raw) + 1, np.int64)
            begin = items["start"].astype(np.int64)
            np.add.at(edge, np.minimum(begin, len(raw)), 1)
            np.add.at(edge, np.minimum(begin + items["windows"] + MIN_BYTES - 1, len(raw)), -1)
            gone = np.cumsum(edge)[:-1] > 0
            turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            out["removed"].append(int(gone.sum()))
            out["spans"].append([{"start": int(s), "end": int(e)} for s, e in zip(turn[::2], turn[1::2], strict=True)])
            out["kept"].append(hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out["removed"], pa.int64()), pa.array(out["spans"], span), pa.array(out["kept"], pa.string())], ["id", "removed", "spans", "kept"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256): one row per row of `docs`.

    `spans` are maximal byte ranges [start, end) of the UTF-8 text, each byte of
    which is in a MIN_BYTES string that also starts in a document with a smaller
    id; strings are judged on the input. Texts below MIN_BYTES, empty and null
    ones (as empty) lose nothing. Rows with a null id take no part and lose
    nothing. Ids should be unique: rows that share one are one document, and are
    cut alike, which is right for repeated rows. Texts are below 4 GB. Segments
    are told equal by their gram and 80 bits or more of hashes. Other columns are
    not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    sound = docs.where(F.col("id").isNotNull())
    total = sound.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets, limit = max(partitions(spark), 12, total // BUCKET), HOT
    dealt = sound.where(F.octet_length("text") >= MIN_BYTES).mapInArrow(_deal(buckets), _ROWS)
    # segments go on to their buckets; removed ranges pass them by, spread by document
    way = F.coalesce("bucket", F.pmod(F.xxhash64("doc"), F.lit(buckets)).cast("int"))
    dealt = dealt.withColumn("bucket", way).repartitionById(buckets, "bucket")

    def meet(batches):
        def only_segments():
            for batch in batches:
                mine = batch.column(2).to_numpy() < 0
                passing.append(batch.filter(pa.array(~mine)))
                yield batch.filter(pa.array(mine)).select(["bucket", "payload"])

        passing: list[pa.RecordBatch] = []
        yield from _meet(only_segments(), limit)
        yield from passing

    met = checkpoint(dealt.mapInArrow(meet, _ROWS).select("doc", "kind", "payload"))
    del dealt
    free(spark)
    wanted = met.where(F.col("kind") == _READ).groupBy(F.col("doc").alias("id")).agg(F.collect_list("payload").alias("loads"))
    # at most one for every HOT bytes of wanted segments
    hot = [np.frombuffer(r.payload, "<u4") for r in met.where(F.col("kind") == _HOT).select("payload").collect()]
    hot = np.concatenate([np.zeros(0, "<u4"), *hot])
    texts = sound.join(wanted.hint("shuffle_hash"), "id").select("id", "text", "loads").mapInArrow(_read(buckets, hot), _ROWS)
    shared = checkpoint(texts.withColumn("bucket", way).repartitionById(buckets, "bucket").mapInArrow(_compare, _ROWS).select("doc", "payload"))
    del wanted, texts
    free(spark)
    removed = met.where(F.col("kind") == _REMOVE).select("doc", "payload").union(shared)
    removed = checkpoint(removed.groupBy(F.col("doc").alias("id")).agg(F.collect_list("payload").alias("loads")))
    hit = likely_rows(sound, removed.select("id")).join(removed.hint("shuffle_hash"), "id").select("id", "text", "loads")
    hit = checkpoint(hit.mapInArrow(_cut, "id long, removed long, spans array<struct<start: long, end: long>>, kept string").dropDuplicates(["id"]))
    rows = docs.select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    return rows.join(hit, "id", "left").select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.coalesce("removed", F.lit(0)).alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<struct<start: long, end: long>>")).alias("spans"),
        F.coalesce("kept", "whole").alias("kept_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
