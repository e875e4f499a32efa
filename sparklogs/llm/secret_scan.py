"""Secret scans: fixed patterns, and strings that a primed compressor finds new.

A candidate is a key-like string in a sensitive context. Its novelty is what it
adds to a zstandard frame whose dictionary holds common identifiers and the text
around the candidate, divided by its length. Text and identifiers are in the
dictionary and cost nearly nothing; random keys cost about what they are long.
Words that the dictionary lacks cost that too: without digits, a candidate must
also be made of pairs of letters that are rare in identifiers and text.
"""

from __future__ import annotations

import builtins
import keyword
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.common import table

KINDS = ("assign", "access", "hex", "novel")
#: Candidates cost at least this part of their length when compressed after their context.
MIN_NOVELTY = 0.75
#: A string without digits has at most this part of its pairs of letters from the identifiers and its context.
MAX_FAMILIAR = 0.75
#: Code points on either side that prime the compressor, and how far from a sensitive word a candidate may begin or end.
CONTEXT, REACH = 512, 64


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([_any_case("password"), _any_case("passwd"), _any_case("secret"), _any_case("token"), _any_case("api") + "_?" + _any_case("key")])
_ASSIGN = re.compile(rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs shorter than 24 are dropped and don't touch others, so they need not be matched.
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
#: Words that make a context sensitive.
SENSITIVE = ("password", "passwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "access_key", "private_key", "credential", "authorization", "bearer", "auth_")
#: More of them, which are news to the compressor.
ALSO_SENSITIVE = ("api key", "access-key", "access key", "accesskey", "private-key", "private key", "privatekey", "signing_key", "signing key", "encryption_key", "encryption key", "pwd")
_HINTS = (*SENSITIVE, *ALSO_SENSITIVE)
_SENSITIVE = re.compile("|".join(_any_case(w) for w in _HINTS))
_KEYLIKE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
#: The next line of a key that goes on, by a line break or one written as \\n; and the last, shorter one of a base64 text.
_NEXT = re.compile(r"""["'\\+,;\x20\t]*(?:\r?\n|\\n)[\x20\t]*["']?([A-Za-z0-9+/_.=-]{16,}+)(?=["'\\,;+)\x20\t]*(?:\r?\n|\Z|\\n|["']))""")
_LAST = re.compile(r"""["'\\+,;\x20\t]*(?:\r?\n|\\n)[\x20\t]*["']?((?=[A-Za-z]*+[0-9+/])[A-Za-z0-9+/]++={0,2}|[A-Za-z0-9+/]++={1,2})(?=["'\\,;+)\x20\t]*(?:\r?\n|\Z|\\n|["']))""")
#: Parts of paths: words, words in camel case, capitals, numbers of up to four digits, versions.
_SEPARATORS, _PLAIN = re.compile(r"[./_=-]+"), re.compile(r"[A-Za-z]?[a-z]{0,20}|[a-z]{2,20}(?:[A-Z][a-z]{2,20}){1,3}|(?:[A-Z][a-z]{2,20}){2,4}|[A-Z]{1,10}|[0-9]{1,4}|v[0-9]{1,3}")
_BEGIN, _END = (re.compile(rf"-----{x} [A-Z0-9\x20]*PRIVATE KEY(?: BLOCK)?-----") for x in ("BEGIN", "END"))
_PEM_LINE = re.compile(r"(?:\s|\\[nr])*([A-Za-z0-9+/]{16,}={0,2}|[A-Za-z0-9+/]+={1,2})")
#: What replaces a secret; no sensitive word itself.
MARK = "[SECRET]"
#: Identifiers that are no news in code, from Python's own names.
IDENTIFIERS = " ".join([*keyword.kwlist, *dir(builtins), *dir(str), *dir(dict), *SENSITIVE]).encode()

OUT = "doc_id long, spans array<struct<kind: string, start: int, end: int, novelty: double>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns; leftmost and non-overlapping in each kind."""
    found = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def novelty(candidate: str, context: str) -> float:
    """Marginal compressed bytes of `candidate` after the identifiers and `context`, over its own bytes."""
    primed = zstandard.ZstdCompressionDict(IDENTIFIERS + context.encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_dict_id=False)
    raw = candidate.encode()
    return (len(press.compress(raw)) - len(press.compress(b""))) / len(raw)


def _pairs(text: str) -> set[str]:
    low = text.lower()
    return {a + b for a, b in zip(low, low[1:], strict=False) if a.isalpha() and b.isalpha()}


_KNOWN_PAIRS = _pairs(IDENTIFIERS.decode())


def strange(word: str, context: str) -> bool:
    """Whether a string has digits, or letters in an order that is rare in identifiers and `context`."""
    if any(c.isdigit() for c in word):
        return True
    low = word.lower()
    pairs = [a + b for a, b in zip(low, low[1:], strict=False) if a.isalpha() and b.isalpha()]
    known = _KNOWN_PAIRS | _pairs(context)
    return bool(pairs) and sum(p in known for p in pairs) <= MAX_FAMILIAR * len(pairs)


def candidates(text: str) -> list[tuple[int, int]]:
    """Key-like strings of 16 characters or more that begin within REACH after a sensitive word or end within REACH before it, and the lines they go on in.

    Where sensitive words stand inside a key-like run, what follows the first is a
    candidate up to the next one that is a word of its own, and so on; letters that
    spell one amid others don't cut a key. Each run is looked at a bounded number of
    times, so the work grows with the text.
    """
    found: dict[int, int] = {}
    low = text.lower()
    if not any(word in low for word in _HINTS):
        return []
    runs = [m.span() for m in _KEYLIKE.finditer(text)]
    starts, ends = [s for s, _ in runs], [e for _, e in runs]
    open_run, piece = -1, 0
    for hint in _SENSITIVE.finditer(text):
        begin, end = hint.span()
        if text[max(0, begin - 1) : end + 1] == MARK:
            continue
        k = bisect_right(starts, end) - 1
        if k >= 0 and starts[k] < end < ends[k]:
            if k != open_run:
                open_run, piece = k, end
            elif not (text[begin - 1].isalnum() and text[end].isalnum()):
                found.pop(piece, None)
                if begin - piece >= 16:
                    found[piece] = begin
                piece = end
            if ends[k] - piece >= 16:
                found[piece] = ends[k]
        for k in range(bisect_left(starts, end), bisect_right(starts, end + REACH)):
            found[starts[k]] = ends[k]
        for k in range(bisect_right(ends, begin - REACH), bisect_left(ends, begin)):
            found[starts[k]] = ends[k]
    for end in list(found.values()):
        while (m := _NEXT.match(text, end)) and m.start(1) not in found:
            found[m.start(1)] = end = m.end(1)
    return sorted(found.items())


def pathlike(word: str) -> bool:
    """Whether a string is a path, a host or a module: words of one case, short numbers and versions between points and slashes."""
    pieces = [p for p in _SEPARATORS.split(word) if p]
    return len(pieces) > 1 and ("." in word or "/" in word) and all(map(_PLAIN.fullmatch, pieces))


def _around(text: str, start: int, end: int) -> str:
    return text[max(0, start - CONTEXT) : start] + text[end : end + CONTEXT]


def private_keys(text: str, min_novelty: float) -> list[tuple[int, int, float]]:
    """(start, end, novelty) of armoured private keys with a novel line; one without an end goes as far as its lines do."""
    if "PRIVATE KEY" not in text:
        return []
    begins, out = list(_BEGIN.finditer(text)), []
    for m, limit in zip(begins, [b.start() for b in begins[1:]] + [len(text)] * bool(begins), strict=True):
        stop = _END.search(text, m.end(), limit)
        end = stop.end() if stop else m.end()
        while not stop and (line := _PEM_LINE.match(text, end)):
            end = line.end()
        lines = [w for w in _KEYLIKE.finditer(text, m.end(), stop.start() if stop else end) if any(c.isalnum() for c in w.group())]
        part = max((novelty(w.group(), _around(text, m.start(), end)) for w in lines if strange(w.group(), "")), default=0.0)
        if part >= min_novelty:
            out.append((m.start(), end, part))
    return out


class _Sweep:
    """Finds the spans that meet others; both come in the order of their starts."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans, self.ends = spans, list(accumulate((e for _, e in spans), max))
        self.starts = [s for s, _ in spans]

    def meets(self, start: int, end: int) -> list[int]:
        """Which spans share a character with [start, end), in order."""
        first, last = bisect_right(self.ends, start), bisect_left(self.starts, end)
        return [k for k in range(first, last) if self.spans[k][1] > start]


def scan(text: str | None, min_novelty: float = MIN_NOVELTY) -> list[tuple[int, int, int, float | None]]:
    """(start, kind number, end, novelty) of all spans by start, then kind.

    Null counts as empty. Base spans all stay; one that a candidate meets carries
    its novelty, others null. A novel span may overlap base spans that it extends
    beyond by something key-like, and never lies within them.
    """
    if not text:
        return []
    base = base_spans(text)
    keys = private_keys(text, min_novelty)
    new, measured = [(s, 3, e, v) for s, e, v in keys], {}
    near, beside = _Sweep([(s, e) for s, e, _ in keys]), _Sweep([(s, e) for s, _, e in base])
    for start, end in candidates(text):
        if near.meets(start, end):
            continue
        around = _around(text, start, end)
        part = novelty(text[start:end], around)
        inside = [base[k] for k in beside.meets(start, end)]
        for b in inside:
            measured[b] = max(part, measured.get(b, 0.0))
        rest, at = [], start  # what base spans leave of it
        for s, _, e in inside:
            rest.append(text[at : max(at, s)])
            at = max(at, e)
        rest.append(text[at:end] if at < end else "")
        if part >= min_novelty and not pathlike(text[start:end]) and any(strange(r, around) for r in rest if r):
            new.append((start, 3, end, part))
            # the last line of a key over several lines may be short
            if end - start >= 40 and (m := _LAST.match(text, end)) and not beside.meets(m.start(1), m.end(1)):
                new.append((m.start(1), 3, m.end(1), part))
    new = list({s[:3]: s for s in new}.values())
    return sorted([(*b, measured.get(b)) for b in base] + new, key=lambda s: s[:3])


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_novelty: float = MIN_NOVELTY) -> DataFrame:
    """(doc_id, spans): one row per row of `docs`, spans in code points, end exclusive, by start and then kind.

    Whole texts are scanned, however long; null and empty texts have no spans.
    Ids may be null or repeat. Other columns of `docs` are not read.
    """

    def each(batches):
        for batch in batches:
            out = [
                [{"kind": KINDS[k], "start": s, "end": e, "novelty": v} for s, k, e, v in scan(t.as_py(), min_novelty)]
                for t in batch.column(1)
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(each, OUT)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = MARK, min_novelty: float = MIN_NOVELTY) -> DataFrame:
    """`docs` with every span of its texts (overlapping ones joined) replaced by `mark`; other columns stay as they are."""
    schema = docs.schema
    at = schema.fieldNames().index(text_col)

    def clean(text: str | None) -> str | None:
        out, done = [], 0
        for start, _, end, _ in scan(text, min_novelty):
            if start >= done:
                out += [text[done:start], mark]
            done = max(done, end)
        return "".join([*out, text[done:]]) if out else text

    def each(batches):
        for batch in batches:
            texts = pa.array([clean(t.as_py()) for t in batch.column(at)], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts)

    return docs.mapInArrow(each, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda s: s.kind != "novel")), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        count("novel").alias("n_novel"),
    )


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of `query`: how many base spans of each kind."""
    return query(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


_ASSIGN_SQL = r"""(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
COUNTS_SQL = f"""
SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '{_ASSIGN_SQL}', 1), lambda x: len(x) >= 6)) AS n_assign,
       len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: len(x) >= 20)) AS n_access,
       len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: len(x) >= 24)) AS n_hex
FROM documents
"""
