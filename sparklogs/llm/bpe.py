"""BPE encoding and decoding by speculation and verification.

For each new word a greedy longest match proposes tokens. Proposed tokens are the
merge result exactly when every token is what its own text merges to and every
adjacent pair is what its joint text merges to, because the first merge across a
border would also happen in that pair alone. All adjacent pairs of a batch are
tested at once by walking down the merge trees on both sides of their borders;
only words with a failing pair go through the merges themselves.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.common import table

#: What the tokenizer's pre-tokenizer keeps; white space is Unicode's White_Space.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0  -     　\p{L}\p{N}]+")
#: What str.split() also takes for white space.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Chunks between white space that one Python worker remembers, and words.
MEMORY = 400_000
#: Bytes of a word up to which words are merged together.
LONG = 64
_NEVER = np.int64(1) << 40

OUT = "doc_id long, ids binary, decoded string"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from U+0100 on in order."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def _unknown(c: str) -> bool:
    """Whether Python's Unicode tables don't know a character, so that newer ones may class it otherwise."""
    return unicodedata.category(c) == "Cn"


class MergeTrees:
    """How tokens split into the two that were merged, and the test whether text merges across the border of two tokens.

    Merges go by rank. Where no merge comes before those of its parts, the tokens at
    a border at some time are those of the two trees with a lower rank and a parent
    that comes later. The border holds if at no time the two that face each other
    have a merge that comes before their parents' (of equal ones the left first).
    """

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]], size: int):
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        twice = np.zeros(size, bool)
        for (a, b), (rank, whole) in merges.items():
            twice[whole] |= self.rank[whole] >= 0
            self.rank[whole], self.left[whole], self.right[whole] = rank, a, b
        pairs = np.array([(a << 32 | b, r) for (a, b), (r, _) in merges.items()], np.int64).reshape(-1, 2)
        order = np.argsort(pairs[:, 0])
        self.keys, self.ranks = pairs[order, 0], pairs[order, 1]
        self.made = np.array([whole for _, whole in merges.values()], np.int64)  # by rank
        made = np.flatnonzero(self.rank >= 0)
        late = (self.rank[self.left[made]] >= self.rank[made]) | (self.rank[self.right[made]] >= self.rank[made])
        #: Tokens that their own text merges to.
        self.sound = ~twice
        self.sound[made[late]] = False
        self.sound[made] &= self.holds(self.left[made], self.right[made], own=True)
        for token in made[np.argsort(self.rank[made])].tolist():
            self.sound[token] &= self.sound[self.left[token]] & self.sound[self.right[token]]

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER) if len(self.keys) else np.full(len(key), _NEVER)

    def holds(self, a: np.ndarray, b: np.ndarray, own: bool = False) -> np.ndarray:
        """Whether sound tokens a and b stay apart when their joint text is merged; `own`: apart from the merge of the two themselves."""
        good = np.ones(len(a), bool)
        rest = np.arange(len(a))
        until_a, until_b = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        first = own
        while len(rest):
            if not first:
                rank = self.merge_rank(a, b)
                met = (rank < until_a) & (rank <= until_b) & (rank < _NEVER)
                good[rest[met]] = False
            else:
                met = np.zeros(len(rest), bool)
            first = False
            on = ~met & ((self.rank[a] >= 0) | (self.rank[b] >= 0))
            a, b, until_a, until_b, rest = a[on], b[on], until_a[on], until_b[on], rest[on]
            down = self.rank[a] > self.rank[b]  # the later of the two comes apart
            until_a, until_b = np.where(down, self.rank[a], until_a), np.where(down, until_b, self.rank[b])
            a, b = np.where(down, self.right[a], a), np.where(down, b, self.left[b])
        return good


class WordBpe:
    """A tokenizer file of kind "BPE with word ends": NFC, lower case, words, bytes, merges with an end-of-word mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        vocab = model["vocab"]
        self.text = {i: t for t, i in (vocab | self.special).items()}
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.inner: dict[bytes, int] = {}  # token bytes to id, inside a word
        self.final: dict[bytes, int] = {}  # and at its end
        for token, i in vocab.items():
            last = token.endswith(self.end) and len(token) > len(self.end)
            body = token[: -len(self.end)] if last else token
            if all(c in of_letter for c in body):
                (self.final if last else self.inner)[bytes(of_letter[c] for c in body)] = i
        self.longest: dict[bytes, int] = {}  # of the tokens inside words that begin with two bytes
        for token in self.inner:
            self.longest[token[:2]] = max(len(token), self.longest.get(token[:2], 0))
        self.longest_final = max(map(len, self.final))
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.trees = MergeTrees(self.merges, max(self.text) + 1)
        self.inner_byte, self.final_byte = (np.array([known[bytes([b])] for b in range(256)], np.int64) for known in (self.inner, self.final))
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.checked = self.failed = 0
        library = tokenizers.Tokenizer.from_file(path)
        self.normalizer = library.normalizer
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]
        self.splitter = tokenizers.pre_tokenizers.Split(tokenizers.Regex(pattern["pattern"]["Regex"]), pattern["behavior"].lower(), pattern["invert"])

    def merge(self, word: bytes, ended: bool = True) -> list[int]:
        """The exact merges: the lowest rank first, the leftmost of equals; `ended`: the last byte carries the word end."""
        ids = [self.inner[word[i : i + 1]] for i in range(len(word))]
        if ended:
            ids[-1] = self.final[word[-1:]]
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(self.merges[p][0], i, *p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in self.merges]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.merges[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (p := (ids[left], ids[right])) in self.merges:
                    heapq.heappush(heap, (self.merges[p][0], left, *p))
        return [i for i in ids if i >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match from the left."""
        inner, final, longest = self.inner, self.final, self.longest
        out, at, last = [], 0, len(word) - 1
        while last - at >= self.longest_final or (token := final.get(word[at:])) is None:
            stop = min(last, at + longest.get(word[at : at + 2], 1))
            while (token := inner.get(word[at:stop])) is None:
                stop -= 1
            out.append(token)
            at = stop
        out.append(token)
        return out

    def tokens(self, words: list[str]) -> list[bytes]:
        """Ids of words: proposals, the test of all their pairs at once, merges for those that fail."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        tokens = [self.propose(w) for w in raw]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.fromiter((t for ts in tokens for t in ts), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        inside = np.ones(len(flat), bool)  # tokens with one of the same word before them
        inside[starts] = False
        at = np.flatnonzero(inside)
        fine = self.trees.sound[flat]
        fine[at] &= self.trees.holds(flat[at - 1], flat[at])
        good = np.logical_and.reduceat(fine, starts)
        self.checked += len(words)
        whole = flat.astype("<u4").tobytes()
        out = [whole[4 * s : 4 * e] for s, e in zip(starts.tolist(), (starts + sizes).tolist(), strict=True)]
        failing = np.flatnonzero(~good).tolist()
        self.failed += len(failing)
        for i, ids in zip(failing, self.merge_all([raw[i] for i in failing]), strict=True):
            out[i] = ids
        return out

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """`merge` of many words at once: in each round every word merges its pairs of the lowest rank; very long words go one by one."""
        out: list[bytes | None] = [np.array(self.merge(w), "<u4").tobytes() if len(w) > LONG else None for w in words]
        some = [i for i, done in enumerate(out) if done is None]
        if not some:
            return out
        sizes = np.array([len(words[i]) for i in some], np.int64)
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join([words[i] for i in some]), np.uint8)
        ids, owner = self.inner_byte[raw], np.repeat(np.arange(len(some)), sizes)
        ids[ends - 1] = self.final_byte[raw[ends - 1]]
        done_ids, done_owner = [], []
        while len(ids):
            rank = np.full(len(ids), _NEVER)
            same = owner[1:] == owner[:-1]
            rank[:-1][same] = self.trees.merge_rank(ids[:-1][same], ids[1:][same])
            starts = np.flatnonzero(np.append(True, ~same))
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(ids))))
            over = low == _NEVER  # words without a merge
            done_ids.append(ids[over])
            done_owner.append(owner[over])
            hit = np.flatnonzero((rank == low) & ~over)
            # of a run of overlapping pairs every other one, from the left
            head = np.append(True, hit[1:] != hit[:-1] + 1)[: len(hit)]
            run = np.maximum.accumulate(np.where(head, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            ids[hit] = self.trees.made[low[hit]]
            keep = ~over
            keep[hit + 1] = False
            ids, owner = ids[keep], owner[keep]
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        whole, cut = ids[order].astype("<u4").tobytes(), np.searchsorted(owner[order], np.arange(len(some) + 1)).tolist()
        for k, i in enumerate(some):
            out[i] = whole[4 * cut[k] : 4 * cut[k + 1]]
        return out

    def word_ids(self, split: list[list[str]]) -> list[bytes]:
        """Ids of lists of words."""
        new = list({w for ws in split for w in ws if w not in self.words})
        if len(self.words) + len(new) > MEMORY:
            self.words.clear()
            new = list({w for ws in split for w in ws})
        self.words.update(zip(new, self.tokens(new), strict=True))
        return [b"".join([self.words[w] for w in ws]) for ws in split]

    def chunks(self, text: str) -> list[str | bytes]:
        """The parts of a text that are encoded by themselves, or ids that need no more work, as of special tokens, which are found before anything else.

        No word spans white space. Code points that Python's tables don't know are
        left to the library's own normalizer and splitter.
        """
        if self.split and "<" in text and len(parts := self.split.split(text)) > 1:
            return [x for p in parts if p for x in ([self.special[p].to_bytes(4, "little")] if p in self.special else self.chunks(p))]
        if not text.isascii():
            if any(map(_unknown, set(text))):
                text = self.normalizer.normalize_str(text)
                return self.word_ids([[text[s:e] for _, (s, e) in self.splitter.pre_tokenize_str(text)]])
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # a final sigma is an ordinary one here
                text = text.replace("Σ", "σ")
        text = text.lower()
        if any(s in text for s in _SEPARATORS):
            return _WORDS.findall(text)
        return text.split()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out = []
        held, size = [], 0
        for i, text in enumerate(texts):
            held.append(self.chunks(text))
            size += len(held[-1])
            if size < MEMORY // 4 and i + 1 < len(texts):
                continue
            everything = {w for ws in held for w in ws if w.__class__ is str}
            new = [w for w in everything if w not in self.known]
            if len(self.known) + len(new) > MEMORY:
                self.known.clear()
                new = list(everything)
            self.known.update(zip(new, self.word_ids([_WORDS.findall(c) for c in new]), strict=True))
            for ws in held:
                try:
                    out.append(b"".join(map(self.known.__getitem__, ws)))
                except KeyError:  # parts that are ids already
                    out.append(b"".join([w if w.__class__ is bytes else self.known[w] for w in ws]))
            held, size = [], 0
        return out

    def decode(self, ids: bytes) -> str:
        """The tokens with a space between, special ones too, as a tokenizer without a decoder gives them."""
        return " ".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """One tokenizer per Python worker, with what it has learnt."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): one row per row of `docs`; ids are little-endian unsigned 32-bit integers.

    `path`: a tokenizer file that every executor has. Whole texts are encoded; null
    and empty texts have no ids. Ids may be null or repeat. Other columns of
    `docs` are not read.
    """

    def each(batches):
        bpe = loaded(path)
        for batch in batches:
            ids = bpe.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(each, OUT)


def bpe_decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) from ids as `bpe_encode` gives them; null counts as no ids."""

    def each(batches):
        bpe = loaded(path)
        for batch in batches:
            texts = [bpe.decode(i or b"") for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(each, "doc_id long, decoded string")


def bpe_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): as `bpe_encode`, with digests in place of ids and texts."""

    def each(batches):
        bpe = loaded(path)
        for batch in batches:
            ids = bpe.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            cols = [
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in ids], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
