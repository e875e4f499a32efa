"""Toxicity by multiple-instance learning.

Labels say which documents are toxic, not where. Each sentence has a score, a
logistic function of its words and their beginnings; a document is toxic if any
of its sentences is (noisy-or: one minus the product of their complements). The
weights are trained from document labels through that product, and the sentence
scores then locate what is offending.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.common import table

#: At most so many labelled rows train the model (the lowest hashes of their ids); scoring covers every row.
TRAIN_ROWS = 5000
#: Features kept: those whose document counts tell the labels apart best.
FEATURES = 4096
#: A feature is in at least so many training documents.
MIN_DOCS = 3
HELD_OUT_OF, SENTENCE_CUT = 5, 0.5
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")
_BLANK = -6.0

SCORED = "doc_id long, score double, predicted int, sentences array<struct<start: int, end: int, score: double>>"


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0


def features(word: str) -> tuple[str, ...]:
    """A lower-case word and its beginnings, which stand for inflected forms."""
    return (f"={word}", *(f"{n}{word[:n]}" for n in (3, 4, 5) if len(word) > n))


class Model:
    """Weights of features and the bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self._words: dict[str, float] = {}

    def word(self, word: str) -> float:
        known = self._words.get(word)
        if known is None:
            if len(self._words) >= 150_000:  # words are unbounded, memory is not
                self._words.clear()
            known = self._words[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return known

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, logit) of each sentence."""
        out = []
        for m in _SENTENCE.finditer(text):
            out.append((m.start(), m.end(), self.bias + sum(map(self.word, set(_WORD.findall(m.group().lower()))))))
        return out

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or of the sentences and the offending ones. A text without sentences scores as one blank sentence."""
        found = self.sentences(text or "")
        z = np.array([x[2] for x in found] or [self.bias])
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        bad = [(s, e, float(q)) for (s, e, _), q in zip(found, p, strict=False) if q >= SENTENCE_CUT]
        return float(1 - np.exp(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())), bad


def training_rows(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text, toxic): at most `rows` labelled texts that aren't held out. Ids labelled more than once count as toxic if any label says so."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    n = usable.count()
    share = min(1.0, 1.05 * rows / max(n, 1))  # so that few more than the bound are sorted
    usable = usable.where(mark < share * (1 << 20)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = usable.orderBy(mark, "doc_id").limit(rows).withColumnRenamed("doc_id", "_labelled")
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.join(F.broadcast(picked), F.col("_id") == F.col("_labelled")).select(F.col("_id").cast("long").alias("id"), F.col("_text").alias("text"), F.expr("CAST(toxic > 0 AS INT)").alias("toxic"))


class Bags:
    """Training documents as arrays: words by number, sentence by sentence."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.words, self.sentence = array("i"), array("i")  # distinct words of sentences
        self.document, self.toxic = array("i"), array("b")  # of a sentence, of a document

    def add(self, text: str, toxic: int) -> None:
        for m in _SENTENCE.finditer(text):
            for w in sorted(set(_WORD.findall(m.group().lower()))):
                self.words.append(self.number.setdefault(w, len(self.number)))
                self.sentence.append(len(self.document))
            self.document.append(len(self.toxic))
        if not self.document or self.document[-1] != len(self.toxic):  # a text without sentences is a blank one
            self.document.append(len(self.toxic))
        self.toxic.append(toxic)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x, np.int64) for x in (self.words, self.sentence, self.document, self.toxic))


def _expand(word: np.ndarray, first: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of `word`, feature) for all features of words, of which word w has flat[first[w] : first[w + 1]]."""
    size = (first[1:] - first[:-1])[word]
    which = np.repeat(np.arange(len(word)), size)
    return which, flat[np.repeat(first[word] - (np.cumsum(size) - size), size) + np.arange(len(which))]


def fit(rows: Iterable[tuple[str, int]], keep: int = FEATURES, steps: int = 300) -> Model:
    """Maximises the likelihood of the document labels of `rows` (text, toxic) under noisy-or. Without both labels no feature has weight."""
    bags = Bags()
    for text, toxic in rows:
        bags.add(text, toxic)
    words, sentence, document, toxic = bags.arrays()
    y = toxic.astype(float)
    if len(set(toxic.tolist())) < 2:
        return Model({}, _BLANK if not y.any() else -_BLANK)
    names: dict[str, int] = {}
    own = [[names.setdefault(f, len(names)) for f in features(w)] for w in bags.number]
    first, flat = np.cumsum([0, *map(len, own)]), np.array([f for fs in own for f in fs], np.int64)
    del own
    n_features = len(names)
    seen = np.zeros((2, n_features))
    of_word = document[sentence]
    cut = np.searchsorted(of_word, np.arange(0, len(y) + 256, 256))
    for a, b in zip(cut[:-1], cut[1:], strict=True):  # documents with each feature, some documents at a time
        which, feature = _expand(words[a:b], first, flat)
        pair = np.unique(of_word[a:b][which] * n_features + feature)
        np.add.at(seen, (toxic[pair // n_features], pair % n_features), 1)
    pos, neg = y.sum(), len(y) - y.sum()
    p, q = (seen[1] + 0.5) / (pos + 1), (seen[0] + 0.5) / (neg + 1)
    worth = np.abs(np.log(p / q)) / np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))
    listed = list(names)
    usable = np.flatnonzero((seen.sum(axis=0) >= MIN_DOCS) & (seen[1] > 0)).tolist()
    best = sorted(usable, key=lambda f: (-worth[f], listed[f]))[:keep]
    at = np.full(n_features, -1)
    at[best] = np.arange(len(best))

    kept = at[flat]  # words have only features that are kept from here on
    size = np.add.reduceat(np.append(kept >= 0, False), first[:-1]) * (first[1:] > first[:-1])
    first, flat = np.cumsum(np.append(0, size)), kept[kept >= 0]
    which, cols = _expand(words, first, flat)
    told, rows_of = np.unique(sentence[which], return_inverse=True)
    sent_doc = document[told]
    blank = np.bincount(document, minlength=len(y)) - np.bincount(sent_doc, minlength=len(y)).astype(float)  # sentences without a feature, all alike
    w = np.zeros(len(best) + 1)  # the last is the bias
    w[-1] = _BLANK
    m, v = np.zeros_like(w), np.zeros_like(w)
    row_at = np.flatnonzero(np.append(True, rows_of[1:] != rows_of[:-1])) if len(rows_of) else np.zeros(0, np.int64)
    by_col = np.argsort(cols, kind="stable")
    col_rows, col_names = rows_of[by_col], cols[by_col]
    col_at = np.flatnonzero(np.append(True, col_names[1:] != col_names[:-1])) if len(cols) else row_at
    of_col = np.zeros(len(best))
    for step in range(1, steps + 1):
        z = (np.add.reduceat(w[cols], row_at) if len(row_at) else np.zeros(0)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p0 = 1 / (1 + np.exp(-np.clip(w[-1], -30, 30)))
        none = np.exp(np.bincount(sent_doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + blank * np.log1p(-p0))
        pull = 1 - y / np.maximum(1 - none, 1e-6)  # of the loss on a sentence's logit, times its p
        g_sent = p * pull[sent_doc]
        if len(col_at):
            of_col[col_names[col_at]] = np.add.reduceat(g_sent[col_rows], col_at)
        grad = np.append(of_col, g_sent.sum() + (p0 * blank * pull).sum()) / len(y)
        grad[:-1] += 1e-4 * w[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model({listed[f]: float(x) for f, x in zip(best, w[:-1], strict=True) if abs(x) > 1e-6}, float(w[-1]))


def _fitted(batches):
    """Fits in one task, which holds arrays of at most TRAIN_ROWS documents; gives the weights, with a null name for the bias."""
    model = fit((text.as_py(), toxic) for batch in batches for text, toxic in zip(batch.column(1), batch.column(2).to_pylist(), strict=True))
    yield pa.RecordBatch.from_arrays([pa.array([*model.weights, None], pa.string()), pa.array([*model.weights.values(), model.bias], pa.float64())], ["feature", "weight"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits on at most `max_rows` labelled rows of `docs` that aren't held out; `labels` has (doc_id, toxic), nulls are no labels.

    The texts go to one task in the order of their ids and only the weights, at
    most FEATURES, come back. No usable label gives a model by which nothing is toxic.
    """
    rows = training_rows(docs, labels, max_rows, id_col, text_col).repartition(1).sortWithinPartitions("id", "text")
    got = rows.mapInArrow(_fitted, "feature string, weight double").collect()
    weights = {r.feature: r.weight for r in got if r.feature is not None}
    return Model(weights, next((r.weight for r in got if r.feature is None), _BLANK))


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, sentences): one row per row of `docs`, from its text alone.

    `sentences` are the offending ones: code point ranges and scores. Whole texts
    count. Null and empty texts score as one blank sentence. Ids may be null or
    repeat; other columns of `docs` are not read.
    """
    sent = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def each(batches):
        for batch in batches:
            got = [model.score(t.as_py()) for t in batch.column(1)]
            score = np.array([s for s, _ in got], float)
            bad = pa.array([[{"start": s, "end": e, "score": p} for s, e, p in b] for _, b in got], sent)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), bad], ["doc_id", "score", "predicted", "sentences"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(each, SCORED)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` without the rows that `toxicity` predicts to be toxic; all columns stay as they are.

    Null and empty texts score as one blank sentence; repeated rows go or stay
    together; an empty table stays empty.
    """
    at = docs.schema.fieldNames().index(text_col)

    def each(batches):
        for batch in batches:
            yield batch.filter(pa.array([model.score(t.as_py())[0] < 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(each, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("sentences").alias("n_sentences"))
