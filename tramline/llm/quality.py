"""Document quality by supervised subword embeddings.

A document is the average of learned vectors of its words and of their character n-grams,
hashed into BUCKETS rows; a softmax layer on it gives the classes. Vectors and layer are
trained together by stochastic gradient descent in numpy, in one task, on a bounded
sample: at most SAMPLE_ROWS labelled rows of each class, those of the smallest hashed
ids. Scoring reads every whole text; a task keeps the summed vector of each distinct word.

Words are what white space separates, with their case and punctuation, since both tell
junk from prose; a run of one word repeated has a feature of its own.

Defined results: a null or empty text scores as a document without features; rows with a
null label are not learnt from; equal rows score equally; other columns are dropped.
Without labels of both classes every score is 0.5.
"""

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tramline.llm import common

SAMPLE_ROWS = 1_500
BUCKETS = 1 << 16
DIMENSIONS = 12
NGRAMS = (2, 3, 4)
EPOCHS = 20
RATE = 0.3
DECAY = 1e-5
SEED = 7
_CACHE = 500_000
# Words are learnt in parts of about so many characters, which bounds the arrays of their n-grams.
_PART_CHARS = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_REPEATED = "\x02repeated"


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of each word's character n-grams and of itself, sorted by word."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(w) + 1 for w in words])
    points = np.frombuffer(("\x01" + "\x01".join(words) + "\x01").encode("utf-32-le"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(words)), sizes)
    last = np.cumsum(sizes)[word]  # place of the mark after the word
    owners, buckets = [np.arange(len(words))], [np.array([zlib.crc32(w.encode()) for w in words], np.uint64)]
    for n in NGRAMS:
        at = np.flatnonzero(np.arange(len(word)) + n - 1 <= last)
        code = np.full(len(at), n, np.uint64)
        for k in range(n):
            code = (code ^ points[at + k]) * _MIX
            code ^= code >> np.uint64(29)
        owners.append(word[at])
        buckets.append(code)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return owner[order], (np.concatenate(buckets)[order] % np.uint64(BUCKETS)).astype(np.int64)


def words_of(text: str) -> list[str]:
    """The words, and a mark for every one that repeats the word before it."""
    words = text.split()
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return words + [_REPEATED] * again


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray  # (BUCKETS, DIMENSIONS)
    layer: np.ndarray  # (DIMENSIONS, 2)
    bias: np.ndarray  # (2,)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, int]]) -> Model | None:
    """Fits on (text, 0 or 1) in the given order; None if a class is missing."""
    labels = np.array([y for _, y in rows], int)
    if len(set(labels.tolist())) < 2:
        return None
    texts = [words_of(text or "") for text, _ in rows]
    number = {w: i for i, w in enumerate(dict.fromkeys(w for words in texts for w in words))}
    owner, bucket_of = features(list(number))
    first = np.searchsorted(owner, np.arange(len(number) + 1))
    docs = []
    for words in texts:
        parts = [bucket_of[first[i] : first[i + 1]] for i in map(number.__getitem__, words)]
        bucket, count = np.unique(np.concatenate(parts) if parts else bucket_of[:0], return_counts=True)
        docs.append((bucket, (count / max(1, count.sum())).astype(np.float32)))
    draw = np.random.default_rng(SEED)
    vectors = (draw.standard_normal((BUCKETS, DIMENSIONS)) / DIMENSIONS).astype(np.float32)
    layer = (draw.standard_normal((DIMENSIONS, 2)) / DIMENSIONS).astype(np.float32)
    bias = np.zeros(2, np.float32)
    weight = len(labels) / (2 * np.bincount(labels, minlength=2))
    # Adaptive rates: rare features need longer steps than common ones.
    seen = np.full(BUCKETS, 1e-6, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for d in draw.permutation(len(docs)):
            bucket, share = docs[d]
            mean = share @ vectors[bucket]
            push = _softmax((mean @ layer + bias)[None, :])[0]
            push[labels[d]] -= 1
            push *= weight[labels[d]]
            back = layer @ push
            layer -= rate * (np.outer(mean, push) + DECAY * layer)
            bias -= rate * 0.1 * push
            if len(bucket):
                size = share**2 * (back @ back)
                seen[bucket] += size
                vectors[bucket] -= rate * share[:, None] * back / np.sqrt(seen[bucket])[:, None]
    return Model(vectors, layer, bias)


def _parts(words: set[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for word in words:
        if part and size + len(word) > _PART_CHARS:
            yield part
            part, size = [], 0
        part.append(word)
        size += len(word) + 1
    if part:
        yield part


class Scorer:
    """Scores texts, with a bounded store of distinct words' summed vectors."""

    def __init__(self, model: Model):
        self.model = model
        # Only the layer's image of a vector is needed, and the number of features.
        self.image = np.c_[model.vectors @ model.layer, np.ones(BUCKETS)].astype(np.float64)
        self._forget()

    def _forget(self) -> None:
        self.sums, self.at = np.zeros((1024, 3)), {}

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self.at)
        if len(self.at) + len(new) > _CACHE:
            self._forget()
            new = words
        for part in _parts(new):
            owner, bucket = features(part)
            starts = np.searchsorted(owner, np.arange(len(part)))
            used = len(self.at)
            if used + len(part) > len(self.sums):
                self.sums = np.concatenate([self.sums, np.zeros((used + len(part), 3))])
            self.sums[used : used + len(part)] = np.add.reduceat(self.image[bucket], starts, axis=0)
            self.at.update(zip(part, range(used, used + len(part)), strict=True))

    def scores(self, texts: list[str]) -> list[float]:
        docs = [words_of(t) for t in texts]
        self._learn({w for words in docs for w in words})
        means = np.zeros((len(docs), 2))
        for d, words in enumerate(docs):
            if words:
                total = self.sums[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))].sum(axis=0)
                means[d] = total[:2] / total[2]
        return _softmax(means + self.model.bias)[:, 1].tolist()


def fit(sample: DataFrame) -> Model | None:
    """Trains on all rows (id, text, y) of a bounded sample, in one task."""

    common.ship(sample.sparkSession)

    def run(stream):
        rows = sorted(common.records(stream, "id", "text", "y"))
        model = train([(text, y) for _, text, y in rows])
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    found = sample.repartition(1).mapInArrow(run, "model binary").head()
    return pickle.loads(found.model) if found else None


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id_column, score) of every row: the probability of class 1."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def one_task():
        scorer = Scorer(held.value) if held.value else None
        return lambda texts: scorer.scores(texts) if scorer else [0.5] * len(texts)

    return common.scored(docs, one_task, text_column, [id_column])
