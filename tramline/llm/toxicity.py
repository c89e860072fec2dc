"""Toxicity by a gapped-subsequence string kernel, Nyström landmarks and a linear SVM.

A text is cut into sentences and a sentence into units: words in lower case without
punctuation, and runs of single characters ("i d i o t") joined. The kernel of two
units counts common subsequences of four characters, each weighted by DECAY to the
power of the length it spans in either unit (spans over SPAN count nothing), so an
insult with inserted characters stays near the plain one. A sentence's kernel with a
landmark unit is the largest of its units'. Nyström features (kernels with all
landmarks, whitened by the landmarks' own kernel matrix) go into a linear SVM, trained
by Newton steps on the squared hinge loss over sentences. Labels come by document: sentences
of clean documents are clean; of a toxic document, the sentence that looks worst under
the current model counts as toxic, chosen again in each round. Each sentence is also
learnt with a character put into its likeliest unit. A document scores as
its worst sentence, mapped to 0..1 by a logistic curve fitted on the training rows.

Training reads a bounded sample of the labelled rows: at most SAMPLE_ROWS of each
class, those of the smallest hashed ids, in one task. Scoring reads every whole text.

Defined results: a null or empty text scores as a sentence without units; rows with a
null label are not learnt from; equal rows score equally; other columns are dropped.
Without labels of both classes every score is 0.
"""

import pickle
import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import common

LENGTH = 4
DECAY = 0.8
SPAN = 7
# Marks around a unit: all but one before it, so that how it begins counts most.
FRAME = 3
POWER = 2
FLOOR = 0.1
LANDMARKS = 96
SAMPLE_ROWS = 1_500
ROUNDS = 4
SEED = 9
RIDGE = 1.0
# Characters are told apart modulo this; code points below it stay distinct by rule.
ALPHABET = 48
# Units longer than this are cut into parts of it; no landmark comes near it.
UNIT_CHARS = 64
LANDMARK_CHARS = 24
# Known tokens, and bytes of their kernels, that a scorer keeps.
_CACHE = 150_000
_CACHE_BYTES = 32 << 20
# Rows and columns of the training matrix that are copied in double precision at a time.
_SVM_ROWS, _SVM_COLUMNS = 8192, 32
_ODD = -1

_ENDS = re.compile(r"(?<=[.!?])\s|[\n\r]")
_DROPPED = re.compile(r"[\W_]+")
_PICKS = [(0, *rest) for rest in combinations(range(1, SPAN), LENGTH - 1)]
_WEIGHT = np.array([DECAY ** (pick[-1] + 1) for pick in _PICKS])


def normal(token: str) -> str:
    return _DROPPED.sub("", token.lower())


def sentences(text: str) -> list[list[str]]:
    """Units of each sentence; sentences without units are left out."""
    out = []
    for sentence in _ENDS.split(text):
        words = list(filter(None, map(normal, sentence.split())))
        units = [w for w in words if len(w) > 1] + joined(words)
        if units:
            out.append([part for u in units for part in parts_of(u)])
    return out


def joined(words: list[str]) -> list[str]:
    """Runs of at least two single characters; a lone one is no unit."""
    runs = "".join(w if len(w) == 1 else " " for w in words).split()
    return [r for r in runs if len(r) > 1]


def parts_of(unit: str) -> list[str]:
    return [unit[i : i + UNIT_CHARS] for i in range(0, len(unit), UNIT_CHARS)]


def _codes(units: list[str], length: int) -> np.ndarray:
    """Subsequence codes of units of one length, framed by 1: (units, starts, picks)."""
    points = np.frombuffer("".join(units).encode("utf-32-le"), "<u4").reshape(len(units), length)
    framed = np.zeros((len(units), length + FRAME + SPAN), np.int32)
    framed[:, : length + FRAME] = 1
    framed[:, FRAME - 1 : length + FRAME - 1] = points % (ALPHABET - 2) + 2
    starts = length + FRAME + 1 - LENGTH
    out = np.empty((len(units), starts, len(_PICKS)), np.int32)
    for p, pick in enumerate(_PICKS):
        code = framed[:, :starts].copy()
        for k in pick[1:]:
            code *= ALPHABET
            code += framed[:, k : k + starts]
        code[:, max(0, length + FRAME - pick[-1]) :] = 0  # it ends beyond the unit
        out[:, :, p] = code
    return out


def _norm(length: int) -> float:
    """What a unit of this length without repeated characters has as kernel with itself."""
    room = np.maximum(0, length + FRAME - np.array([pick[-1] for pick in _PICKS]))
    return float((room * _WEIGHT**2).sum())


@dataclass(frozen=True)
class Landmarks:
    """The units, and for each subsequence code the landmarks that have it."""

    units: list[str]
    place: np.ndarray  # code -> 1 + row in `first`, 0 for none
    first: np.ndarray  # row -> start in `unit` and `weight`, with an end
    unit: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, units: list[str]) -> "Landmarks":
        sums: dict[tuple[int, int], float] = {}
        for z, u in enumerate(units):
            for codes in _codes([u], len(u))[0]:
                for code, weight in zip(codes.tolist(), _WEIGHT, strict=True):
                    if code:
                        sums[code, z] = sums.get((code, z), 0.0) + weight / np.sqrt(_norm(len(u)))
        pairs = sorted(sums)
        codes = np.array([c for c, _ in pairs])
        start = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        place = np.zeros(ALPHABET**LENGTH, np.int32)
        place[codes[start]] = 1 + np.arange(len(start))
        unit = np.array([z for _, z in pairs], np.int32)
        weight = np.array([sums[p] for p in pairs])
        return cls(units, place, np.r_[start, len(pairs)], unit, weight)

    def kernels(self, units: list[str]) -> np.ndarray:
        """(units, landmarks): powers of the length-normalised kernel, small ones as 0."""
        out = np.zeros((len(units), len(self.units)), np.float32)
        by_length: dict[int, list[int]] = {}
        for i, u in enumerate(units):
            by_length.setdefault(len(u), []).append(i)
        for length, rows in by_length.items():
            scale = np.sqrt(_norm(length))
            for begin in range(0, len(rows), 512):
                part = rows[begin : begin + 512]
                at = self.place[_codes([units[i] for i in part], length)]
                row, _, pick = np.nonzero(at)
                code = at[at > 0] - 1
                many = self.first[code + 1] - self.first[code]
                source = np.repeat(self.first[code] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
                to = np.repeat(row, many) * len(self.units) + self.unit[source]
                value = self.weight[source] * np.repeat(_WEIGHT[pick], many)
                sums = np.bincount(to, value, len(part) * len(self.units)).reshape(len(part), -1) / scale
                sums = sums**POWER
                out[part] = np.where(sums < FLOOR, 0, sums)
        return out


@dataclass(frozen=True)
class Model:
    landmarks: Landmarks
    linear: np.ndarray  # SVM weights of the kernel values, whitening folded in
    bias: float
    slope: float
    offset: float

    def decide(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.linear + self.bias

    def score(self, decision: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * decision + self.offset, -30, 30))))


@dataclass(frozen=True)
class Sample:
    """Labelled documents as sentences of unit numbers, flat."""

    units: list[str]
    at: np.ndarray  # unit numbers of all sentences
    start: np.ndarray  # of each sentence in `at`
    owner: np.ndarray  # document of each sentence
    label: np.ndarray  # of each document

    @classmethod
    def of(cls, rows) -> "Sample":
        number: dict[str, int] = {}
        at, start, owner, label = [], [], [], []
        for text, y in rows:
            parts = sentences(text or "")
            for sentence in parts:
                start.append(start[-1] + len(at[-1]) if start else 0)
                at.append(np.array([number.setdefault(u, len(number)) for u in sentence], np.int32))
                owner.append(len(label))
            if parts:
                label.append(y)
        flat = np.concatenate(at) if at else np.zeros(0, np.int32)
        return cls(list(number), flat, np.array(start, int), np.array(owner, int), np.array(label, int))


def choose_landmarks(sample: Sample, most: int) -> list[str]:
    """Units most over-represented in toxic documents, ties by alphabet."""
    sizes = np.bincount(sample.label, minlength=2) + 1
    document = np.repeat(sample.owner, np.diff(np.r_[sample.start, len(sample.at)]))
    seen = np.unique(sample.at.astype(np.int64) * len(sample.label) + document)
    unit, toxic = seen // len(sample.label), sample.label[seen % len(sample.label)] == 1
    counts = [np.bincount(unit[m], minlength=len(sample.units)) for m in (~toxic, toxic)]
    gain = counts[1] * np.log(np.maximum(counts[1], 0.5) / sizes[1] * sizes[0] / (counts[0] + 0.5))
    fits = [i for i in np.flatnonzero((counts[1] > 1) & (gain > 0)) if 2 < len(sample.units[i]) <= LANDMARK_CHARS]
    fits.sort(key=lambda i: (-gain[i], sample.units[i]))
    return [sample.units[i] for i in fits[:most]]


def _pool(landmarks: Landmarks, sample: Sample, pick) -> tuple[np.ndarray, np.ndarray]:
    """Pooled kernels of all sentences, and the same with a character put into the unit
    nearest to a landmark."""
    values = landmarks.kernels(sample.units)
    near = values.max(axis=1)
    ends = np.r_[sample.start[1:], len(sample.at)]
    pooled = np.zeros((len(ends), values.shape[1]), np.float32)
    changed = np.zeros_like(pooled)
    stretched = []
    for row, (a, b) in enumerate(zip(sample.start, ends, strict=True)):
        at = sample.at[a:b]
        best = at[near[at].argmax()]
        values[at].max(axis=0, out=pooled[row])
        if (rest := at[at != best]).size:
            values[rest].max(axis=0, out=changed[row])
        unit, place = sample.units[best], int(pick.integers(1, len(sample.units[best]) + 1))
        stretched.append(unit[:place] + chr(pick.integers(97, 123)) + unit[place:])
    for begin in range(0, len(stretched), 10_000):
        part = slice(begin, begin + 10_000)
        np.maximum(changed[part], landmarks.kernels(stretched[part]), out=changed[part])
    return pooled, changed


def _svm(full: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps, each over the margin's violators.

    The last column of `full` is 1.
    """
    ridge = np.r_[np.full(full.shape[1] - 1, RIDGE), 1e-6]
    w = np.zeros(full.shape[1])

    def decided(w):
        # By parts, since each is copied in double precision.
        return np.concatenate([full[i : i + _SVM_ROWS] @ w for i in range(0, len(full), _SVM_ROWS)])

    def loss(w):
        return (weight * np.maximum(0, 1 - y * decided(w)) ** 2).sum() + (ridge * w * w).sum()

    for _ in range(40):
        short = y * decided(w) < 1
        part = full[short]
        heavy = part * weight[short, None].astype(np.float32)
        gram = heavy.T @ part + np.diag(ridge)
        del part
        sides = [heavy[:, i : i + _SVM_COLUMNS].T @ y[short] for i in range(0, heavy.shape[1], _SVM_COLUMNS)]
        best = np.linalg.solve(gram, np.concatenate(sides))
        del heavy
        step, now = 1.0, loss(w)
        while step > 1e-4 and loss(w + step * (best - w)) > now:
            step /= 2
        if step <= 1e-4 or np.abs(best - w).max() < 1e-6:
            break
        w = w + step * (best - w)
    return w[:-1], float(w[-1])


def _logistic(decision: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve over decisions (Newton, slightly damped)."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * decision + offset, -30, 30)))
        g = np.array([((p - label) * decision).sum() + 0.05 * slope, (p - label).sum()])
        q = p * (1 - p) + 1e-6
        h = np.array([[(q * decision**2).sum() + 0.05, (q * decision).sum()], [(q * decision).sum(), q.sum()]])
        slope, offset = np.array([slope, offset]) - 0.7 * np.linalg.solve(h, g)
    return float(slope), float(offset)


def train(rows: list[tuple[str, int]]) -> Model | None:
    """Fits on (text, 0 or 1); None if a class is missing or no unit tells them apart."""
    sample = Sample.of(rows)
    labels, owner = sample.label, sample.owner
    landmarks = choose_landmarks(sample, LANDMARKS) if len(set(labels)) == 2 else []
    if not landmarks:
        return None
    near = Landmarks.of(landmarks)
    pooled, changed = _pool(near, sample, np.random.default_rng(SEED))
    own = near.kernels(landmarks).astype(float)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    white = (vectors / np.sqrt(np.maximum(values, 1e-3 * values.max()))).astype(np.float32)
    decision = pooled.max(axis=1)  # before the first model: nearness to any landmark
    # Each of these is as large as all sentences' kernels: none is kept longer than it is read.
    x = pooled @ white
    del pooled
    stretched = changed @ white
    del changed
    bounds = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True])
    for _ in range(ROUNDS):
        chosen = labels[owner] == 0
        for a, b in zip(bounds, bounds[1:], strict=False):
            if labels[owner[a]]:
                chosen[a + decision[a:b].argmax()] = True
        y = np.tile(np.where(labels[owner[chosen]], 1.0, -1.0), 2)
        weight = np.where(y > 0, min(20.0, (y < 0).sum() / (y > 0).sum()), 1.0)
        full = np.ones((len(y), x.shape[1] + 1), np.float32)
        np.compress(chosen, x, axis=0, out=full[: len(y) // 2, :-1])
        np.compress(chosen, stretched, axis=0, out=full[len(y) // 2 :, :-1])
        w, bias = _svm(full, y, weight)
        del full
        decision = x @ w + bias
    worst = np.maximum.reduceat(decision, bounds[:-1])
    slope, offset = _logistic(worst, labels[owner[bounds[:-1]]])
    return Model(near, white @ w, float(bias), slope, offset)


class Scorer:
    """Scores texts, with a bounded store of known tokens' kernels."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        # Row 0 is for tokens near no landmark.
        self.rows, self.used = np.zeros((1024, len(self.model.landmarks.units)), np.float32), 1
        self.at: dict[str, int] = {}

    def _learn(self, tokens: set[str]) -> None:
        new = tokens.difference(self.at)
        if len(self.at) + len(new) > _CACHE or self.used * self.rows.itemsize * self.rows.shape[1] > _CACHE_BYTES:
            self._forget()
            new = tokens
        units: dict[str, list[str]] = {}
        for token in new:
            word = normal(token)
            if 1 < len(word) <= UNIT_CHARS:
                units.setdefault(word, []).append(token)
            else:
                self.at[token] = _ODD if word else 0
        words = list(units)
        for begin in range(0, len(words), 20_000):
            part = words[begin : begin + 20_000]
            values = self.model.landmarks.kernels(part)
            near = values.any(axis=1)
            places = np.where(near, self.used - 1 + np.cumsum(near), 0).tolist()
            used = self.used + int(near.sum())
            if used > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((used, values.shape[1]), np.float32)])
            self.rows[self.used : used] = values[near]
            self.used = used
            for word, place in zip(part, places, strict=True):
                for token in units[word]:
                    self.at[token] = place

    def _rarer(self, sentence: str) -> list[str]:
        """Units that are not one token each: joined single characters, parts of long tokens."""
        odd = [normal(t) if self.at[t] == _ODD else "  " for t in sentence.split()]
        return joined(odd) + [part for word in odd if len(word) > UNIT_CHARS for part in parts_of(word)]

    def scores(self, texts: list[str]) -> list[float]:
        self._learn({token for text in texts for token in text.split()})
        at: list[int] = []
        owner: list[tuple[int, int]] = []
        rarer: list[tuple[int, int, str]] = []
        for n, text in enumerate(texts):
            for k, sentence in enumerate(_ENDS.split(text)):
                places = [self.at[t] for t in sentence.split()]
                if any(places):
                    near = [p for p in places if p > 0]
                    at += near
                    owner += [(n, k)] * len(near)
                    if _ODD in places:
                        rarer += [(n, k, unit) for unit in self._rarer(sentence)]
        values = self.rows[at]
        if rarer:
            units = sorted({unit for _, _, unit in rarer})
            place = {u: i for i, u in enumerate(units)}
            more = self.model.landmarks.kernels(units)[[place[u] for _, _, u in rarer]]
            values = np.concatenate([values, more])
            owner += [(n, k) for n, k, _ in rarer]
        worst = np.full(len(texts), self.model.bias)
        if owner:
            of = np.array(owner)
            order = np.lexsort((of[:, 1], of[:, 0]))
            of = of[order]
            starts = np.flatnonzero(np.r_[True, (np.diff(of, axis=0) != 0).any(axis=1)])
            decided = self.model.decide(np.maximum.reduceat(values[order], starts, axis=0))
            np.maximum.at(worst, of[starts, 0], decided)
        return [self.model.score(w) for w in worst]


def fit(sample: DataFrame) -> Model | None:
    """Trains on all rows of a bounded sample, in one task; only the model is returned."""

    common.ship(sample.sparkSession)

    def run(stream):
        common.release()
        rows = sorted(common.records(stream, "id", "text", "y"))
        model = train([(text, y) for _, text, y in rows])
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    found = sample.repartition(1).mapInArrow(run, "model binary").head()
    return pickle.loads(found.model) if found else None


def _one_task(docs: DataFrame, model: Model | None):
    held = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = Scorer(held.value) if held.value else None
        return lambda texts: scorer.scores(texts) if scorer else [0.0] * len(texts)

    return start


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id_column, score) of every row."""
    return common.scored(docs, _one_task(docs, model), text_column, [id_column])


def reject(docs: DataFrame, model: Model | None, from_score: float, text_column: str = "text") -> DataFrame:
    """The documents that score below `from_score`."""
    # Names of their own, since `docs` may have any.
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index(text_column)}"
    known = common.scored(named, _one_task(docs, model), text, named.columns, "score")
    return known.filter(F.col("score") < from_score).drop("score").toDF(*docs.columns)
