"""Toxicity by a support vector machine with a subsequence string kernel.

The kernel compares two words by the triples of letters they share in order,
gaps allowed: a triple that spans ``s`` letters weighs ``DECAY ** (s - 3)``, so
inserted letters cost a little and marks, which are dropped, cost nothing; the
value is divided by a size of each word (its triples' weights), which keeps a kernel. A
sentence is as toxic as its worst word, a document as its worst sentence.

Fitting (on the driver, on bounded samples of labelled documents): sentences of
toxic documents are positive through one witness word each, those of clean
documents negative through all their words. Landmarks are frequent witnesses and
clean words that come close; the Nyström map turns kernel values with them into
vectors for a linear SVM (frequent witnesses also with a letter inserted at a
random place, as insults are often written); witnesses are picked again under the fitted machine
and the hardest clean words are added, a few times over. The machine is linear
in the kernel, so it folds into one weight per letter triple, and scoring a word
is a sum over its triples, exact for the fitted machine.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import hold, text_slices
from snaplake.llm.labels import fold, labelled_texts

SAMPLE = {1: 2500, 0: 4000}
BITS = 18
SPAN = 6
DECAY = 0.6
WIDTH = 20
LANDMARKS = 240
NEGATIVES = 8000
ROUNDS = 4
KEPT = 250_000
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
_SPELLED = re.compile(r"(?<!\S)\w(?:[\s.\-_*]{1,3}\w){3,}(?!\w)")


def tokens_of(text: str) -> list[str]:
    """Lower-cased words, and words spelled out letter by letter as one."""
    text = text.lower()
    out = text.split()
    if spelled := _SPELLED.findall(text):
        out += ["".join(c for c in s if c.isalnum()) for s in spelled]
    return out


def parts_of(token: str) -> list[str]:
    """The letters and digits of a token, in overlapping pieces of ``WIDTH``."""
    clean = "".join(c for c in token if c.isalnum())
    if len(clean) <= WIDTH:
        return [clean] if len(clean) > 2 else []
    return [clean[i:i + WIDTH] for i in range(0, len(clean) - WIDTH // 2, WIDTH // 2)]


def triples(words: list[str]) -> Iterator[tuple[np.ndarray, float, np.ndarray]]:
    """For every gap pattern: feature numbers per word and place, the weight, and
    which places hold a triple."""
    flat = np.zeros((len(words), WIDTH), np.int64)
    for i, w in enumerate(words):
        flat[i, :len(w)] = np.frombuffer(w.encode("utf-32-le"), "<u4")
    for a, b in STEPS:
        x, y, z = flat[:, :-b], flat[:, a:a - b], flat[:, b:]
        h = (x * 0x9E3779B1 + y * 0x85EBCA77 + z * 0xC2B2AE3D) & 0xFFFFFFFFFFFF
        yield (h ^ (h >> 21)) & ((1 << BITS) - 1), DECAY ** (b - 2), z > 0


def norms(words: list[str]) -> np.ndarray:
    total = np.zeros(len(words))
    for _, weight, there in triples(words):
        total += weight * weight * there.sum(1)
    return np.sqrt(np.maximum(total, 1e-12))


def word_scores(words: list[str], weights: np.ndarray, step: int = 4096) -> np.ndarray:
    """Sum of the triples' weights over the norm, for each word."""
    out = np.zeros(len(words))
    for at in range(0, len(words), step):
        part = words[at:at + step]
        total, size = np.zeros(len(part)), np.zeros(len(part))
        for idx, weight, there in triples(part):
            total += weight * (weights[idx] * there).sum(1)
            size += weight * weight * there.sum(1)
        out[at:at + step] = total / np.sqrt(np.maximum(size, 1e-12))
    return out


def features(words: list[str]) -> dict[int, float]:
    """Explicit kernel features of one word, normalised."""
    out: Counter = Counter()
    for idx, weight, there in triples(words):
        for i in idx[0][there[0]]:
            out[int(i)] += weight
    size = norms(words)[0]
    return {k: v / size for k, v in out.items()}


class Kernel:
    """Kernel values with a list of landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        own = [features([w]) for w in landmarks]
        self.index = np.unique(np.array([k for f in own for k in f], np.int64))
        self.table = np.zeros((len(self.index) + 1, len(landmarks)), np.float32)
        for j, f in enumerate(own):
            for k, v in f.items():
                self.table[np.searchsorted(self.index, k), j] = v

    def __call__(self, words: list[str], step: int = 1024) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        for at in range(0, len(words), step):
            part = words[at:at + step]
            for idx, weight, there in triples(part):
                row = np.minimum(np.searchsorted(self.index, idx), len(self.index) - 1)
                row = np.where(there & (self.index[row] == idx), row, len(self.index))  # the last row is zero
                for p in np.flatnonzero((row < len(self.index)).any(0)):
                    out[at:at + step] += np.float32(weight) * self.table[row[:, p]]
            out[at:at + step] /= norms(part)[:, None]
        return out

    def fold(self, beta: np.ndarray) -> np.ndarray:
        weights = np.zeros(1 << BITS, np.float32)
        weights[self.index] = self.table[:-1] @ beta
        return weights


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-5, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge, L2) by accelerated gradient descent."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], 1)
    top = np.ones(x.shape[1])
    for _ in range(30):  # largest curvature, by power iteration
        top = x.T @ (cost * (x @ top))
        size = np.linalg.norm(top)
        top /= size
    step = 1 / (2.1 * size + ridge)
    w = z = np.zeros(x.shape[1])
    t = 1.0
    for _ in range(rounds):
        miss = np.maximum(0, 1 - y * (x @ z))
        after = z - step * (ridge * z - 2 * x.T @ (cost * miss * y))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        z = after + (before - 1) / t * (after - w)
        w = after
    return w[:-1], float(w[-1])


def calibrate(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from margins to chances of label 1."""
    middle, width = f.mean(), f.std() + 1e-9
    u = (f - middle) / width
    soft = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * u + b, -30, 30)))
        r, s = p - soft, p * (1 - p) + 1e-6
        g = np.array([(r * u).sum() + 1e-3 * a, r.sum()])
        h = np.array([[(s * u * u).sum() + 1e-3, (s * u).sum()], [(s * u).sum(), s.sum()]])
        da, db = np.linalg.solve(h, g)
        size = min(1.0, 2 / (abs(da) + abs(db) + 1e-12))
        a, b = a - size * da, b - size * db
    return a / width, b - a * middle / width


class Model:
    """Weights of letter triples, and the curve from margins to scores."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float, base: float):
        self.weights, self.bias, self.slope, self.offset, self.base = weights, bias, slope, offset, base
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """The largest margin of a word of each text; without words, minus one."""
        if len(self.known) > KEPT:
            self.known.clear()
        cut = [tokens_of(t or "") for t in texts]
        new = list(set().union(*cut).difference(self.known))
        parts = [(t, p) for t in new for p in parts_of(t)]
        self.known.update(dict.fromkeys(new, -1.0))
        if parts:
            for (t, _), f in zip(parts, (word_scores([p for _, p in parts], self.weights) + self.bias).tolist()):
                if f > self.known[t]:
                    self.known[t] = f
        get = self.known.__getitem__
        return np.array([max(map(get, c), default=-1.0) for c in cut])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.base)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -30, 30)))


def distinct(rows: list[tuple[str | None, int]]) -> list[tuple[str | None, int]]:
    """The rows without copies and near copies of earlier ones with the same label:
    texts that share a smallest word hash and at least half their words."""
    firsts: dict[tuple[int, int, int], np.ndarray] = {}
    number: dict[str, int] = {}  # a word is held once, a document as numbers
    out = []
    for text, label in rows:
        words = set((text or "").split())
        raw = [w.encode() for w in words]
        keys = [(label, seed, min((zlib.crc32(w, seed) for w in raw), default=0)) for seed in range(8)]
        own = np.sort(np.array([number.setdefault(w, len(number)) for w in words], np.int32))
        near = {id(firsts[k]): firsts[k] for k in keys if k in firsts}
        common = ((len(np.intersect1d(own, other, assume_unique=True)), len(own) + len(other)) for other in near.values())
        if any(2 * both >= size - both for both, size in common):
            continue
        for k in keys:
            firsts.setdefault(k, own)
        out.append((text, label))
    return out


def train(rows: list[tuple[str | None, int]]) -> Model:
    """Fit on (text, label) rows; copies count once. With one label only, every score is that label's
    value; without rows, zero."""
    rows = distinct(rows)
    y = np.array([label for _, label in rows], int)
    if not len(y) or y.min() == y.max():
        return Model(None, 0, 0, 0, float(y[0]) if len(y) else 0.0)
    first: dict[str, int] = {}
    held = []
    for text, _ in rows:
        words = {p for s in _SENTENCE.split(text or "") for t in tokens_of(s) for p in parts_of(t)}
        held.append(np.array([first.setdefault(w, len(first)) for w in words], np.int32))
    del rows
    every = sorted(first)
    place = np.empty(len(every), np.int32)
    place[[first[w] for w in every]] = np.arange(len(every))
    held = [np.sort(place[doc]) for doc in held]

    # how much more often a triple occurs in toxic than in clean documents
    seen = np.zeros((2, 1 << BITS))
    for doc, label in zip(held, y):
        if len(doc):
            there = np.unique(np.concatenate([idx[ok] for idx, w, ok in triples([every[i] for i in doc]) if w >= DECAY]))
            seen[label, there] += 1
    share = (seen + 0.5) / (np.bincount(y, minlength=2)[:, None] + 1)
    odds = np.log(share[1] / share[0]) * (seen.sum(0) >= 5)
    toxic, clean = np.zeros(len(every)), np.zeros(len(every))
    for doc, label in zip(held, y):
        (toxic if label else clean)[doc] += 1
    own = np.log((toxic + 0.2) / (clean + 0.2) * ((y == 0).sum() / (y == 1).sum()))
    f = word_scores(every, odds.astype(np.float32)) + own
    negative = np.flatnonzero(clean > 0)
    # words of many toxic and hardly any clean documents are witnesses beside the worst of each
    telling = np.flatnonzero((toxic >= 4) & (toxic / (y == 1).sum() > 20 * (clean + 0.5) / (y == 0).sum()))
    told = np.zeros(len(every), bool)
    told[telling] = True
    rng = np.random.default_rng(7)
    met = rng.permutation(negative)[:NEGATIVES]
    for _ in range(ROUNDS):
        witness = Counter(int(doc[np.argmax(f[doc])]) for doc, label in zip(held, y) if label and len(doc) and not told[doc].any())
        witness.update({int(w): int(toxic[w]) for w in telling})
        top = [w for w, _ in witness.most_common()]
        hard = negative[np.argsort(-f[negative], kind="stable")]
        # words that clean documents hold as often are no witnesses
        top = [w for w in top if toxic[w] / (y == 1).sum() > 2 * clean[w] / (y == 0).sum()] or top
        marks = [every[w] for w in dict.fromkeys([*top[:LANDMARKS * 2 // 3], *hard[:LANDMARKS // 3].tolist()])]
        kernel = Kernel(marks)
        gram = kernel(marks).astype(float)
        value, vector = np.linalg.eigh((gram + gram.T) / 2)
        keep = value > 1e-4 * value.max()
        nystroem = vector[:, keep] / np.sqrt(value[keep])
        met = np.union1d(met, hard[:NEGATIVES // 4])
        minus = np.setdiff1d(met, np.array(top, np.int64))
        spread = [w for w in top[:LANDMARKS * 2 // 3] if len(every[w]) >= 5]
        bent = [every[w][:i] + ALPHABET[j] + every[w][i:] for w in spread
                for i, j in zip(rng.integers(1, [len(every[w])] * 2), rng.integers(0, len(ALPHABET), 2))]
        bent = [w[:WIDTH] for w in bent]
        x = kernel([*(every[w] for w in top), *bent, *(every[w] for w in minus)]) @ nystroem.astype(np.float32)
        target = np.r_[np.ones(len(top) + len(bent)), -np.ones(len(minus))]
        cost = np.r_[np.sqrt([witness[w] for w in top]), np.sqrt([witness[w] / 2 for w in spread for _ in range(2)]), np.ones(len(minus))]
        cost = np.where(target > 0, cost / cost[target > 0].sum(), 2 * cost / max(1, len(minus)))
        w, bias = svm(x, target, cost)
        weights = kernel.fold(nystroem @ w)
        f = word_scores(every, weights) + bias
    best = np.array([f[doc].max() if len(doc) else -1.0 for doc in held])
    slope, offset = calibrate(best, y)
    return Model(weights, bias, slope, offset, 0.0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, parts: int = 3, held: int = 1, sample: dict[int, int] | None = None) -> Model:
    """Fit on labelled documents outside fold ``held``; ``sample`` bounds the rows of each label."""
    known = labels.where(fold(F.col("doc_id"), parts) != held)
    rows = labelled_texts(docs, known, "toxic", sample or SAMPLE).orderBy("label", "doc_id").select("text", "label").collect()
    return train([tuple(r) for r in rows])


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a score from 0 to 1 in column ``out``. Null and empty texts get the
    score of a text without words; all rows and other columns stay, and a column named
    ``out`` is replaced."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    docs = docs.drop(out)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a weight per triple and nothing of the corpus
    place = docs.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("toxicity", sent.value.known.clear)
        for batch in text_slices(batches, 256):
            got = sent.value.scores(batch.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], [*batch.schema.names, out])

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(out, DoubleType())]))
