"""Quality classifier by positive-unlabelled learning.

Trusted positives (documents labelled good) and unlabelled web text are all that
the risk sees: a small network minimises the non-negative unbiased risk
``p R+(positives) + max(0, R-(unlabelled) - p R-(positives))`` with the logistic
loss, ``p`` being the estimated share of good documents. When the bracket turns
negative the step goes against it, as the estimator prescribes. The loss is
proper, so the output is a chance.

Inputs are counts over the whole text, no words: bytes by kind, word and line
lengths, repetition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import text_slices
from snaplake.llm.labels import fold, labelled_texts

POSITIVES = 6000
UNLABELLED = 9000
HIDDEN = 24
ROUNDS = 2500
#: Byte kinds: each ASCII mark on its own, then letters, digits, blanks, others.
KIND = np.zeros(256, np.int64)
for _i, _c in enumerate(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    KIND[_c] = _i + 7
KIND[np.arange(65, 91)] = 1
KIND[np.arange(97, 123)] = 2
KIND[np.arange(48, 58)] = 3
KIND[[32, 9]] = 4
KIND[[10, 13]] = 5
KIND[128:] = 6
KINDS = int(KIND.max()) + 1


def describe(text: str | None) -> list[float]:
    raw = (text or "").encode()
    kinds = np.bincount(KIND[np.frombuffer(raw, np.uint8)], minlength=KINDS) if raw else np.zeros(KINDS, np.int64)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, m, k = max(1, len(raw)), max(1, len(words)), max(1, len(lines))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    per_line = np.fromiter(map(len, lines), np.int64, len(lines)) if lines else np.zeros(1, np.int64)
    distinct = len(set(words))
    return [*np.sqrt(kinds / n), np.log1p(len(raw)), np.log1p(len(words)), np.log1p(len(lines)), sizes.mean(), sizes.std(),
            float(sizes.max() > 40), distinct / m, np.log1p(distinct) / np.log1p(m) if words else 0.0,
            len(set(lines)) / k, np.log1p(per_line.mean()), np.log1p(per_line.std()), (sizes <= 1).mean(),
            sum(x[-1:] in b".!?" for x in lines) / k, sum(x[-1:] in b"%&$*#!" for x in words) / m,
            sum(x[:1].isupper() for x in words) / m, sum(x.isupper() for x in words) / m, float(not words)]


class Model:
    def __init__(self, middle, width, w1, b1, w2, b2):
        self.middle, self.width, self.w1, self.b1, self.w2, self.b2 = middle, width, w1, b1, w2, b2

    def margins(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.width, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.w1 is None:
            return np.full(len(texts), self.b2)
        x = np.array([describe(t) for t in texts]).reshape(len(texts), -1)
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def train(good: np.ndarray, web: np.ndarray, prior: float, rounds: int = ROUNDS, seed: int = 11) -> Model:
    """Minimise the non-negative risk with Adam over mini-batches."""
    if not len(good) or not len(web):
        return Model(None, None, None, None, None, prior)
    middle, width = web.mean(0), web.std(0) + 1e-3
    good, web = (np.clip((x - middle) / width, -8, 8) for x in (good, web))
    rng = np.random.default_rng(seed)
    d = good.shape[1]
    par = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.array(np.log(prior / (1 - prior)))]
    m, v = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]

    def forward(x):
        h = np.tanh(x @ par[0] + par[1])
        return h, h @ par[2] + par[3]

    def back(x, h, g):  # gradients for output gradients g
        dh = (g[:, None] * par[2]) * (1 - h * h)
        return [x.T @ dh, dh.sum(0), h.T @ g, np.array(g.sum())]

    def sig(u):
        return 1 / (1 + np.exp(-np.clip(u, -30, 30)))

    for t in range(1, rounds + 1):
        xp, xu = good[rng.integers(0, len(good), 512)], web[rng.integers(0, len(web), 1024)]
        (hp, gp), (hu, gu) = forward(xp), forward(xu)
        minus = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        plus = back(xp, hp, -prior * (1 - sig(gp)) / len(gp))
        u_minus, p_minus = back(xu, hu, sig(gu) / len(gu)), back(xp, hp, -prior * sig(gp) / len(gp))
        grads = [a + b + c for a, b, c in zip(plus, u_minus, p_minus)] if minus >= 0 else [-(b + c) for b, c in zip(u_minus, p_minus)]
        rate = 0.01 * min(1.0, 2 * (1 - t / (rounds + 1)))
        for i, g in enumerate(grads):
            g = g + 1e-4 * par[i] * (i in (0, 2))
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            par[i] = par[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return Model(middle, width, *par[:3], float(par[3]))


def described(docs: DataFrame) -> np.ndarray:
    """Inputs of a bounded sample, made on the executors."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            x = [describe(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "x": pa.array(x, pa.list_(pa.float64()))})

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(make, "doc_id long, x array<double>")
    return np.array([r["x"] for r in sorted(made.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))])


def fit_quality(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, positives: int = POSITIVES,
                unlabelled: int = UNLABELLED) -> Model:
    """Fit on ``positives`` documents labelled good outside fold ``held`` and ``unlabelled``
    documents picked by hash from all, a repeated id once. The prior is the share of good ones among the labelled
    rows outside ``held``, one of each added. Without positives every score is the prior."""
    known = labels.where(fold(F.col("doc_id"), parts) != held)
    good, bad = known.agg(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)).first()
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    web_ids = ids.orderBy(F.xxhash64("doc_id", F.lit("web")), "doc_id").limit(unlabelled)
    # a bounded number of ids, and of a repeated one the smallest text
    web = docs.select("doc_id", "text").join(F.broadcast(web_ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    return train(described(labelled_texts(docs, known, "quality", {1: positives})), described(web), (good + 1) / (good + bad + 2))


def score_quality(docs: DataFrame, model: Model, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in column ``out``; null texts count
    as empty, all rows and other columns stay, and a column named ``out`` is replaced."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    docs = docs.drop(out)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers
    place = docs.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            got = sent.value.scores(batch.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], [*batch.schema.names, out])

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(out, DoubleType())]))
