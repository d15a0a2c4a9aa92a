"""Packing documents into sequences by fitted length patterns.

Texts are encoded where they are read; only (document, piece, length) rows move.
The histogram of piece lengths has ``size`` bins whatever the corpus, so the
driver plans on it alone: it enumerates the patterns of up to ``DEPTH`` lengths
that fill a sequence exactly, fits their repeat counts to the histogram by
non-negative least squares, rounds down, and packs what remains best-fit
decreasing, again in counts. Each pattern's slots own intervals of ranks within
a length. Pieces get their rank from their task's count of that length and the
counts of the tasks before, so no length, however common, meets in one task.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import settle, text_slices
from snaplake.llm.tokens import encoder, end_of

SIZE = 1024
DEPTH = 3
ROUNDS = 600


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
           with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (ids if asked
    for), and its place: the task that made it and its rank there among pieces
    of its length. Documents up to ``size`` ids are one piece; longer ones are
    cut from their end, so that only the first piece may be shorter. Null
    texts count as empty (the end id alone)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, task, seen = encoder(tokenizer_path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in text_slices(batches, 256):
            out = defaultdict(list)
            for doc, ids in zip(batch.column(0).to_pylist(), map(end_of, enc.many(batch.column(1).to_pylist()))):
                first = len(ids) % size or size
                for i, start in enumerate([0, *range(first, len(ids), size)]):
                    part = ids[start:first] if i == 0 else ids[start:start + size]
                    row = (doc, i, start, len(part), zlib.crc32(part.astype("<u4")), task, seen[len(part)])
                    seen[len(part)] += 1
                    for name, value in zip(names, row):
                        out[name].append(value)
                    if with_ids:
                        out["ids"].append(part.astype("<u4").tobytes())
            if out:
                cols = {n: pa.array(out[n], pa.int64()) for n in names}
                if with_ids:
                    cols["ids"] = pa.array(out["ids"], pa.binary())
                yield pa.record_batch(cols)

    names = ("doc_id", "piece", "start", "length", "ids_crc32", "task", "local")
    schema = ", ".join(f"{n} long" for n in names) + (", ids binary" if with_ids else "")
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return settle(read.mapInArrow(cut, schema), "pieces")


def patterns_of(size: int, there: np.ndarray) -> np.ndarray:
    """Multisets of up to three of the lengths ``there`` that sum to ``size``;
    a row per pattern, 0 for no length."""
    have = np.zeros(size + 1, bool)
    have[there] = True
    a, b = np.meshgrid(there, there, indexing="ij")
    a, b = a[a <= b], b[a <= b]
    two = a + b == size
    pairs = np.stack([np.zeros(two.sum(), int), a[two], b[two]], 1)
    c = size - a - b
    fits = (c >= b) & (c > 0)
    a, b, c = a[fits], b[fits], c[fits]
    triples = np.stack([a, b, c], 1)[have[c]]
    return np.concatenate([pairs, triples])


def fit(pattern: np.ndarray, hist: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts >= 0 that minimise the squared distance between the lengths
    the patterns use and ``hist``: projected gradient with momentum."""
    def used(x):
        y = np.zeros(len(hist))
        for k in range(pattern.shape[1]):
            y += np.bincount(pattern[:, k], weights=x, minlength=len(hist))
        y[0] = 0
        return y

    def back(y):
        return sum(y[pattern[:, k]] for k in range(pattern.shape[1]))

    x = np.ones(len(pattern))
    for _ in range(20):  # largest curvature, by power iteration
        x = back(used(x))
        step = np.linalg.norm(x)
        x /= step
    x = z = np.zeros(len(pattern))
    t = 1.0
    for _ in range(rounds):
        after = np.maximum(0, z - back(used(z) - hist) / step)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        z = after + (before - 1) / t * (after - x)
        x = after
    return x


def plan(hist: np.ndarray, size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that use every piece of ``hist`` (a count per length)."""
    left, out = hist.astype(np.int64).copy(), []
    if left[size]:
        out.append(((size,), int(left[size])))
        left[size] = 0
    there = np.flatnonzero(left)
    pattern = patterns_of(size, there) if len(there) else np.zeros((0, 3), int)
    if len(pattern):
        x = fit(pattern, left.astype(float))
        for k in np.argsort(-x, kind="stable"):
            n = int(x[k])
            if n < 1:
                break
            lengths = tuple(int(v) for v in pattern[k] if v)
            n = min([n, *(int(left[v]) // lengths.count(v) for v in lengths)])
            if n:
                for v in lengths:
                    left[v] -= n
                out.append((lengths, n))
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by free room
    for v in np.flatnonzero(left)[::-1]:
        v, n = int(v), int(left[v])
        while n:
            room = next((r for r in range(v, size) if bins.get(r)), size)
            held, many = bins[room].pop() if room < size else ((), n)
            k = min(n, many)
            if room < size and many > k:
                bins[room].append((held, many - k))
            each = 1
            if room == size:  # new sequences take as many as fit
                each = min(size // v, n)
                k = n // each
            bins[room - each * v].append((held + (v,) * each, k))
            n -= k * each
    return out + [x for group in bins.values() for x in group]


def slots(planned: list[tuple[tuple[int, ...], int]], size: int = SIZE) -> dict[int, np.ndarray]:
    """By length, rows (first rank, sequence of that rank, offset in it)."""
    own, rank, sequence = defaultdict(list), defaultdict(int), 0
    for lengths, n in planned:
        at = 0
        for v in sorted(lengths, reverse=True):
            own[v].append((rank[v], sequence, at))
            rank[v] += n
            at += v
        sequence += n
    return {v: np.array(rows, np.int64) for v, rows in own.items()}


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         with_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``. Repeated rows are packed
    each on their own; an empty table gives no rows."""
    cut = pieces(docs, tokenizer_path, id_col, text_col, size, with_ids)
    hist = np.zeros(size + 1, np.int64)
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length
        hist[row["length"]] = row["n"]
    place = slots(plan(hist, size), size)
    ahead = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for v in np.unique(length):
                at = np.flatnonzero(length == v)
                own = place[int(v)][np.searchsorted(place[int(v)][:, 0], rank[at], "right") - 1]
                sequence[at], offset[at] = own[:, 1] + rank[at] - own[:, 0], own[:, 2]
            cols = {n: batch.column(n) for n in names}
            yield pa.record_batch(cols | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    names = [c for c in cut.columns if c not in ("task", "local")]
    ranked = cut.join(before, ["task", "length"]).select(*names, (F.col("before") + F.col("local")).alias("rank"))
    types = {f.name: f.dataType.simpleString() for f in cut.schema}
    return ranked.mapInArrow(assign, ", ".join(f"{n} {types[n]}" for n in names) + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence (packed ``with_ids``): (sequence_id, ids)
    with little-endian unsigned 32-bit ids. A group is one sequence."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(rows.alias("rows"))
            .select("sequence_id", F.aggregate("rows", F.lit(b"").cast("binary"), lambda a, r: F.concat(a, r["ids"])).alias("ids")))
