"""Near-duplicate vectors by cross-polytope hashing.

1. Equal vectors are one class; one of each goes on, with the number of ids.
2. A hash rotates a vector by three rounds of random signs and a fast Hadamard
   transform and takes the axis it comes closest to, with its sign; a table joins
   ``bits`` such hashes. Each vector is stored in its own bucket of each table and
   looks into further buckets, in order of how little they lose (multiprobe).
3. Buckets are read sorted, in blocks: a bucket of more than ``BLOCK`` vectors is
   cut into blocks that meet pairwise, each meeting a task's group of its own. Cosines
   are taken in double precision; a pair counts in the first table where it meets,
   so links are counted per vector and never listed: what leaves a block is a
   count per vector and a forest of links.
4. The forest's components, and the counts, go back to all ids.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import connected_components, runs, settle, text_slices

THRESHOLD = 0.9
BLOCK = 2048


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        x = x.reshape(-1, n // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(-1, n)
        half *= 2
    return x / np.sqrt(n)


class Hashing:
    """``tables`` tables of ``bits`` cross-polytope hashes, ``probes`` buckets each."""

    def __init__(self, size: int, rows: int, seed: int = 5):
        self.size = 1 << max(1, (size - 1).bit_length())
        self.bits = max(1, int(np.ceil(np.log(max(rows, 2) / 1024) / np.log(2 * self.size))))
        self.tables, self.probes = 2 + 4 * self.bits, 3 * self.bits
        rng = np.random.default_rng([seed, size])
        self.signs = rng.choice([-1.0, 1.0], (self.tables, self.bits, 3, self.size))

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(row, table, probe): bucket numbers, a vector's own bucket first."""
        x = np.pad(x, ((0, 0), (0, self.size - x.shape[1])))
        deep = min(4, 2 * self.size)
        choice = np.array(list(itertools.product(range(deep), repeat=self.bits)))
        out = np.zeros((len(x), self.tables, self.probes), np.int64)
        for t in range(self.tables):
            code, loss = np.zeros((len(x), len(choice)), np.int64), np.zeros((len(x), len(choice)))
            for k in range(self.bits):
                y = x
                for signs in self.signs[t, k]:
                    y = hadamard(y * signs)
                y = np.concatenate([y, -y], 1)
                best = np.argsort(-y, axis=1, kind="stable")[:, :deep]
                value = np.take_along_axis(y, best, 1)
                code = code * (2 * self.size) + best[:, choice[:, k]]
                loss += value[:, :1] - value[:, choice[:, k]]
            pick = np.argsort(loss, axis=1, kind="stable")[:, :self.probes]
            got = np.take_along_axis(code, pick, 1)
            out[:, t, :got.shape[1]] = got
            out[:, t, got.shape[1]:] = got[:, :1]  # fewer buckets than probes
        return out


def _unit(rows: list[np.ndarray]) -> np.ndarray:
    x = np.stack(rows).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _read(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, h1, h2, size, vec): doubles of usable vectors, nulls of others."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 4096):
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                vec = None
                if value.is_valid and len(value) and value.values.null_count == 0:
                    vec = value.values.to_numpy(zero_copy_only=False).astype("<f8")
                if vec is None or doc is None or not np.isfinite(vec).all() or not vec.any():
                    rows.append((doc, None, None, None, None))
                    continue
                raw = (vec + 0.0).tobytes()  # minus zero is zero
                h = xxhash.xxh3_128_digest(raw)
                rows.append((doc, int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True), len(vec), raw))
            if rows:
                yield pa.record_batch({n: pa.array(c, t) for n, c, t in zip(("vec_id", "h1", "h2", "size", "vec"), zip(*rows), types)})

    types = [pa.int64()] * 4 + [pa.binary()]
    read = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return settle(read.mapInArrow(make, "vec_id long, h1 long, h2 long, size long, vec binary"), "vectors")


def compare_cell(table: int, bucket: int, own: np.ndarray, same: bool, query: np.ndarray, cid: np.ndarray, mult: np.ndarray,
                 vecs: list[np.ndarray], hashing: Hashing, threshold: float) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Links between the stored vectors of a bucket and all that are in or look into
    it: counts by class, and a forest of the links."""
    x = _unit(vecs)
    codes: dict[int, np.ndarray] = {}

    def coded(rows: np.ndarray) -> np.ndarray:
        new = [r for r in np.unique(rows).tolist() if r not in codes]
        if new:
            codes.update(zip(new, hashing.codes(x[new])))
        return np.stack([codes[r] for r in rows.tolist()])

    counts: dict[int, int] = {}
    forest: list[tuple[int, int]] = []
    stored, asking = np.flatnonzero(~query), np.flatnonzero(query)
    if same:
        sides = [(stored, stored), (stored, asking)]
    else:
        a, b = own == own.min(), own == own.max()
        sides = [(stored[a[stored]], stored[b[stored]]), (stored[a[stored]], asking[b[asking]]), (stored[b[stored]], asking[a[asking]])]
    for left, right in sides:
        if not len(left) or not len(right):
            continue
        near = x[left] @ x[right].T >= threshold
        if left is right:
            near &= np.triu(np.ones(near.shape, bool), 1)
        i, j = np.nonzero(near)
        for at in range(0, len(i), 200_000):
            p, q = left[i[at:at + 200_000]], right[j[at:at + 200_000]]
            cp, cq = coded(p), coded(q)
            first = cid[p] != cid[q]
            for t in range(table):
                first &= ~((cp[:, t, :1] == cq[:, t]).any(1) | (cq[:, t, :1] == cp[:, t]).any(1))
            if query[q].any():  # they may also meet where the asking one is stored
                twice = (cq[:, table, :1] == cp[:, table]).any(1) & (cid[q] > cid[p])
                first &= ~(query[q] & twice)
            p, q = p[first], q[first]
            for r, s in ((p, q), (q, p)):
                total = np.bincount(r, weights=mult[s], minlength=len(cid))
                for k in np.flatnonzero(total):
                    counts[int(cid[k])] = counts.get(int(cid[k]), 0) + int(total[k])
            label = np.arange(len(cid))
            while len(p):
                low = np.minimum(label[p], label[q])
                after = label.copy()
                np.minimum.at(after, p, low)
                np.minimum.at(after, q, low)
                after = after[after]
                if (after == label).all():
                    break
                label = after
            moved = np.flatnonzero(label != np.arange(len(label)))
            forest += [(int(cid[k]), int(cid[label[k]])) for k in moved]
    return counts, forest


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row.

    ``n_links`` counts the other ids whose vector has a cosine of at least ``threshold``;
    ``component_id`` is the smallest id reachable by links. Null, empty and zero vectors,
    those with null or non-finite components, and rows without an id link with nothing.
    Only vectors of one length are compared. A repeated id counts once, and a row's
    own id is no other. An empty table gives no rows."""
    read = _read(vectors, id_col, vector_col)
    good = read.where("h1 IS NOT NULL")
    ids = good.select("vec_id", "h1", "h2").distinct()
    classes = settle(good.groupBy("h1", "h2").agg(F.count_distinct("vec_id").alias("mult"), F.min("vec_id").alias("low"),
                                                  F.first("size").alias("size"), F.first("vec").alias("vec"))
                     .withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    sizes = {r["size"]: r["n"] for r in classes.groupBy("size").agg(F.count("*").alias("n")).collect()}  # a row per vector length
    hashings = {size: Hashing(size, n) for size, n in sizes.items()}

    def spread(with_vec: bool):
        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, 256):
                length = batch.column("size").to_numpy()
                for size in np.unique(length):
                    part = batch.filter(pa.array(length == size))
                    h = hashings[int(size)]
                    x = _unit([np.frombuffer(v.as_buffer(), "<f8") for v in part.column("vec")])
                    codes = h.codes(x).reshape(len(x), -1)
                    per = codes.shape[1]
                    table = np.tile(np.repeat(np.arange(h.tables), h.probes), len(x))
                    probe = np.tile(np.tile(np.arange(h.probes), h.tables), len(x))
                    row = np.repeat(np.arange(len(x)), per)
                    use = (probe == 0) | (codes.ravel() != codes.reshape(len(x), h.tables, h.probes)[:, :, :1].repeat(h.probes, 2).ravel())
                    row, table, probe, code = row[use], table[use], probe[use], codes.ravel()[use]
                    cols = {"size": pa.array(np.full(len(row), size, np.int64)), "slot": pa.array(table.astype(np.int64)), "bucket": pa.array(code)}
                    if with_vec:
                        cols |= {"query": pa.array(probe > 0), "cid": part.column("cid").take(pa.array(row)),
                                 "mult": part.column("mult").take(pa.array(row)), "vec": part.column("vec").take(pa.array(row))}
                    yield pa.record_batch(cols)
        return make

    key = "size long, slot long, bucket long"
    src = classes.select("size", "cid", "mult", "vec")
    rows = src.mapInArrow(spread(True), f"{key}, query boolean, cid long, mult long, vec binary")
    large = (src.mapInArrow(spread(False), key).groupBy("size", "slot", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
             .select("size", "slot", "bucket", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    place = ["size", "slot", "bucket", "i", "j"]
    cells = (rows.join(large, ["size", "slot", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks"))).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
             .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
             .select(*place, "own", "query", "cid", "mult", "vec")
             .repartition(*place).sortWithinPartitions(*place))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, place):
            yield from answer(cell)

    def answer(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        query = cell.column("query").to_numpy()
        if len(query) < 2 or query.all():
            return
        size, slot, bucket, i, j = (cell.column(c)[0].as_py() for c in place)
        vecs = [np.frombuffer(v.as_buffer(), "<f8") for v in cell.column("vec").chunk(0)]
        counts, forest = compare_cell(slot, bucket, cell.column("own").to_numpy(), i == j, query, cell.column("cid").to_numpy(),
                                      cell.column("mult").to_numpy(), vecs, hashings[size], threshold)
        if counts or forest:
            yield pa.record_batch({
                "cid": pa.array([*counts, *(a for a, _ in forest)], pa.int64()),
                "links": pa.array([*counts.values(), *([0] * len(forest))], pa.int64()),
                "to": pa.array([*([None] * len(counts)), *(b for _, b in forest)], pa.int64())})

    found = settle(cells.mapInArrow(compare, "cid long, links long, to long"), "vector-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("to IS NOT NULL").select(F.col("cid").alias("src"), F.col("to").alias("dst")))
    named = classes.select("h1", "h2", "cid", "mult", "low").join(links, "cid", "left").join(parts.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = settle(named.join(lows, "component").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component_id"),
                   "vector-answers")
    # an id with several vectors: the links of all, and their components as one
    per_id = (ids.join(named, ["h1", "h2"]).groupBy("vec_id")
              .agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"), F.max("component_id").alias("far")))
    joined = connected_components(per_id.where("far <> component_id").select(F.col("far").alias("src"), F.col("component_id").alias("dst")))
    per_id = (per_id.join(joined.select(F.col("node").alias("component_id"), F.col("component").alias("whole")), "component_id", "left")
              .select("vec_id", "n_links", F.coalesce("whole", "component_id").alias("component_id")))
    return (read.select("vec_id").join(per_id, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))
