"""Hard negatives by threshold joins over inverted indexes with suffix-norm bounds.

1. Rows are packed where they are read into shards of integer vectors, written once and
   never shuffled. Anchors are searched in passes of bounded size: a pass is broadcast and
   every shard answers it.
2. A shard orders its dimensions by mass and indexes each row only up to the dimension
   from which the norm of the rest, times an anchor's norm, stays below the threshold.
   Partial scores are accumulated slab by slab of dimensions over the rows still in the
   postings; after each slab, rows whose partial score plus the product of the remaining
   norms is below every anchor's threshold leave. What is left is scored exactly.
3. Thresholds start high and are lowered only for windows that are not full. An anchor
   first looks for its positives (the best rows of its label); each positive's score gives
   the window of scores in which its negatives must lie.

A window is full when the wanted number of rows at or above its threshold is known: no
other row can come before them. The last threshold is the window's own lower end, so
every answer is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import settle

SCALE = 256
SHARD = 4096  # rows of a shard
PASS = 1 << 16  # anchors searched at a time
BLOCK = 256  # anchors compared with a shard at a time
SLAB = 8  # dimensions accumulated between two prunings
LARGEST = 2.0 ** 55  # squared norm from which a row takes no part
PAIRS = 1 << 15  # pairs scored at a time
STEPS = (0.8, 0.4, 0.2, 0.0, None)  # thresholds for positives: shares of the largest possible score, then none
OPENED = (0.3, 1.0)  # shares of a window searched for negatives
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def _pack(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int) -> DataFrame:
    """Shards of the rows that take part, each with the rows' numbers, ids, labels and matrix."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.coalesce(anchor, F.lit(False)).alias("anchor"), F.monotonically_increasing_id().alias("row"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vector")).to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                held.setdefault(size, []).append(part)
                if sum(p.num_rows for p in held[size]) >= SHARD:
                    yield from write(size, held.pop(size))
        for size, parts in held.items():
            yield from write(size, parts)

    def write(size: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(parts).combine_chunks()
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(scale * whole.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(whole.num_rows, size))
            good = np.flatnonzero((x * x).sum(1) < LARGEST)  # false where a component is not finite
        cols = {c: whole.column(c).to_numpy()[good] for c in ("row", "id", "label", "anchor")}
        x = x[good].astype("<i4")
        for at in range(0, len(good), SHARD):
            part = slice(at, at + SHARD)
            blobs = {"row": cols["row"], "id": cols["id"], "label": cols["label"], "anchor": cols["anchor"].astype("u1"), "matrix": x}
            yield pa.record_batch({"size": pa.array([size], pa.int32()), "n": pa.array([len(good[part])], pa.int32()),
                                   "norm": pa.array([float(np.sqrt((x[part].astype(float) ** 2).sum(1).max()))]),
                                   **{c: pa.array([b[part].tobytes()], pa.binary()) for c, b in blobs.items()}})

    return settle(rows.mapInArrow(pack, "size int, n int, norm double, row binary, id binary, label binary, anchor binary, matrix binary"),
                  "negative-shards")


@dataclass
class Shard:
    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    matrix: np.ndarray

    @classmethod
    def read(cls, batch: pa.RecordBatch, i: int) -> Shard:
        long = [np.frombuffer(batch.column(c)[i].as_buffer(), "<i8") for c in ("row", "id", "label")]
        matrix = np.frombuffer(batch.column("matrix")[i].as_buffer(), "<i4")
        return cls(*long, matrix.reshape(len(long[0]), batch.column("size")[i].as_py()))


def _anchors(shards: DataFrame) -> DataFrame:
    """(anchor, anchor_id, label, size, vector, norm) of the anchor rows."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard.read(batch, i)
                at = np.flatnonzero(np.frombuffer(batch.column("anchor")[i].as_buffer(), "u1"))
                x = shard.matrix[at]
                yield pa.record_batch({"anchor": pa.array(shard.row[at]), "anchor_id": pa.array(shard.id[at]), "label": pa.array(shard.label[at]),
                                       "size": pa.array(np.full(len(at), x.shape[1], np.int32)), "vector": pa.array([v.tobytes() for v in x], pa.binary()),
                                       "norm": pa.array(np.sqrt((x.astype(float) ** 2).sum(1)))})

    return settle(shards.mapInArrow(unpack, "anchor long, anchor_id long, label long, size int, vector binary, norm double"), "negative-anchors")


@dataclass
class Queries:
    """Anchors of one vector length, with a window [low, high] of wanted scores in each slot."""

    row: np.ndarray
    label: np.ndarray
    matrix: np.ndarray
    low: np.ndarray  # a row per anchor, a column per slot; above high where the slot is unused
    high: np.ndarray


def _blocks(rows: list, slots: int) -> dict[int, list[Queries]]:
    """Collected queries as blocks of anchors with similar thresholds, by vector length."""
    out: dict[int, list[Queries]] = {}
    rows = sorted(rows, key=lambda r: (r["size"], min(w["low"] for w in r["windows"]) / max(r["norm"], 1e-9)))
    for at in range(0, len(rows), BLOCK):
        part = rows[at:at + BLOCK]
        for size in sorted({r["size"] for r in part}):
            own = [r for r in part if r["size"] == size]
            low, high = np.full((len(own), slots), HIGHEST), np.full((len(own), slots), LOWEST)
            for i, r in enumerate(own):
                for w in r["windows"]:
                    low[i, w["slot"]], high[i, w["slot"]] = w["low"], w["high"]
            matrix = np.frombuffer(b"".join(bytes(r["vector"]) for r in own), "<i4").reshape(len(own), size)
            out.setdefault(size, []).append(Queries(np.array([r["anchor"] for r in own]), np.array([r["label"] for r in own]), matrix, low, high))
    return out


def _rest(matrix: np.ndarray) -> np.ndarray:
    """Norm of each row from each dimension on; a column more than dimensions."""
    square = np.cumsum(matrix[:, ::-1].astype(float) ** 2, 1)[:, ::-1]
    return np.sqrt(np.concatenate([square, np.zeros((len(matrix), 1))], 1))


def scores_from(shard: Shard, queries: Queries, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, shard row, exact score) of the pairs of equal (``same``) or of different
    labels that reach the smallest ``low`` of their query; a row is not its own partner."""
    order = np.argsort(-(shard.matrix.astype(float) ** 2).sum(0), kind="stable")  # heavy dimensions first
    y, x = shard.matrix[:, order].astype(float), queries.matrix[:, order].astype(float)
    size = y.shape[1]
    rest_y, rest_x = _rest(y), _rest(x)
    least = queries.low.min(1).astype(float)
    slack = 1e-9 * rest_x[:, 0] * rest_y[:, 0].max(initial=0.0) + 0.5  # of float sums of large components
    with np.errstate(divide="ignore", invalid="ignore"):
        tau = float(np.nanmin(np.where(rest_x[:, 0] > 0, (least - slack) / rest_x[:, 0], np.where(least > 0, np.inf, -np.inf))))
    # a row is indexed up to the first dimension whose rest cannot reach the threshold alone
    depth = (rest_y[:, :-1] >= tau).sum(1) if tau > 0 else np.full(len(y), size)
    rows = np.flatnonzero(depth > 0) if tau > 0 else np.arange(len(y))
    rows = rows[np.argsort(-depth[rows], kind="stable")]
    done = [[], []]
    total = np.zeros((len(x), len(rows)))
    for at in range(0, size, SLAB):
        stop = min(at + SLAB, size)
        ended = int(np.searchsorted(-depth[rows], -at, side="left"))  # rows[:ended] have postings in this slab
        finish = rows[ended:]
        if len(finish):
            reach = total[:, ended:] + rest_x[:, at, None] * rest_y[finish, at]
            _keep(done, reach, least - slack, finish, queries, shard, same)
            rows, total = rows[:ended], total[:, :ended]
        total = total + x[:, at:stop] @ y[rows, at:stop].T
        alive = (total + rest_x[:, stop, None] * rest_y[rows, stop] >= (least - slack)[:, None]).any(0)
        rows, total = rows[alive], total[:, alive]
    _keep(done, total, least - slack, rows, queries, shard, same)
    q, r = (np.concatenate(d) if d else np.zeros(0, np.int64) for d in done)
    score = np.zeros(len(q), np.int64)
    for at in range(0, len(q), PAIRS):
        part = slice(at, at + PAIRS)
        score[part] = np.einsum("ij,ij->i", queries.matrix[q[part]].astype(np.int64), shard.matrix[r[part]].astype(np.int64))
    good = score >= queries.low.min(1)[q]
    return q[good], r[good], score[good]


def _keep(done: list, reach: np.ndarray, least: np.ndarray, rows: np.ndarray, queries: Queries, shard: Shard, same: bool) -> None:
    q, r = np.nonzero(reach >= least[:, None])
    r = rows[r]
    fit = ((queries.label[q] == shard.label[r]) == same) & (queries.row[q] != shard.row[r])
    done[0].append(q[fit])
    done[1].append(r[fit])


#: Hits as columns: anchor row, slot, score, id, row.
Hits = list


def _first(hits: Hits, many: int) -> Hits:
    """The first ``many`` of each anchor and slot: higher scores, smaller ids, smaller rows."""
    order = np.lexsort((hits[4], hits[3], -hits[2], hits[1], hits[0]))
    hits = [c[order] for c in hits]
    new = np.r_[True, (hits[0][1:] != hits[0][:-1]) | (hits[1][1:] != hits[1][:-1])][:len(order)]
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
    return [c[place < many] for c in hits]


def _search(shards: DataFrame, open_: DataFrame, slots: int, many: int, same: bool) -> DataFrame:
    """(anchor, slot, score, id, row): the first ``many`` of each window over all shards.
    ``open_`` is at most one pass of anchors; it is collected and broadcast."""
    spark = shards.sparkSession
    sent = spark.sparkContext.broadcast(_blocks(open_.collect(), slots))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64) for _ in range(5)]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard.read(batch, i)
                for queries in sent.value.get(shard.matrix.shape[1], ()):
                    q, r, score = scores_from(shard, queries, same)
                    for slot in range(slots):
                        fit = (score >= queries.low[q, slot]) & (score <= queries.high[q, slot])
                        own = _first([queries.row[q[fit]], np.full(fit.sum(), slot), score[fit], shard.id[r[fit]], shard.row[r[fit]]], many)
                        held = [np.concatenate(c) for c in zip(held, own)]
                    if len(held[0]) > 1 << 20:
                        held = _first(held, many)
        held = _first(held, many)
        for at in range(0, len(held[0]), 1 << 16):
            yield pa.record_batch([pa.array(c[at:at + (1 << 16)]) for c in held], ["anchor", "slot", "score", "id", "row"])

    hits = shards.mapInArrow(answer, "anchor long, slot long, score long, id long, row long")
    first = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    found = settle(hits.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= many), "negative-hits")
    sent.destroy()
    return found


def _rounds(shards: DataFrame, passes: list[DataFrame], steps: list, slots: int, many: int, same: bool) -> DataFrame:
    """Windows of every pass searched with falling thresholds. ``passes`` hold (anchor, slot,
    bottom, high, ...): each step is the lower end as a column, never below ``bottom``."""
    found = []
    for left in passes:
        for low in steps:
            asked = (left.withColumn("low", F.greatest("bottom", low)).groupBy("anchor", "label", "size", "vector", "norm")
                     .agg(F.collect_list(F.struct("slot", "low", "high")).alias("windows")))
            got = _search(shards, asked, slots, many, same)
            full = got.groupBy("anchor", "slot").agg(F.count("*").alias("n")).where(F.col("n") >= many)
            ended = left.where(F.greatest("bottom", low) <= F.col("bottom")).select("anchor", "slot").union(full.select("anchor", "slot")).distinct()
            found.append(got.join(ended, ["anchor", "slot"], "left_semi"))
            left = settle(left.join(ended, ["anchor", "slot"], "left_anti"), "negative-open")
            if left.isEmpty():
                break
    out = found[0]
    for one in found[1:]:
        out = out.unionByName(one)
    return settle(out, "negative-found")


def mine_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   scale: int = SCALE, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, per_pass: int = PASS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of the components ``floor(scale * x)``; ``anchor`` says which
    rows are anchors. A positive is one of an anchor's first ``positives`` other rows of the
    same label; its negatives are the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``. Higher scores
    come first, ties by smaller id, then by place in the table.

    Rows with a null id, label or vector, a null or non-finite component, or a squared norm
    of 2 ** 55 or more (after scaling) take no part. Only vectors of one length meet. Rows
    that share an id, and repeated rows, are rows of their own, each an anchor if its
    id is one. Other columns are not read. An empty table, or one without anchors, gives no rows."""
    shards = _pack(vectors, id_col, vector_col, label_col, anchor, scale)
    every = _anchors(shards)
    largest = shards.groupBy("size").agg(F.max("norm").alias("largest"))  # a row per vector length
    number = -(-every.count() // per_pass)
    if not number:
        return shards.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    every = settle(every.join(largest, "size").withColumn("pass", F.pmod(F.xxhash64("anchor"), F.lit(number))), "negative-anchors")

    def passes(df: DataFrame) -> list[DataFrame]:
        return [df.where(F.col("pass") == k) for k in range(number)]

    wide = every.withColumns({"slot": F.lit(0).cast("long"), "bottom": F.lit(LOWEST), "high": F.lit(HIGHEST)})
    shares = [F.lit(LOWEST) if s is None else F.floor(F.col("norm") * F.col("largest") * s) for s in STEPS]
    best = _rounds(shards, passes(wide), shares, 1, positives, True)
    best = best.select("anchor", (F.col("rank") - 1).cast("long").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows = best.withColumns({"bottom": F.ceil(F.col("positive_score").cast("decimal(38,0)") * low / 100).cast("long"),
                                "high": F.floor(F.col("positive_score").cast("decimal(38,0)") * high / 100).cast("long")})
    windows = settle(windows.where("bottom <= high").join(every, "anchor"), "negative-windows")
    shares = [F.expr(f"high - cast(floor((high - bottom) * {s}D) as long)") if s < 1 else F.col("bottom") for s in OPENED]
    found = _rounds(shards, passes(windows), shares, positives, negatives, False)
    return (found.join(windows.select("anchor", "slot", "anchor_id", "positive_id", "positive_score"), ["anchor", "slot"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
