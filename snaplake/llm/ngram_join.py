"""Exact Jaccard join on word shingles with set-relation skipping.

1. Texts become sets of 64-bit shingle hashes where they are read. Documents with
   the same set are one class; one of each class goes on. A fixed-size table of
   shingle counts over all documents gives one order for every set: rare first,
   hash next. Two sets that reach the threshold share a shingle in their prefixes.
2. Index lists (prefix shingles with the sets that hold them) are dealt out in
   bounded buckets and sorted by set size and position. A pair counts at its first
   common prefix shingle, where both remainders must still be long enough.
3. A long list is answered through a few hubs, the same in all lists of a group: they
   are compared with every member. Pairs of members that are now in one component need
   nothing more; for the others the first hub's answers bound the overlap,
   ``|x & y| <= |h & y| + |x - h|``, and only pairs that could still reach the
   threshold are compared. Long lists are compared in blocks of bounded size.
4. Candidate pairs meet the two sets by equi-joins; links become components.

Copies are never expanded into pairs. Components are exact; pairs inside a component that
is already known are not compared, so the links of a component are not all listed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import connected_components, free_name, runs, settle, text_slices

WORDS = 5
PERCENT = 80
BITS = 23  # of the table of counts
SKETCH = 256
MAP_BITS = 23  # of the bitmap of candidates
SHORT = 16
HUBS = 4
BLOCK = 2000
BUCKET_BYTES = 16 << 20
HALF = np.uint64(1 << 63)
ENTRY = np.dtype([("token", "<u4"), ("rep", "<i8"), ("n", "<i4"), ("pos", "<i4")])


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_ROOT = 0xD1342543DE82EF95
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _ODD[0])


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the root and of its inverse, modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        for k, root in enumerate((_ROOT, pow(_ROOT, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 20), root, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """For each text, sorted hashes of the distinct shingles: runs of ``words`` words, or
    all words of a shorter text; words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.

    Words are hashed from differences of one running sum over the bytes of all texts."""
    raw = [(t or "").encode().lower() for t in texts]
    flat = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends_of = np.cumsum([len(x) + 1 for x in raw])
    up, down = _powers(len(flat))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[flat] * up[:len(flat)])])
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _BLANK[flat]]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    word = _mix((total[end] - total[start]) * down[start])
    last = np.searchsorted(start, ends_of)  # words up to and including each text
    odd = _ODD if words <= len(_ODD) else np.cumprod(np.full(words, _ODD[0])) | np.uint64(1)
    runs = max(0, len(word) - words + 1)
    whole = np.full(runs, words, np.uint64)
    for i in range(words):
        whole += word[i:i + runs] * odd[i]
    whole = _mix(whole)
    out, first = [], 0
    for stop in last.tolist():
        n = stop - first
        if n >= words:
            own = np.sort(whole[first:stop - words + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n:
            own = _mix(np.array([n], np.uint64) + (word[first:stop] * odd[:n]).sum(dtype=np.uint64))
        else:
            own = np.zeros(0, np.uint64)
        out.append(own)
        first = stop
    return out


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    return shingle_sets([text], words)[0]


def _class_of(own: np.ndarray) -> tuple[int, int]:
    raw = xxhash.xxh3_128_digest(own.tobytes())
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def least_overlap(na, nb, percent: int):
    """Smallest common size with ``100 * common >= percent * union``."""
    return -(-percent * (na + nb) // (100 + percent))


def _fold(blobs: DataFrame, parts: int, merge) -> DataFrame:
    """Combine packed arrays of one fixed size, first ``parts`` ways, then in one task."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for blob in batch.column(0):
                part = np.frombuffer(zlib.decompress(blob.as_buffer()), "<u4")
                total = part.copy() if total is None else merge(total, part)
        if total is not None:
            yield pa.record_batch({"blob": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    for n in (parts, 1):
        blobs = blobs.repartition(n).mapInArrow(fold, "blob binary")
    return blobs


def _packed(array: np.ndarray) -> pa.Array:
    return pa.array([zlib.compress(array.tobytes(), 1)], pa.binary())


def _place(hashes: np.ndarray) -> np.ndarray:
    """Counter of each shingle in the lower half of the hash range, where prefixes lie."""
    return (hashes >> np.uint64(63 - BITS)).astype(np.int64)


def _classes(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, h1, h2) per row, and a row with counts per task (n = -1)."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BITS, "<u4")
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            if sets:
                every = np.concatenate(sets)
                np.add.at(counts, _place(every[every < HALF]), 1)
            one, two = zip(*map(_class_of, sets)) if sets else ((), ())
            yield pa.record_batch({"doc_id": batch.column(0), "n": pa.array([len(x) for x in sets], pa.int64()), "h1": pa.array(one, pa.int64()),
                                   "h2": pa.array(two, pa.int64()), "blob": pa.nulls(len(sets), pa.binary())})
        if counts.any():
            yield pa.record_batch({"doc_id": pa.nulls(1, pa.int64()), "n": pa.array([-1], pa.int64()), "h1": pa.nulls(1, pa.int64()),
                                   "h2": pa.nulls(1, pa.int64()), "blob": _packed(counts)})

    return settle(docs.mapInArrow(make, "doc_id long, n long, h1 long, h2 long, blob binary"), "shingle-classes")


def _levels(counts: DataFrame) -> np.ndarray:
    """Order level by count: 0 up to what chance makes of rare shingles that share
    a counter, then by powers of two. A byte per counter reaches the driver."""
    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                got = np.frombuffer(zlib.decompress(blob.as_buffer()), "<u4").astype("f4")
                usual = got.mean() + 6 * np.sqrt(got.mean()) + 8
                yield pa.record_batch({"blob": _packed(np.maximum(0, np.ceil(np.log2(np.maximum(got, 1) / usual))).astype("u1"))})

    rows = _fold(counts, 64, np.add).mapInArrow(level, "blob binary").collect()
    return np.frombuffer(zlib.decompress(rows[0]["blob"]), "u1") if rows else np.zeros(1 << BITS, np.uint8)


def _level_of(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    out = np.zeros(len(hashes), np.uint8)
    low = int(np.searchsorted(hashes, HALF))
    out[:low] = levels[_place(hashes[:low])]
    return out


def _prefixes(docs: DataFrame, levels: np.ndarray, words: int, percent: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(levels)  # a byte per counter, of fixed size

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = sent.value
        for batch in text_slices(batches):
            rows = []
            for doc, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), words)):
                if doc is None or not len(own):
                    continue
                lv = _level_of(own, level)
                most = len(own) + percent * len(own) // -100 + 1
                head = own[np.argsort(lv, kind="stable")[:most]] if lv.any() else own[:most]
                rows.append((doc, *_class_of(own), len(own), head.tobytes()))
            if rows:
                cols = list(zip(*rows))
                yield pa.record_batch({n: pa.array(c, t) for n, c, t in zip(("doc_id", "h1", "h2", "n", "head"), cols, types)})

    types = [pa.int64()] * 4 + [pa.binary()]
    return docs.mapInArrow(make, "doc_id long, h1 long, h2 long, n long, head binary")


def _dealt(prefixes: DataFrame, buckets: int) -> DataFrame:
    """Entries (shingle, set, size, position) in a row per bucket and batch."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 4096):
            heads = [np.frombuffer(h.as_buffer(), "<u8") for h in batch.column("head")]
            sizes = np.array([len(h) for h in heads])
            if not len(sizes):
                continue
            token = np.concatenate(heads)
            out = np.zeros(len(token), ENTRY)
            out["token"] = (token >> np.uint64(24)) & np.uint64(0xFFFFFFFF)
            out["rep"] = np.repeat(batch.column("doc_id").to_numpy(), sizes)
            out["n"] = np.repeat(batch.column("n").to_numpy(), sizes)
            out["pos"] = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            bucket = (token % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            out = out[order]
            there = [b for b in range(buckets) if ends[b] > (ends[b - 1] if b else 0)]
            yield pa.record_batch({"bucket": pa.array(there, pa.int64()), "entries": pa.array(
                [_columns(out[ends[b - 1] if b else 0:ends[b]]) for b in there], pa.binary())})

    return (prefixes.mapInArrow(deal, "bucket long, entries binary")
            .repartition(buckets, "bucket").sortWithinPartitions("bucket"))


def _columns(entries: np.ndarray) -> bytes:
    return b"".join(entries[c].tobytes() for c in ENTRY.names)


def _entries(blob) -> np.ndarray:
    n = len(blob) // ENTRY.itemsize
    out, at = np.zeros(n, ENTRY), 0
    for c in ENTRY.names:
        out[c] = np.frombuffer(blob, ENTRY[c], n, at)
        at += n * ENTRY[c].itemsize
    return out


def _fits(na, pa_, nb, pb, percent):
    """Whether sets of these sizes can reach the threshold when the shingles at
    these positions are their first common ones."""
    need = least_overlap(na, nb, percent)
    return np.minimum(na - pa_, nb - pb) >= need


def _candidates(dealt: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of short lists and with hubs; long lists as entries too."""
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None
        for batch in batches:
            for b, blob in zip(batch.column("bucket").to_pylist(), batch.column("entries")):
                if b != bucket and held:
                    yield from answer(bucket, np.concatenate(held))
                    held = []
                bucket = b
                held.append(_entries(blob.as_buffer()))
        if held:
            yield from answer(bucket, np.concatenate(held))

    def answer(bucket: int, e: np.ndarray) -> Iterator[pa.RecordBatch]:
        e = e[np.lexsort((e["pos"], e["n"], e["token"]))]
        starts = np.flatnonzero(np.r_[True, e["token"][1:] != e["token"][:-1]])
        size = np.diff(np.r_[starts, len(e)])
        pairs = []
        group = np.repeat(np.arange(len(starts)), size)
        short = (size[group] > 1) & (size[group] <= SHORT)
        s, g = e[short], group[short]
        for d in range(1, SHORT):  # members sorted by size: a step apart, two apart, ...
            if len(s) <= d:
                break
            x, y = s[:-d], s[d:]
            ok = (g[:-d] == g[d:]) & (x["rep"] != y["rep"]) & _fits(x["n"], x["pos"], y["n"], y["pos"], percent)
            pairs.append(np.stack([np.minimum(x["rep"], y["rep"])[ok], np.maximum(x["rep"], y["rep"])[ok]], 1))
        saved = []
        for k in np.flatnonzero(size > SHORT):
            one = e[starts[k]:starts[k] + size[k]]
            hubs = one[np.argsort(_mix(one["rep"].astype(np.uint64)), kind="stable")[:HUBS]]  # the same in all lists of a group
            for hub in hubs:
                ok = (one["rep"] != hub["rep"]) & _fits(one["n"], one["pos"], hub["n"], hub["pos"], percent)
                pairs.append(np.stack([np.minimum(hub["rep"], one["rep"][ok]), np.maximum(hub["rep"], one["rep"][ok])], 1))
            saved.append((int(hubs[0]["rep"]), _columns(one)))
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        for at in range(0, len(found), 50_000):
            part = found[at:at + 50_000]
            yield pa.record_batch({"a": pa.array(part[:, 0]), "b": pa.array(part[:, 1]), "list": pa.nulls(len(part), pa.int64()),
                                   "entries": pa.nulls(len(part), pa.binary())})
        for at in range(0, len(saved), 256):
            part = saved[at:at + 256]
            yield pa.record_batch({"a": pa.array([h for h, _ in part], pa.int64()), "b": pa.nulls(len(part), pa.int64()),
                                   "list": pa.array([(bucket << 32) + at + i for i in range(len(part))], pa.int64()),
                                   "entries": pa.array([x for _, x in part], pa.binary())})

    return settle(dealt.mapInArrow(lists, "a long, b long, list long, entries binary"), "shingle-lists")


def _spot(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _counts(own: np.ndarray) -> bytes:
    """Shingles by the last bits of their hash, 255 for that many or more: summed
    minima of two such tables are no less than what the sets share."""
    return np.minimum(np.bincount((own & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH), 255).astype("u1").tobytes()


def verified(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, na, nb, common) for the candidate pairs that can reach the threshold by
    a bound from small tables of counts; only their sets are joined. A bitmap of
    fixed size keeps most other documents' sets from being made; the joins are exact."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << MAP_BITS, bool)
        for batch in batches:
            bits[_spot(batch.column(0).to_numpy())] = True
        yield pa.record_batch({"blob": _packed(np.packbits(bits))})

    def sets_of(ids: DataFrame, schema: str, tell) -> DataFrame:
        rows = _fold(ids.mapInArrow(mark, "blob binary"), 8, np.bitwise_or).collect()
        bits = np.unpackbits(np.frombuffer(zlib.decompress(rows[0]["blob"]), "u1")) if rows else np.zeros(1 << MAP_BITS, "u1")
        sent = docs.sparkSession.sparkContext.broadcast(bits.astype(bool))  # of fixed size

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches):
                batch = batch.filter(pa.compute.is_valid(batch.column(0)))
                batch = batch.filter(pa.array(sent.value[_spot(batch.column(0).to_numpy())]))
                if batch.num_rows:
                    own = shingle_sets(batch.column(1).to_pylist(), words)
                    yield pa.record_batch({"doc_id": batch.column(0), "n": pa.array([len(x) for x in own], pa.int64()),
                                           "own": pa.array([tell(x) for x in own], pa.binary())})

        return settle(docs.mapInArrow(make, schema).join(ids, "doc_id", "left_semi").distinct(), "shingle-sets")

    def meet(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        return (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("own").alias("xa")), "a")
                .join(sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("own").alias("xb")), "b")
                .select("a", "b", "na", "nb", "xa", "xb"))

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 4096):
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "u1").reshape(-1, SKETCH) for c in ("xa", "xb"))
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            most = np.minimum(x, y).sum(1, dtype=np.int64) + np.where(np.minimum(x, y) == 255, na[:, None], 0).sum(1)
            ok = pa.array(most >= least_overlap(na, nb, percent))
            yield pa.record_batch({"a": batch.column("a").filter(ok), "b": batch.column("b").filter(ok)})

    pairs = settle(pairs, "shingle-pairs")
    small = sets_of(ends(pairs), "doc_id long, n long, own binary", _counts)
    likely = settle(meet(pairs, small).mapInArrow(bound, "a long, b long").distinct(), "shingle-likely")
    both = meet(likely, sets_of(ends(likely), "doc_id long, n long, own binary", np.ndarray.tobytes))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            common = [len(np.intersect1d(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), assume_unique=True))
                      for x, y in zip(batch.column("xa"), batch.column("xb"))]
            yield pa.record_batch({c: batch.column(c) for c in ("a", "b", "na", "nb")} | {"common": pa.array(common, pa.int64())})

    return settle(both.mapInArrow(compare, "a long, b long, na long, nb long, common long"),
                  "shingle-answers")


def _linked(answers: DataFrame, percent: int) -> DataFrame:
    return answers.where(F.expr(f"100 * common >= {percent} * (na + nb - common)")).select(F.col("a").alias("src"), F.col("b").alias("dst"))


def _derived(long_lists: DataFrame, answers: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of long lists across components, by the hub's answers."""
    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hub, name, blob in zip(batch.column("a").to_pylist(), batch.column("list").to_pylist(), batch.column("entries")):
                e = _entries(blob.as_buffer())
                yield pa.record_batch({"list": pa.array(np.full(len(e), name)), "hub": pa.array(np.full(len(e), hub)), "rep": pa.array(e["rep"].copy()),
                                       "n": pa.array(e["n"].astype(np.int64)), "pos": pa.array(e["pos"].astype(np.int64))})

    known = (answers.select(F.col("a").alias("hub"), F.col("b").alias("rep"), "common").union(answers.select("b", "a", "common"))
             .groupBy("hub", "rep").agg(F.max("common").alias("common")))
    rows = long_lists.select("a", "list", "entries").mapInArrow(open_, "list long, hub long, rep long, n long, pos long")
    rows = (rows.join(parts.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
            .join(known, ["hub", "rep"], "left"))
    rows = settle(rows, "shingle-members")
    place = ["list", "i", "j"]
    split = (rows.groupBy("list").agg(F.count("*").alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo <> hi").select("list", F.ceil(F.col("size") / BLOCK).alias("blocks")))
    cells = (rows.join(split, "list").withColumn("own", F.pmod(F.xxhash64("rep"), "blocks"))
             .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
             .select("list", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "n", "pos",
                     "component", "common")
             .repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *place).sortWithinPartitions(*place))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, place):
            pairs = across({c: cell.column(c).to_numpy() for c in cell.column_names})
            if len(pairs):
                yield pa.record_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    def across(cell: dict[str, np.ndarray]) -> np.ndarray:
        one = cell["i"][0] == cell["j"][0]
        x, y = cell["own"] == cell["i"], cell["own"] == cell["j"]
        col = lambda c: (cell[c][x][:, None], cell[c][y][None, :])
        (ra, rb), (ca, cb), (na, nb), (pa_, pb) = col("rep"), col("component"), col("n"), col("pos")
        ok = (ca != cb) & _fits(na, pa_, nb, pb, percent)
        if one:
            ok &= ra < rb
        ha, hb = (v.astype(float) for v in col("common"))
        most_a, most_b = np.where(np.isnan(ha), np.inf, ha), np.where(np.isnan(hb), np.inf, hb)  # an unknown answer bounds nothing
        reach = np.minimum(most_b + na - np.nan_to_num(ha), most_a + nb - np.nan_to_num(hb))
        ok &= reach >= least_overlap(na, nb, percent)
        i, j = np.nonzero(ok)
        a, b = ra[i, 0], rb[0, j]
        return np.stack([np.minimum(a, b), np.maximum(a, b)], 1)

    return cells.mapInArrow(compare, "a long, b long").distinct()


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                      percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    The component is the smallest id reachable by links. Null and empty texts
    have no shingles and link with nothing. Rows that share an id are one
    document with the links of all. A row without an id gets its count and a null
    component. An empty table gives no rows; other columns are not read."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = _classes(docs, words)
    own = made.where("n >= 0")
    counts = made.where("n = -1").select("blob")
    entries = own.agg(F.sum(F.col("n") * (100 - percent) / 100 + 1)).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(entries * ENTRY.itemsize) // BUCKET_BYTES + 1)
    classes = own.where("n > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    heads = (_prefixes(docs, _levels(counts), words, percent)
             .join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "h1", "h2"], "left_semi"))
    lists = _candidates(_dealt(heads, buckets), percent)
    answers = verified(docs, lists.where("b IS NOT NULL").select("a", "b").distinct(), words, percent)
    links = _linked(answers, percent)
    parts = settle(connected_components(links), "shingle-components")
    again = settle(_derived(lists.where("b IS NULL"), answers, parts, percent), "shingle-derived")
    final = parts
    if not again.isEmpty():  # else the components stand
        more = _linked(verified(docs, again, words, percent), percent)
        if not more.isEmpty():
            stars = parts.select(F.col("node").alias("src"), F.col("component").alias("dst"))
            final = connected_components(stars.union(more))
    named = (classes.join(final, F.col("rep") == F.col("node"), "left")
             .select("h1", "h2", F.coalesce("component", "rep").alias("component")))
    found = own.join(named, ["h1", "h2"], "left")
    # rows that share an id bring their components together
    ids = found.where("component IS NOT NULL").select("doc_id", "component").distinct()
    low = ids.groupBy("doc_id").agg(F.min("component").alias("low"), F.count("*").alias("many")).where("many > 1")
    joined = connected_components(ids.join(low, "doc_id").select(F.col("component").alias("src"), F.col("low").alias("dst")))
    found = (found.join(joined.select(F.col("node").alias("component"), F.col("component").alias("whole")), "component", "left")
             .withColumn("component", F.coalesce("whole", "component")))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are not the smallest id of their component; rows
    without an id stay, and of repeated rows with the kept id, all stay."""
    name = free_name(docs, "gone")
    gone = similar_documents(docs, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col(id_col) == F.col(name), "left_anti")
