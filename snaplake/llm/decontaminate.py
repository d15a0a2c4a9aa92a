"""Benchmark decontamination with suffix arrays over shards of the corpus.

A shard is a bounded run of documents inside a task. Its words become numbers of
the benchmark's vocabulary, and the suffixes that can match at all (runs of word
pairs that the benchmark holds) are sorted into a suffix array by prefix
doubling. Every benchmark suffix is then looked up by binary search, all at
once, one word deeper at a time: the interval left at a depth is every place in
the shard where so many words match, and where it becomes empty the longest
verbatim match ends. No document moves between tasks.

The benchmark is a reference set; it is read in blocks of bounded size, and
each document meets every block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from snaplake.llm.common import free_name, text_slices

WINDOW = 10
BLOCK_BYTES = 4 << 20
SHARD_ROWS = 1024
_STRUCT = StructType([StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()),
                      StructField("items_sha256", StringType()), StructField("longest", LongType()),
                      StructField("contaminated", BooleanType())])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z, on UTF-8 bytes.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


class Block:
    """Benchmark items as word numbers: ``flat`` with the items one after another,
    and per suffix its item, how many words follow, and its window."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.number: dict[bytes, int] = {}
        self.names, flat, item, left, need = [], [], [], [], []
        for name, text in items:
            own = [self.number.setdefault(w, len(self.number)) for w in words_of(text)]
            if not own:
                continue
            flat += own
            item += [len(self.names)] * len(own)
            left += range(len(own), 0, -1)
            need += [min(window, len(own))] * len(own)
            self.names.append(name)
        self.flat, self.item = np.array(flat, np.int64), np.array(item, np.int64)
        self.left, need = np.array(left, np.int64), np.array(need, np.int64)
        self.suffix = np.flatnonzero(self.left >= need)  # those long enough for a window
        self.need = need[self.suffix]
        self.least = int(need.min()) if len(need) else 0
        base = max(1, len(self.number))
        inner = np.flatnonzero(self.left > 1)
        self.pairs = np.unique(self.flat[inner] * base + self.flat[inner + 1])

    def search(self, docs: list[list[bytes]]) -> tuple[np.ndarray, ...]:
        """(hit document word places, document of each hit window, item of it, longest
        match per document) for the shard; places run on over the documents."""
        sizes = np.array([len(d) for d in docs], np.int64)
        places = np.zeros(0, np.int64)
        longest = np.zeros(len(docs), np.int64)
        if not len(self.suffix) or not sizes.sum():
            return places, places, places, longest
        get = self.number.get
        ids = np.fromiter((get(w, -1) for d in docs for w in d), np.int64, int(sizes.sum()))
        ends = np.cumsum(sizes)
        linked = np.zeros(len(ids), bool)  # this word and the next, in the same document, stand so in the benchmark
        if len(ids) > 1 and len(self.pairs):
            key = ids[:-1] * max(1, len(self.number)) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            linked[:-1] = (self.pairs[at] == key) & (ids[:-1] >= 0) & (ids[1:] >= 0)
            linked[ends[(ends > 0)] - 1] = False
        stop = np.flatnonzero(~linked)
        run = stop[np.searchsorted(stop, np.arange(len(ids)))] - np.arange(len(ids)) + 1
        start = np.flatnonzero((ids >= 0) & (run >= self.least))  # can begin a window
        if not len(start):
            return places, places, places, longest
        inside = np.zeros(len(ids) + 1, np.int64)
        np.add.at(inside, start, 1)
        np.add.at(inside, start + run[start], -1)
        held = np.flatnonzero(np.cumsum(inside[:-1]) > 0)  # every word of those runs
        array = held[suffix_order(ids[held], run[held])]
        return self._look_up(ids, run, array, sizes, longest)

    def _look_up(self, ids, run, array, sizes, longest):
        doc_of = np.repeat(np.arange(len(sizes)), sizes)
        lo = np.zeros(len(self.suffix), np.int64)
        hi = np.full(len(self.suffix), len(array), np.int64)
        live, depth, hits = np.arange(len(self.suffix)), 0, []

        def word_at(rank, deep):
            at = array[rank]
            return np.where(run[at] > deep, ids[np.minimum(at + deep, len(ids) - 1)], -1)

        def bound(low, high, word, deep, strict):
            low, high = low.copy(), high.copy()
            while (open_ := low < high).any():
                mid = (low + high) // 2
                at = word_at(np.minimum(mid, len(array) - 1), deep)
                less = open_ & ((at <= word) if strict else (at < word))
                low = np.where(less, mid + 1, low)
                high = np.where(open_ & ~less, mid, high)
            return low

        while len(live):
            word = self.flat[self.suffix[live] + depth]
            a, b = bound(lo[live], hi[live], word, depth, False), bound(lo[live], hi[live], word, depth, True)
            found = a < b
            live, a, b = live[found], a[found], b[found]
            lo[live], hi[live] = a, b
            depth += 1
            for k in live[self.need[live] == depth]:
                hits.append((k, lo[k], hi[k]))
            if depth >= self.least and len(live):
                spread = np.unique(np.concatenate([doc_of[array[x:y]] for x, y in set(zip(a.tolist(), b.tolist()))]))
                longest[spread] = depth
            live = live[self.left[self.suffix[live]] > depth]
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), longest * 0
        which = np.array([k for k, _, _ in hits])
        counts = np.array([y - x for _, x, y in hits])
        at = np.concatenate([array[x:y] for _, x, y in hits])
        owner, item = doc_of[at], np.repeat(self.item[self.suffix[which]], counts)
        width = np.repeat(self.need[which], counts)
        marks = np.zeros(len(ids) + 1, np.int64)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + width, -1)
        return np.flatnonzero(np.cumsum(marks[:-1]) > 0), owner, item, longest


def suffix_order(word: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Order of the suffixes that begin at each word and end with its run, by prefix
    doubling: ranks by 1, 2, 4... words until all differ or no run goes on."""
    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
    reach = 1
    here = np.arange(len(word))
    while reach < run.max() and rank.max() < len(word) - 1:
        nxt = np.where(run > reach, rank[np.minimum(here + reach, len(word) - 1)] + 1, 0)
        rank = np.unique(rank * (len(word) + 1) + nxt, return_inverse=True)[1].astype(np.int64)
        reach *= 2
    return np.argsort(rank, kind="stable")


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
           block_bytes: int = BLOCK_BYTES) -> list[Block]:
    """The items in blocks of about ``block_bytes`` of text."""
    out, held, size = [], [], 0
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col(text_col)).toLocalIterator()
    for name, text in rows:
        held.append((name, text))
        size += len(text or "")
        if size >= block_bytes:
            out.append(Block(held, window))
            held, size = [], 0
    return out + [Block(held, window)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, out: str = "contamination") -> DataFrame:
    """``docs`` with struct column ``out``: n_words, n_hit, n_items,
    items_sha256, longest (words of the longest verbatim match that reaches a
    window), contaminated.

    A window is ``window`` consecutive words of an item, or all words of a
    shorter one; items and documents without words match nothing. Null item ids
    read "null"; repeated ids count once. Every row of ``docs`` stays, with all
    its other columns; a column named ``out`` is replaced."""
    spark, docs = docs.sparkSession, docs.drop(out)
    sent = [spark.sparkContext.broadcast(b) for b in blocks(benchmark, window=window, block_bytes=block_bytes)]
    place = docs.columns.index(text_col)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SHARD_ROWS):
            shard = [words_of(t) for t in batch.column(place).to_pylist()]
            sizes = np.array([len(d) for d in shard], np.int64)
            hit = np.zeros(int(sizes.sum()), bool)
            items: list[set[str]] = [set() for _ in shard]
            longest = np.zeros(len(shard), np.int64)
            for b in sent:
                block = b.value
                marked, owner, item, length = block.search(shard)
                hit[marked] = True
                longest = np.maximum(longest, length)
                for d, i in np.unique(np.stack([owner, item], 1), axis=0) if len(owner) else ():
                    items[d].add(block.names[i])
            total = np.concatenate([[0], np.cumsum(hit)])
            ends = np.cumsum(sizes)
            n_hit = total[ends] - total[ends - sizes]
            longest = np.where(n_hit > 0, longest, 0)
            sha = [hashlib.sha256(",".join(sorted(s)).encode()).hexdigest() for s in items]
            cols = [pa.array(sizes), pa.array(n_hit), pa.array([len(s) for s in items], pa.int64()), pa.array(sha),
                    pa.array(longest), pa.array(n_hit > 0)]
            found = pa.StructArray.from_arrays(cols, names)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, out])

    names = _STRUCT.names
    return docs.mapInArrow(search, StructType([*docs.schema.fields, StructField(out, _STRUCT)]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of a benchmark item."""
    out = free_name(docs, "contamination")
    found = find_contamination(docs, benchmark, text_col, window, out=out)
    return found.where(~F.col(f"{out}.contaminated")).drop(out)
