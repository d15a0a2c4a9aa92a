"""Token ids in Arrow files of equal-length sequences.

Documents are range-partitioned by id and sorted; each partition writes one
Arrow IPC file whose batches hold ``ids`` and ``mask`` as fixed-size lists, so
sequence ``i`` of a memory-mapped file is a view at a computed place, without
copying. Tokens run on from sequence to sequence; only a file's last one is
padded, which the mask shows. A second small file lists the file's documents
and where they start. A file counts only if the table of files names it, which
Spark commits once per partition; what a lost or repeated attempt leaves is
never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import open_shared, settle, text_slices
from snaplake.llm.tokens import encoder, end_of
from snaplake.session import work_dir

LENGTH = 2048
ROWS = 256
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Streams ids into one file, ``ROWS`` sequences a batch."""

    def __init__(self, path: str, length: int, width: np.dtype):
        fs, inner = open_shared(path)
        self.length, self.width = length, width
        item = pa.uint16() if width.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = fs.open_output_stream(inner)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.held, self.size, self.total = [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids)
        if self.size >= ROWS * self.length:
            flat = np.concatenate(self.held)
            whole = len(flat) // (ROWS * self.length) * ROWS * self.length
            for at in range(0, whole, ROWS * self.length):
                self._batch(flat[at:at + ROWS * self.length], ROWS * self.length)
            self.held, self.size = [flat[whole:]], len(flat) - whole

    def _batch(self, flat: np.ndarray, used: int) -> None:
        flat = np.pad(flat, (0, -len(flat) % self.length))
        ids = pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length)
        mask = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(flat)) < used), self.length)
        self.writer.write_batch(pa.record_batch([ids, mask], schema=self.schema))

    def close(self) -> None:
        if self.size:
            flat = np.concatenate(self.held)
            self._batch(flat, len(flat))
        self.writer.close()
        self.sink.close()


class SequenceFile:
    """Random access to a file: views of its sequences and masks, no copies."""

    def __init__(self, path: str):
        fs, inner = open_shared(path)
        local = fs.type_name == "local"
        self.source = pa.memory_map(inner) if local else fs.open_input_file(inner)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.last = (-1, np.zeros(0))

    def batch(self, i: int) -> np.ndarray:
        """All ids of batch ``i``, padding included; the last one asked for stays at hand."""
        if self.last[0] != i:
            self.last = (i, self.reader.get_batch(i).column(0).flatten().to_numpy(zero_copy_only=True))
        return self.last[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at = i % ROWS * self.length
        got = self.reader.get_batch(i // ROWS)
        mask = got.column(1).flatten()[at:at + self.length].to_numpy(zero_copy_only=False)
        return self.batch(i // ROWS)[at:at + self.length], mask

    def tokens(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Views that together are the ``count`` ids from ``start`` on."""
        step = ROWS * self.length
        while count > 0:
            at = start % step
            part = self.batch(start // step)[at:at + count]
            yield part
            start, count = start + len(part), count - len(part)

    def close(self) -> None:
        self.last = (-1, np.zeros(0))  # a view of the file
        self.source.close()


def write_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH) -> DataFrame:
    """Encode, write, and return the table of files (part, ids_path, docs_path,
    n_tokens, base): ``base`` counts the ids in the files before it.

    Null texts count as empty (the end id alone); null ids sort first, and
    repeated ids by text. An empty table gives no files."""
    folder = work_dir(docs.sparkSession, "tokens")
    width_cast = pa.int64()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, out, index, rows = encoder(tokenizer_path), TaskContext.get().partitionId(), None, None, []
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        for batch in text_slices(batches, 256):
            if out is None:
                fs, inner = open_shared(folder)
                fs.create_dir(inner, recursive=True)
                out = SequenceWriter(f"{name}.ids.arrow", length, enc.width)
                fs, inner = open_shared(f"{name}.docs.arrow")
                sink = fs.open_output_stream(inner)
                index = pa.ipc.new_file(sink, INDEX)
            rows, starts = [], []
            for ids in map(end_of, enc.many(batch.column(1).to_pylist())):
                starts.append(out.total)
                rows.append(len(ids))
                out.add(ids)
            index.write_batch(pa.record_batch([batch.column(0).cast(width_cast), pa.array(starts, pa.int64()),
                                               pa.array(rows, pa.int64())], schema=INDEX))
        if out is not None:
            out.close()
            index.close()
            sink.close()
            yield pa.record_batch({"part": pa.array([part], pa.int64()), "ids_path": [f"{name}.ids.arrow"],
                                   "docs_path": [f"{name}.docs.arrow"], "n_tokens": pa.array([out.total], pa.int64())})

    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
               .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text"))
    files = settle(ordered.mapInArrow(write, "part long, ids_path string, docs_path string, n_tokens long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seqs = SequenceFile(row["ids_path"])
                fs, inner = open_shared(row["docs_path"])
                with fs.open_input_file(inner) as source:
                    index = pa.ipc.open_file(source)
                    for i in range(index.num_record_batches):
                        docs = index.get_batch(i)
                        starts, counts = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                        sums = []
                        for start, count in zip(starts, counts):
                            crc = 0
                            for view in seqs.tokens(int(start), int(count)):
                                crc = zlib.crc32(view.astype("<u4"), crc)
                            sums.append(crc)
                        yield pa.record_batch({"doc_id": docs.column(0), "start": pa.array(starts + row["base"]),
                                               "n_tokens": docs.column(2), "ids_crc32": pa.array(sums, pa.int64())})
                seqs.close()

    files = settle(files, "token-bases")
    return files.repartition(max(1, files.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
