"""Zipped, headerless CSV extracts as a Spark data source.

``spark.read.format("zipcsv").option("table", "empresas").load(path)``
reads every ``*.zip`` under ``path`` (a file or a folder, any filesystem
pyarrow can open: local, HDFS, S3, GCS). One input partition per zip: zips
cannot be split, so parallelism is the number of zips. Each executor streams
the zip's **first** member (an empty zip is an error), decodes it as
ISO-8859-1 and parses it with ``;`` separators and ``"`` quotes (doubled
quotes and quoted newlines honoured) with pyarrow's streaming CSV parser,
yielding Arrow batches, so a multi-GB member never sits in memory.

Row rules (matching the reference's reader): empty lines are skipped; short
rows are padded with nulls; rows with too many fields are dropped; empty fields
become null; ``na_tokens`` (default none) lists further field values to read as
null. The output adds ``_arquivo_origem``, the zip's file name.

Nothing is dropped unseen. With ``counts`` the last row of each zip carries how many rows
it gave, how many of them were padded and how many lines were dropped (``_contagem``,
null on every other row). With ``rejects`` the dropped lines are the rows: file, text
and number of fields.
"""

from __future__ import annotations

import csv
import io
import logging
import posixpath
import zipfile
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from snaplake.schemas import columns_of

log = logging.getLogger(__name__)

# The tokens pandas reads as missing by default (its
# ``keep_default_na`` list), for parity runs with ``na_tokens="pandas"``.
PANDAS_DEFAULT_NA = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

ORIGIN_COLUMN = "_arquivo_origem"
PATH_COLUMN = "_path"
COUNTS_COLUMN = "_contagem"
COUNTS_TYPE = "struct<n_rows:bigint,n_padded:bigint,n_rejected:bigint>"
REJECT_SCHEMA = "_arquivo_origem string, linha string, n_campos int"


def _filesystem(uri: str):
    """(pyarrow filesystem, path) for a local path or any URI pyarrow knows."""
    import pyarrow.fs as pafs

    if uri.startswith("file://"):
        return pafs.LocalFileSystem(), uri[len("file://"):]
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri[len("file:"):]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    if scheme in ("s3a", "s3n"):  # Hadoop's S3 schemes; pyarrow names it s3
        uri = f"s3://{rest}"
    return pafs.FileSystem.from_uri(uri)


def list_zips(uri: str) -> list[str]:
    """Zip files at ``uri`` (a zip or a folder, searched recursively), by name."""
    import pyarrow.fs as pafs

    fs, path = _filesystem(uri)
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.File:
        found = [path]
    elif info.type == pafs.FileType.Directory:
        sel = pafs.FileSelector(path, recursive=True)
        found = [i.path for i in fs.get_file_info(sel)
                 if i.type == pafs.FileType.File and i.path.lower().endswith(".zip")]
    else:
        raise FileNotFoundError(uri)
    prefix = uri[: len(uri) - len(path)] if uri.endswith(path) else ""
    return sorted((prefix + p for p in found), key=lambda p: (posixpath.basename(p), p))


class _RandomAccess(io.RawIOBase):
    """pyarrow input file as a Python file; bad seeks raise ``OSError`` as
    ``zipfile`` expects (pyarrow raises its own error type)."""

    def __init__(self, f):
        self.f = f

    def readable(self):
        return True

    def seekable(self):
        return True

    def readinto(self, b):
        data = self.f.read(len(b))
        b[: len(data)] = data
        return len(data)

    def read(self, n=-1):
        return self.f.read() if n is None or n < 0 else self.f.read(n)

    def seek(self, offset, whence=0):
        try:
            return self.f.seek(offset, whence)
        except Exception as e:  # noqa: BLE001
            raise OSError(str(e)) from e

    def tell(self):
        return self.f.tell()


class ZipPartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Lines:
    """Lines of a text, remembering those of the row being parsed."""

    def __init__(self, text: io.TextIOBase):
        self.text = text
        self.said: list[str] = []

    def __iter__(self) -> Iterator[str]:
        for line in self.text:
            self.said.append(line)
            yield line


def parse_lines(text: io.TextIOBase, width: int, na: frozenset[str], tally: Tally) -> Iterator[list]:
    """Rows of exactly ``width`` fields; over-long rows are noted in ``tally``."""
    lines = _Lines(text)
    for fields in csv.reader(lines, delimiter=";", quotechar='"', doublequote=True, strict=False):
        if len(fields) > width:
            tally.reject("".join(lines.said).rstrip("\r\n"), len(fields))
        elif fields:
            row = [None if (f == "" or f in na) else f for f in fields]
            if len(row) < width:
                tally.padded += 1
                row.extend([None] * (width - len(row)))
            yield row
        lines.said.clear()


class Tally:
    """What a zip gave: rows, how many of them padded, and the lines dropped (their texts
    are kept up to the next ``take`` only where ``keep`` says so)."""

    def __init__(self, keep: bool):
        self.keep = keep
        self.rows = self.padded = self.rejected = 0
        self.held: list[tuple[str, int]] = []

    def reject(self, text: str, fields: int) -> None:
        self.rejected += 1
        if self.keep:
            self.held.append((text, fields))

    def take(self) -> list[tuple[str, int]]:
        held, self.held = self.held, []
        return held


class ZipCsvReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.options = options
        self.schema = schema
        self.path = options.get("path")
        self.paths = [p for p in options.get("paths", "").split("\n") if p]
        if not self.path and not self.paths:
            raise ValueError("zipcsv needs a path (or paths)")
        self.rejects = options.get("rejects") == "true"
        self.counts = any(f.name == COUNTS_COLUMN for f in schema.fields)
        self.columns = declared(options)
        self.with_path = any(f.name == PATH_COLUMN for f in schema.fields)
        self.encoding = options.get("encoding", "iso-8859-1")
        self.chunk_rows = int(options.get("chunk_rows", 100_000))
        self.block_bytes = int(options.get("block_bytes", 1 << 20))
        self.parser = options.get("parser", "arrow")
        tokens = options.get("na_tokens", "")
        if tokens == "pandas":
            self.na = frozenset(PANDAS_DEFAULT_NA)
        else:
            self.na = frozenset(t for t in tokens.split("|") if t) if tokens else frozenset()

    def partitions(self):
        found = list(self.paths)
        if self.path:
            found += list_zips(self.path)
        return [ZipPartition(p) for p in found]

    def read(self, partition: ZipPartition):
        fs, path = _filesystem(partition.path)
        name = posixpath.basename(path)
        with fs.open_input_file(path) as raw, zipfile.ZipFile(_RandomAccess(raw)) as zf:
            members = zf.namelist()
            if not members:
                raise RuntimeError(f"empty zip: {name}")
            tally = Tally(self.rejects)
            with zf.open(members[0]) as stream:
                read = self._read_python if self.parser == "python" else self._read_arrow
                for b in read(stream, name, tally):
                    tally.rows += b.num_rows
                    if not self.rejects:
                        yield self._finished(b, partition.path)
                    elif tally.held:
                        yield self._rejected(tally.take(), name)
            if self.rejects:
                if tally.held:
                    yield self._rejected(tally.take(), name)
            elif self.counts:
                yield self._finished(self._batch([[None] for _ in self.columns], name), partition.path, tally)
            if tally.rejected and not self.rejects:
                log.warning("%s: %d over-long rows skipped", name, tally.rejected)

    @staticmethod
    def _rejected(held: list[tuple[str, int]], name: str):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(held), pa.string()), pa.array([t for t, _ in held], pa.string()), pa.array([n for _, n in held], pa.int32())],
            names=[ORIGIN_COLUMN, "linha", "n_campos"])

    def _finished(self, batch, path: str, tally: Tally | None = None):
        """With the zip's path and, on its last row, its counts."""
        import pyarrow as pa

        if self.with_path:
            batch = self._with_path(batch, path)
        if self.counts:
            kind = pa.struct([("n_rows", pa.int64()), ("n_padded", pa.int64()), ("n_rejected", pa.int64())])
            last = pa.nulls(batch.num_rows, kind) if tally is None else pa.array(
                [{"n_rows": tally.rows, "n_padded": tally.padded, "n_rejected": tally.rejected}], kind)
            batch = pa.RecordBatch.from_arrays([*batch.columns, last], names=[*batch.schema.names, COUNTS_COLUMN])
        return batch

    @staticmethod
    def _with_path(batch, path: str):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(
            list(batch.columns) + [pa.array([path] * batch.num_rows, pa.string())],
            names=list(batch.schema.names) + [PATH_COLUMN])

    def _batch(self, cols: list[list], name: str):
        import pyarrow as pa

        n = len(cols[0]) if cols else 0
        arrays = [pa.array(c, pa.string()) for c in cols] + [pa.array([name] * n, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=self.columns + [ORIGIN_COLUMN])

    def _read_python(self, stream, name: str, tally: Tally):
        """Pure-Python parse (``csv`` module), ``chunk_rows`` rows per batch."""
        text = io.TextIOWrapper(stream, encoding=self.encoding, newline="")
        rows = []
        for row in parse_lines(text, len(self.columns), self.na, tally):
            rows.append(row)
            if len(rows) == self.chunk_rows:
                yield self._batch([list(c) for c in zip(*rows)], name)
                rows = []
        if rows:
            yield self._batch([list(c) for c in zip(*rows)], name)

    def _read_arrow(self, stream, name: str, tally: Tally):
        """pyarrow's streaming C++ parser; rows with the wrong field count are
        handed back by its invalid-row hook and finished by ``parse_lines``
        (short rows padded, long rows dropped), so no row is lost."""
        import pyarrow as pa
        import pyarrow.csv as pc

        width = len(self.columns)
        odd: list[str] = []

        def on_invalid(row):
            odd.append(row.text)
            return "skip"

        reader = pc.open_csv(
            stream,
            # On its own threads the parser reads as many blocks ahead as the machine has cores.
            read_options=pc.ReadOptions(column_names=self.columns, encoding=self.encoding,
                                        block_size=self.block_bytes, use_threads=False),
            parse_options=pc.ParseOptions(delimiter=";", quote_char='"', double_quote=True,
                                          newlines_in_values=True, ignore_empty_lines=True,
                                          invalid_row_handler=on_invalid),
            convert_options=pc.ConvertOptions(
                column_types={c: pa.string() for c in self.columns},
                strings_can_be_null=True, quoted_strings_can_be_null=True,
                null_values=sorted(self.na | {""})),
        )
        origin = None
        for batch in reader:
            if batch.num_rows:
                if origin is None or len(origin) != batch.num_rows:
                    origin = pa.array([name] * batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays(list(batch.columns) + [origin],
                                                 names=self.columns + [ORIGIN_COLUMN])
            if len(odd) >= self.chunk_rows:
                yield from self._finish(odd, width, name, tally)
                odd = []
        if odd:
            yield from self._finish(odd, width, name, tally)

    def _finish(self, texts: list[str], width: int, name: str, tally: Tally):
        rows = list(parse_lines(io.StringIO("\n".join(texts), newline=""), width, self.na, tally))
        if rows:
            yield self._batch([list(c) for c in zip(*rows)], name)


def declared(options: dict) -> list[str]:
    """The table's own columns."""
    cols = options.get("columns")
    return cols.split(",") if cols else columns_of(options.get("table", ""))


class ZipCsvDataSource(DataSource):
    """Options: ``table`` (schema by name) or ``columns`` (``a,b,c``),
    ``encoding``, ``na_tokens`` (``|``-separated, or ``pandas``),
    ``parser`` (``arrow``, default, or ``python``), ``chunk_rows``,
    ``block_bytes``, ``with_path``, ``counts``, ``rejects``."""

    @classmethod
    def name(cls) -> str:
        return "zipcsv"

    def schema(self):
        if self.options.get("rejects") == "true":
            return REJECT_SCHEMA
        fields = [f"`{c}` string" for c in declared(self.options)] + [f"{ORIGIN_COLUMN} string"]
        if self.options.get("with_path") == "true":
            fields.append(f"{PATH_COLUMN} string")
        if self.options.get("counts") == "true":
            fields.append(f"{COUNTS_COLUMN} {COUNTS_TYPE}")
        return ", ".join(fields)

    def reader(self, schema: StructType) -> ZipCsvReader:
        return ZipCsvReader(self.options, schema)


def register(spark) -> None:
    from snaplake.session import ship_code

    ship_code(spark)
    spark.dataSource.register(ZipCsvDataSource)


def read_zips(spark, path: str | list[str], table: str | None = None,
              columns: list[str] | None = None,
              na_tokens: str | list[str] | None = None, encoding: str = "iso-8859-1",
              parser: str = "arrow", with_path: bool = False, counts: bool = False, rejects: bool = False):
    """DataFrame over the zips at ``path`` (a zip, a folder, or a list of
    zips): declared columns + ``_arquivo_origem``; with ``counts`` a last row per zip
    that only counts; with ``rejects`` the dropped lines instead."""
    if table is not None:
        columns_of(table)  # unknown table -> ValueError before any read
    register(spark)
    r = (spark.read.format("zipcsv").option("encoding", encoding).option("parser", parser)
         .option("with_path", "true" if with_path else "false")
         .option("counts", "true" if counts else "false").option("rejects", "true" if rejects else "false"))
    if table is not None:
        r = r.option("table", table)
    if columns is not None:
        r = r.option("columns", ",".join(columns))
    if na_tokens:
        r = r.option("na_tokens", na_tokens if isinstance(na_tokens, str) else "|".join(na_tokens))
    if isinstance(path, (list, tuple)):
        return r.option("paths", "\n".join(path)).load()
    return r.load(path)
