"""Readers for text exports: CSV folders, matrix sheets and archives of CSV files.

Every value is read as text. Each row keeps its origin (``ORIGIN``): the file, the
start of the split it was read from and a row number that ascends inside the
split. Together they restore line order after any shuffle.

Folders mix files with different headers. A first pass takes the first line of every file, and files are grouped by
equal headers. Each group is then read by itself, its columns found by position, so rows are neither joined nor shuffled and each is
parsed once.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from haulmark.functions.text import strip
from haulmark.operators.columns import col
from haulmark.plans.specs import TableSpec
from haulmark.session import scratch_path
from haulmark.sources.routing import is_bundle, route_file, route_member

__all__ = ["ORIGIN", "ARRIVAL", "Header", "scan_csv_strings", "list_files", "read_headers", "read_table_rows",
           "read_matrix_rows", "matrix_cells", "read_matrix_cells", "read_surplus_rows", "read_bundle_rows", "bundle_rows",
           "archive_members", "member_rows", "bundle_table_rows"]

# Columns that say where a row came from, in row order.
ORIGIN = ("file_path", "file_name", "split_start", "split_row")
ARRIVAL = ("split_start", "split_row")
#: Different headers that are read one by one; beyond, files of one width are read together and their headers joined.
GROUPS = 48


def scan_csv_strings(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All-text scan of CSV files that share one header.

    A file whose header differs makes the scan fail instead of shifting values.
    Blank cells read as null, which every parser treats like blank text.
    """
    return (
        spark.read.option("header", True).option("inferSchema", False)
        .option("enforceSchema", False).option("multiLine", multi_line)
        .option("escape", '"').csv(path))


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Files under a folder, or of a list, with their target table, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_paths(path)).select(
        _decoded("file_path"), _decoded("file_name"), "length", "modificationTime")
    return files.withColumn("table", F.when(is_bundle(F.col("file_name")), "(bundle)")
                            .otherwise(route_file(F.col("file_name"))))


def _paths(path: str | Sequence[str]) -> list[str]:
    """A folder as it is; listed files with the characters that patterns are made of escaped."""
    return [path] if isinstance(path, str) else [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in path]


def _decoded(name: str) -> Column:
    """A file's path or name as written; the metadata column is percent-encoded."""
    encoded = F.col(f"_metadata.{name}")
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))).alias(name)


# A quoted cell of a CSV line; a comma inside is no separator.
_QUOTED = r'"([^"]|"")*"'
# Separators and blank cells at the end of a line.
_BLANK_END = r'([,\s]|(?<=,)"\s*")+$'


def _routed(frame: DataFrame, table: str | None) -> DataFrame:
    """A filter on the file name alone skips the other files before reading."""
    return frame.filter(route_file(_decoded("file_name")) == table) if table else frame


def _csv(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], multi_line: bool, header: bool) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return (
        spark.read.schema(schema).option("header", header).option("multiLine", multi_line)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "line")
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.[cC][sS][vV]").csv(_paths(path)))


def _separators(line: Column) -> Column:
    plain = F.regexp_replace(line, _QUOTED, "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(",")))


@dataclass
class Header:
    """A header and the files that have it."""

    cells: list[str]
    files: list[str] = field(default_factory=list)

    @property
    def labels(self) -> list[str]:
        return [c.strip() for c in self.cells]

    @property
    def names(self) -> list[str]:
        """Labels in lower case; a repeated one gets its position."""
        low = [c.lower() for c in self.labels]
        return [n if not n or low.index(n) == i else f"{n}.{i}" for i, n in enumerate(low)]

    @property
    def columns(self) -> int:
        """Cells up to the last one with a label."""
        return max((i + 1 for i, n in enumerate(self.names) if n), default=0)


def read_headers(spark: SparkSession, path: str | Sequence[str], table: str | None = None, multi_line: bool = True) -> list[Header]:
    """The different headers of the CSV files, each with its files, in the order of their text.

    Lines are looked at, not parsed; a header that goes on in the next line is read again as CSV. The driver gets every
    different header once, and the file names, of which it holds a list in any case.
    """
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.[cC][sS][vV]").text(_paths(path))
    lines = _routed(text, table).select(
        _decoded("file_path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"), "value")
    first = lines.filter("start = 0 and value != ''").groupBy("file_path").agg(F.min_by("value", "n").alias("head"))
    found: dict[tuple[str, ...], list[str]] = {}
    open_: list[str] = []
    for r in first.groupBy("head").agg(F.sort_array(F.collect_list("file_path")).alias("files")).collect():
        head = r["head"].removeprefix("\ufeff")
        if multi_line and head.count('"') % 2:
            open_ += r["files"]
        else:
            found.setdefault(tuple(next(csv.reader([head]), [])), []).extend(r["files"])
    if open_:
        whole = _csv(spark, open_, ["c0", "line"], True, False).select(
            _decoded("file_path"), F.monotonically_increasing_id().alias("n"), F.coalesce("line", "c0").alias("head"))
        for r in whole.groupBy("file_path").agg(F.min_by("head", "n").alias("head")).collect():
            found.setdefault(tuple(next(csv.reader(io.StringIO(r["head"].removeprefix("\ufeff"), newline="")), [])), []).append(r["file_path"])
    return [Header(list(cells), sorted(files)) for cells, files in sorted(found.items())]


def _rows(spark: SparkSession, files: list[str], width: int, multi_line: bool) -> DataFrame:
    """Rows of files whose header has ``width`` cells: origin, cells c0, c1 ..., and ``beyond``, the line of a row with text past them."""
    names = [f"c{i}" for i in range(max(width, 1))]
    # one column more: a line of exactly that many cells fits the schema, all others are handed over as text
    frame = _csv(spark, files, [*names, "over", "line"], multi_line, True)
    past = _separators(F.regexp_replace("line", _BLANK_END, "")) + 1 > len(names)
    beyond = F.when(F.trim("over") != "", F.coalesce("line", "over")).when(past, F.col("line"))
    return frame.select(
        _decoded("file_path"), _decoded("file_name"), F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("split_row"), *names, beyond.alias("beyond"))


def _surplus(cells: Column, columns: Column) -> Column:
    """Cells with text past the last header; null if there are none."""
    extra = F.filter(F.slice(cells, columns + 1, F.size(cells)), lambda x: F.trim(x) != "")
    return F.when(F.col("beyond").isNotNull(), F.array("beyond")).when(F.size(extra) > 0, extra)


def _found(spec: TableSpec, names: list[str], wanted: Sequence[str]) -> dict[str, int]:
    """Where each wanted header stands; the first header with "date" stands in for a missing date column."""
    at = {h: names.index(h) for h in wanted if h in names}
    if spec.date_column:
        known = [h for h, target in spec.aliases.items() if target == spec.date_column]
        dated = [n for n in names if "date" in n]
        if dated and not set(names) & {*known, spec.date_column}:
            at.setdefault(spec.date_column, names.index(dated[0]))
    return at


def read_table_rows(spark: SparkSession, path: str | Sequence[str], spec: TableSpec, table: str | None = None,
                    multi_line: bool = True, extra: Sequence[str] = ()) -> DataFrame:
    """Origin columns, one text column per known header of ``spec``, and ``cells`` and ``surplus`` of rows with text past their file's last header.

    Files may have any width; ``surplus`` is null for rows that fit. With ``table`` only the files routed to it are read. ``multi_line`` accepts
    line breaks inside quotes; set it to False for large files without any, which
    may then be split between tasks.
    """
    wanted = list(dict.fromkeys([*spec.aliases, *[f.source or f.name for f in spec.fields], *extra]))
    headers = read_headers(spark, path, table, multi_line)
    if len(headers) > GROUPS:
        places = T.StructType([T.StructField(h, T.IntegerType()) for h in wanted])
        rows = _joined(spark, headers, multi_line, lambda h: tuple(_found(spec, h.names, wanted).get(w) for w in wanted), places)
        return rows.select(*ORIGIN, *[F.get("cells", col(h, "found")).alias(h) for h in wanted],
                           F.when(F.col("surplus").isNotNull(), F.col("cells")).alias("cells"), "surplus")
    frames = []
    for h in headers:
        at = _found(spec, h.names, wanted)
        cells = F.array(*[col(f"c{i}") for i in range(max(len(h.cells), 1))])
        surplus = _surplus(cells, F.lit(h.columns))
        frames.append(_rows(spark, h.files, len(h.cells), multi_line).select(
            *ORIGIN, *[(col(f"c{at[w]}") if w in at else F.lit(None).cast("string")).alias(w) for w in wanted],
            F.when(surplus.isNotNull(), cells).alias("cells"), surplus.alias("surplus")))
    if not frames:
        text = ", ".join(f"`{c}` string" for c in ("file_path", "file_name"))
        more = ", ".join(f"`{w}` string" for w in wanted)
        return spark.createDataFrame([], f"{text}, split_start bigint, split_row bigint, {more}, cells array<string>, surplus array<string>")
    return reduce(DataFrame.unionByName, frames)


def _joined(spark: SparkSession, headers: list[Header], multi_line: bool, value, kind: T.DataType) -> DataFrame:
    """Rows (origin, cells, surplus, found) of files read by width; ``found`` is ``value`` of their header.

    A row per file is joined, which Spark broadcasts where it is small; the rows stay where they are then.
    """
    width: dict[int, list[Header]] = {}
    for h in headers:
        width.setdefault(max(len(h.cells), 1), []).append(h)
    frames = [_rows(spark, [f for h in same for f in h.files], w, multi_line).select(
        *ORIGIN, F.array(*[col(f"c{i}") for i in range(w)]).alias("cells"), "beyond") for w, same in sorted(width.items())]
    known = spark.createDataFrame([(f, h.columns, value(h)) for h in headers for f in h.files], T.StructType([
        T.StructField("file_path", T.StringType()), T.StructField("columns", T.IntegerType()), T.StructField("found", kind)]))
    rows = reduce(DataFrame.unionByName, frames).join(known, "file_path")
    return rows.select(*ORIGIN, "cells", _surplus(F.col("cells"), F.col("columns")).alias("surplus"), "found")


def read_matrix_rows(spark: SparkSession, path: str | Sequence[str], spec: TableSpec | None = None, table: str | None = None,
                     multi_line: bool = True) -> DataFrame:
    """Matrix files of any width as rows (origin, labels, cells, surplus); ``labels`` is the file's own header."""
    headers = read_headers(spark, path, table, multi_line)
    if len(headers) > GROUPS:
        rows = _joined(spark, headers, multi_line, lambda h: h.labels, T.ArrayType(T.StringType()))
        return rows.select(*ORIGIN, F.col("found").alias("labels"), "cells", "surplus")
    frames = []
    for h in headers:
        cells = F.array(*[col(f"c{i}") for i in range(max(len(h.cells), 1))])
        frames.append(_rows(spark, h.files, len(h.cells), multi_line).select(
            *ORIGIN, F.array(*[F.lit(x) for x in h.labels]).cast("array<string>").alias("labels"), cells.alias("cells"),
            _surplus(cells, F.lit(h.columns)).alias("surplus")))
    if not frames:
        return spark.createDataFrame([], "file_path string, file_name string, split_start bigint, split_row bigint, labels array<string>, "
                                         "cells array<string>, surplus array<string>")
    return reduce(DataFrame.unionByName, frames)


def matrix_cells(rows: DataFrame) -> DataFrame:
    """Matrix rows as (origin, metric, label, cell), a row per labelled cell after the first."""
    cells = rows.select(*ORIGIN, F.get("cells", F.lit(0)).alias("metric"), "labels", F.posexplode("cells").alias("spot", "cell"))
    label = F.get("labels", F.col("spot"))
    return cells.filter((F.col("spot") > 0) & (label != "")).select(*ORIGIN, "metric", label.alias("label"), "cell")


def read_matrix_cells(spark: SparkSession, path: str | Sequence[str], table: str | None = None, multi_line: bool = True) -> DataFrame:
    """``matrix_cells`` of the rows without text past the last header."""
    return matrix_cells(read_matrix_rows(spark, path, None, table, multi_line).filter("surplus is null"))


def read_surplus_rows(spark: SparkSession, path: str | Sequence[str], table: str | None = None, multi_line: bool = True) -> DataFrame:
    """Rows (origin, cells, surplus) with text in cells that no header of their file stands over."""
    return read_matrix_rows(spark, path, None, table, multi_line).filter("surplus is not null").select(*ORIGIN, "cells", "surplus")


_MEMBERS = pa.schema([("file_path", pa.string()), ("file_name", pa.string()), ("member", pa.string()), ("method", pa.int32()), ("data", pa.binary())])
_MEMBER_ROWS = pa.schema([("file_path", pa.string()), ("file_name", pa.string()), ("member", pa.string()), ("row_no", pa.int64()),
                          ("cells", pa.map_(pa.string(), pa.string())), ("surplus", pa.list_(pa.string()))])
#: Rows of a member handed on together.
_ROWS = 4096
#: Members up to which each is a task of its own; of more, several share a task.
MEMBERS = 2000


def archive_members(content: bytes) -> Iterator[tuple[str, int, bytes]]:
    """(name, method, bytes as stored) of the CSV members of an archive, by its central directory; nothing is unpacked."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for info in archive.infolist():
            if not info.filename.lower().endswith(".csv"):
                continue
            if info.flag_bits & 1 or info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                raise ValueError(f"member {info.filename} is encrypted or compressed by an unknown method")
            # the local header repeats the name and has extra bytes of its own
            at = info.header_offset + 30 + sum(int.from_bytes(content[info.header_offset + k:info.header_offset + k + 2], "little") for k in (26, 28))
            yield info.filename, info.compress_type, content[at:at + info.compress_size]


class _Inflated(io.RawIOBase):
    """Stored bytes of a member, unpacked as they are read."""

    def __init__(self, data: bytes, method: int):
        self._data, self._at = data, 0
        self._unpack = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
        self._rest = b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self._rest and self._at < len(self._data):
            piece = self._data[self._at:self._at + (1 << 16)]
            self._at += len(piece)
            self._rest = self._unpack.decompress(piece) if self._unpack else piece
        n = min(len(buffer), len(self._rest))
        buffer[:n], self._rest = self._rest[:n], self._rest[n:]
        return n


def member_rows(data: bytes, method: int) -> Iterator[tuple[int, dict[str, str | None], list[str] | None]]:
    """(row number, {header: text}, surplus) for each data row of a member.

    Cells belong to headers from the left; of equal headers the first one counts.
    ``surplus`` holds the cells beyond the last header, if any of them has text.
    """
    reader = csv.reader(io.TextIOWrapper(io.BufferedReader(_Inflated(data, method)), encoding="utf-8-sig", newline=""))
    header = [h.strip().lower() for h in next(reader, [])]
    for number, values in enumerate(v for v in reader if v):
        cells: dict[str, str | None] = {}
        for k, name in enumerate(header):
            cells.setdefault(name, values[k] if k < len(values) else None)
        beyond = values[len(header):]
        yield number, cells, beyond if any(v.strip() for v in beyond) else None


def _split_archives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            path, name, content = (batch.column(c)[k].as_py() for c in ("file_path", "file_name", "content"))
            for member, method, data in archive_members(content):
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((path, name, member, method, data), _MEMBERS)], schema=_MEMBERS)


def _parse_members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MEMBER_ROWS)], schema=_MEMBER_ROWS)

    for batch in batches:
        for k in range(batch.num_rows):
            path, name, member, method, data = (batch.column(c)[k].as_py() for c in _MEMBERS.names)
            held: list[tuple] = []
            for number, cells, surplus in member_rows(data, method):
                held.append((path, name, member, number, list(cells.items()), surplus))
                if len(held) == _ROWS:
                    yield batch_of(held)
                    held = []
            if held:
                yield batch_of(held)


def bundle_rows(archives: DataFrame) -> DataFrame:
    """Rows (file_path, file_name, member, row_no, cells, surplus, table) of the CSV members of archives (file_path, file_name, content).

    An archive is read once, and its members, still packed, become rows in the shared folder; then each member is a task of its own,
    which unpacks it as a stream.
    """
    spark = archives.sparkSession
    path = scratch_path(spark, "members")
    archives.select("file_path", "file_name", "content").mapInArrow(
        _split_archives, "file_path string, file_name string, member string, method int, data binary").write.parquet(path)
    members = spark.read.schema("file_path string, file_name string, member string, method int, data binary").parquet(path)
    if (tasks := members.select("member").count()) <= MEMBERS:
        # the names alone are numbered, so that each member gets a task to itself
        names = members.groupBy().agg(F.array_sort(F.collect_set(F.struct("file_path", "member"))).alias("all"))
        numbered = names.select(F.posexplode("all").alias("number", "m")).select("number", "m.*")
        members = members.join(F.broadcast(numbered), ["file_path", "member"])
    else:
        tasks = MEMBERS
        members = members.withColumn("number", F.pmod(F.hash("file_path", "member"), F.lit(tasks)))
    dealt = members.repartitionById(max(tasks, 1), F.col("number").cast("int")).select(*_MEMBERS.names)
    rows = dealt.mapInArrow(_parse_members, "file_path string, file_name string, member string, row_no bigint, cells map<string,string>, surplus array<string>")
    return rows.withColumn("table", route_member(F.col("member")))


def read_bundle_rows(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``bundle_rows`` of the work-report archives under ``path``."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.[zZ][iI][pP]").load(_paths(path))
        .filter(is_bundle(_decoded("file_name")))
        .select(_decoded("file_path"), _decoded("file_name"), "content"))
    return bundle_rows(files)


def bundle_table_rows(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The bundle rows of one table with a text column per known header, without rows that have surplus cells."""
    wanted = dict.fromkeys([*spec.aliases, *[f.source or f.name for f in spec.fields]])
    return rows.filter((F.col("table") == spec.table) & F.col("surplus").isNull()).select(
        "file_path", "file_name", "member", "row_no",
        *[F.try_element_at("cells", F.lit(h)).alias(h) for h in wanted])
