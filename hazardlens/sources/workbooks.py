"""Returned workbooks as a DataFrame: one task reads one folder slice, file by file.

Spark lists and distributes the files; the decoder below only turns the cells of one
sheet into text, a batch of rows at a time. A workbook is at most some 20 MB, and
Spark packs at most ``spark.sql.files.maxPartitionBytes`` of them into a task.
"""

from __future__ import annotations

import io
import itertools
import re
import sys
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.functions.numbers import parse_float
from hazardlens.operators.quality import kind_column, unusable_files
from hazardlens.schemas import KINDS

# tasks get the decoder's code along, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT_SHEET = "Output"
README_SHEET = "ReadMe"

# rows of one record batch, and bytes of a sheet that are parsed at a time
BATCH_ROWS = 4096
CHUNK_BYTES = 1 << 16

# fixed values: namespaces of the workbook format
_SHEET_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINK_ATTRIBUTE = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

UNREADABLE = (ValueError, KeyError, zipfile.BadZipFile, ElementTree.ParseError, expat.ExpatError)


def _sheet_path(book: zipfile.ZipFile, sheet: str) -> str:
    listed = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{{{_SHEET_NS}}}sheet")
    link = next((s.get(_LINK_ATTRIBUTE) for s in listed if s.get("name") == sheet), None)
    if link is None:
        raise ValueError(f"no sheet {sheet}")
    for rel in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if rel.get("Id") == link:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else "xl/" + target
    raise ValueError(f"sheet {sheet} has no part in the file")


class _Cursor:
    """Reads one XML part chunk by chunk and hands out what its elements gave; nothing read is kept."""

    def __init__(self, handlers: dict[str, tuple]):
        self.done: list = []
        self.text: list[str] | None = None
        self._handlers = {f"{_SHEET_NS} {tag}": pair for tag, pair in handlers.items()}
        self._parser = expat.ParserCreate(namespace_separator=" ")
        self._parser.buffer_text = True
        self._parser.StartElementHandler = self._start
        self._parser.EndElementHandler = self._end
        self._parser.CharacterDataHandler = self._characters

    def _start(self, tag, attributes):
        if tag in self._handlers:
            self._handlers[tag][0](attributes)

    def _end(self, tag):
        if tag in self._handlers:
            self._handlers[tag][1]()

    def _characters(self, data):
        if self.text is not None:
            self.text.append(data)

    def collect(self, _=None):
        self.text = []

    def collected(self) -> str:
        found, self.text = "".join(self.text or ()), None
        return found

    def read(self, part) -> Iterator:
        while chunk := part.read(CHUNK_BYTES):
            self._parser.Parse(chunk, False)
            yield from self.done
            self.done.clear()
        self._parser.Parse(b"", True)
        yield from self.done
        self.done.clear()


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    """The workbook's table of texts, each the sum of its runs."""
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    runs: list[str] = []
    cursor = _Cursor(
        {
            "si": (lambda _: runs.clear(), lambda: cursor.done.append("".join(runs))),
            "t": (lambda _: cursor.collect(), lambda: runs.append(cursor.collected())),
        }
    )
    with book.open("xl/sharedStrings.xml") as part:
        return list(cursor.read(part))


def _number_or_text(raw: str):
    """A whole number, another number, or the text itself."""
    try:
        return float(raw) if "." in raw or "e" in raw or "E" in raw else int(raw)
    except ValueError:
        return raw


def _place(reference: str) -> int | None:
    """The column of a cell name such as ``AB12``, counted from 0."""
    found = re.match("([A-Z]+)[0-9]", reference)
    if found is None:
        return None
    number = 0
    for letter in found[1]:
        number = 26 * number + ord(letter) - 64
    return number - 1


@lru_cache(maxsize=1024)
def _column(letters: str) -> int | None:
    return _place(letters + "1") if letters.isascii() and letters.isalpha() and letters.isupper() else None


class _SheetCursor(_Cursor):
    """Rows of a sheet as lists of cell values; its few handlers run for every cell, so they are plain functions."""

    def __init__(self, shared: list[str]):
        super().__init__({})
        row_tag, cell_tag, value_tag, run_tag = (f"{_SHEET_NS} {tag}" for tag in ("row", "c", "v", "t"))
        parser, done, text = self._parser, self.done, []
        cells, place, kind, raw, runs = [], None, None, "", []

        def start(tag, attributes):
            nonlocal cells, place, kind, raw, runs
            if tag == cell_tag:
                name = attributes.get("r", "")
                letters = name.rstrip("0123456789")
                place = _column(letters) if len(letters) < len(name) else None
                if place is None:
                    place = _place(name)
                kind, raw, runs = attributes.get("t"), "", []
            elif tag == value_tag or tag == run_tag:
                text.clear()
                parser.CharacterDataHandler = text.append
            elif tag == row_tag:
                cells = []

        def end(tag):
            nonlocal raw
            if tag == cell_tag:
                if place is not None:
                    if place >= len(cells):
                        cells.extend([None] * (place + 1 - len(cells)))
                    cells[place] = "".join(runs) if kind == "inlineStr" else _converted(kind, raw, shared)
            elif tag == value_tag:
                raw = "".join(text)
                parser.CharacterDataHandler = None
            elif tag == run_tag:
                runs.append("".join(text))
                parser.CharacterDataHandler = None
            elif tag == row_tag:
                done.append(cells)

        parser.StartElementHandler, parser.EndElementHandler = start, end
        parser.CharacterDataHandler = None


def _converted(kind: str | None, raw: str, shared: list[str]):
    """The value of a cell of any kind but inline text."""
    if not raw:
        return None
    if kind == "b":
        return raw == "1"
    if kind == "s":
        return shared[int(raw)] if raw.isdigit() and int(raw) < len(shared) else raw
    return _number_or_text(raw)


def sheet_rows(content: bytes, sheet: str) -> Iterator[list]:
    """The rows of one sheet as lists of cell values; beside the texts the sheet shares, a chunk is held."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        path, shared = _sheet_path(book, sheet), _shared_strings(book)
        with book.open(path) as part:
            yield from _SheetCursor(shared).read(part)


def _text(value) -> str | None:
    return value if value is None else str(value)


def _number_text(value) -> str | None:
    return _text(int(value) if isinstance(value, bool) else value)


def _horizon_text(value) -> str | None:
    # a numeric horizon cell counts as its whole year
    return _text(int(value) if isinstance(value, (bool, float)) else value)


def _header(rows: Iterator[list]) -> list[str]:
    header = next(rows, None)
    if header is None:
        raise ValueError(f"sheet {OUTPUT_SHEET} is empty")
    return ["" if name is None else str(name) for name in header]


def _records(content: bytes, kind: str, mixed: bool) -> tuple[list[str], Iterator[list]]:
    """Header and rows of a returned workbook, without rows that are blank all over."""
    rows = sheet_rows(content, OUTPUT_SHEET)
    header = _header(rows)
    found = "physical" if "hazard" in header else "transition" if "subrisk" in header else None
    if found is None:
        raise ValueError("kind_unknown: neither a hazard nor a subrisk column")
    if found != kind:
        if mixed:
            return header, iter(())
        raise ValueError(f"wrong_kind: {found} where {kind} was asked for")
    missing = sorted(set(KINDS[kind][2]) - set(header))
    if missing:
        raise ValueError(f"missing_columns: {', '.join(missing)}")
    kept = (row[: len(header)] for row in rows)
    return header, (row for row in kept if any(v is not None and v != "" for v in row))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def returns_decoder(kind: str, mixed: bool = False):
    """A ``mapInArrow`` function from ``path, content`` to text rows of one kind of result."""
    texts, numbers, _ = KINDS[kind]
    names = texts + numbers
    schema = pa.schema(
        [("source_file", pa.string()), ("seq", pa.int64()), ("_corrupt", pa.string())]
        + [(name, pa.string()) for name in names]
        + [("extra", pa.map_(pa.string(), pa.string()))]
    )

    converters = {**dict.fromkeys(texts, _text), **dict.fromkeys(numbers, _number_text), "timeHorizon": _horizon_text}

    def texts_of(values: list, convert) -> pa.Array:
        # a column of texts and blanks, as most are, needs no conversion
        if convert is not _number_text and all(type(value) is str or value is None for value in values):
            return pa.array(values, pa.string())
        return pa.array([convert(value) for value in values], pa.string())

    def batch(path: str, places: dict[str, int], first: int, rows: list[list]) -> pa.RecordBatch:
        n, width = len(rows), max(map(len, rows))
        columns = list(zip(*(row if len(row) == width else row + [None] * (width - len(row)) for row in rows)))

        def column(name, convert):
            i = places.get(name)
            return pa.nulls(n, pa.string()) if i is None or i >= width else texts_of(columns[i], convert)

        others = [(name, i) for name, i in places.items() if name not in converters]
        extra = [[(name, _text(row[i])) for name, i in others if i < len(row)] for row in rows]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([path] * n, pa.string()),
                pa.array(range(first, first + n), pa.int64()),
                pa.nulls(n, pa.string()),
                *(column(name, converters[name]) for name in names),
                pa.array(extra, pa.map_(pa.string(), pa.string())),
            ],
            schema=schema,
        )

    def one_file(path: str, content: bytes) -> Iterator[pa.RecordBatch]:
        try:
            header, rows = _records(content, kind, mixed)
            # of two headers with one name the later column counts
            places = {name: i for i, name in enumerate(header)}
            first = 0
            while some := list(itertools.islice(rows, BATCH_ROWS)):
                yield batch(path, places, first, some)
                first += len(some)
        except UNREADABLE as error:
            blank = {name: [None] for name in names}
            yield pa.RecordBatch.from_pydict(
                {"source_file": [path], "seq": [None], "_corrupt": [str(error)], **blank, "extra": [None]}, schema
            )

    def decode(batches):
        for files in batches:
            for path, content in zip(files.column("path"), files.column("content"), strict=True):
                yield from one_file(path.as_py(), content.as_py())

    ddl = ["source_file string", "seq bigint", "_corrupt string"]
    ddl += [f"`{name}` string" for name in names] + ["extra map<string,string>"]
    return decode, ", ".join(ddl)


def decode_returns(files: DataFrame, kind: str, mixed: bool = False) -> DataFrame:
    """Rows of workbook files given as ``path, content``; numbers as double."""
    decode, ddl = returns_decoder(kind, mixed)
    rows = files.mapInArrow(decode, ddl)
    return rows.withColumns({name: parse_float(name) for name in KINDS[kind][1]})


def read_returns(spark: SparkSession, path: str, kind: str, mixed: bool = False) -> DataFrame:
    """All rows of one kind from a folder of returned workbooks.

    ``seq`` counts the rows inside a file, so order over many files is
    ``("source_file", "seq")``. A file that cannot be read, is of the other kind or lacks
    required columns gives one row with the reason in ``_corrupt`` (see ``failures`` and
    ``readable``), behind the rows before the damage if its sheet breaks off; columns the schema does not know are kept in ``extra``.
    In a ``mixed`` folder files of the other kind, told by their header, are skipped.
    """
    return decode_returns(_files(spark, path), kind, mixed)


def failures(rows: DataFrame) -> DataFrame:
    """The files that cannot be used, as ``source_file, code, detail``."""
    return unusable_files(rows)


def readable(rows: DataFrame) -> DataFrame:
    """The rows without ``_corrupt``; a job over them fails on the first file that cannot be used.

    Look at ``failures`` for all of them before.
    """
    reason = F.concat_ws(": ", F.lit("workbook cannot be used"), "source_file", "_corrupt")
    good = F.when(F.col("_corrupt").isNull(), True).otherwise(F.raise_error(reason).cast("boolean"))
    return rows.where(good).drop("_corrupt")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per workbook: its header, the kind it tells, or why it cannot be read."""

    def decode(batches):
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                header, error = None, None
                try:
                    header = _header(sheet_rows(content.as_py(), OUTPUT_SHEET))
                except UNREADABLE as problem:
                    error = str(problem)
                yield pa.RecordBatch.from_pydict(
                    {"source_file": [name.as_py()], "columns": [header], "error": [error]},
                    pa.schema(
                        [("source_file", pa.string()), ("columns", pa.list_(pa.string())), ("error", pa.string())]
                    ),
                )

    headers = _files(spark, path).mapInArrow(decode, "source_file string, columns array<string>, error string")
    return headers.withColumn("kind", kind_column(F.col("columns")))


def read_sheet(spark: SparkSession, path: str, sheet: str, needed: bool = True) -> DataFrame:
    """Any sheet as ``source_file, row_no, cells, error``, rows counted from 1.

    A file without the sheet stops the job, or gives one row with the reason in
    ``error`` where the sheet is not ``needed``.
    """
    ddl = "source_file string, row_no bigint, cells array<string>, error string"
    kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.string()]

    def rows(name: str, content: bytes):
        try:
            for n, row in enumerate(sheet_rows(content, sheet), 1):
                yield name, n, [_text(v) for v in row], None
        except UNREADABLE as problem:
            if needed:
                raise
            yield name, None, None, str(problem)

    def decode(batches):
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                found = rows(name.as_py(), content.as_py())
                while some := list(itertools.islice(found, BATCH_ROWS)):
                    arrays = [pa.array(column, kind) for column, kind in zip(zip(*some), kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["source_file", "row_no", "cells", "error"])

    return _files(spark, path).mapInArrow(decode, ddl)


def read_readme(spark: SparkSession, path: str) -> DataFrame:
    """The asset name each workbook's ReadMe sheet states, or why there is none; for a warning only."""
    cells = F.col("cells")
    return (
        read_sheet(spark, path, README_SHEET, needed=False)
        .where((F.get(cells, 0) == "assetName") | F.col("error").isNotNull())
        .select("source_file", F.get(cells, 1).alias("readme_asset_name"), "error")
    )
