"""Workbooks of the xlsx format as a Spark source: a partition a sheet, rows streamed from the zipped XML.

Spark's reader of columns takes a schema: spark.read.format("workbook").schema(...).load(path). Options: sheet (one name; all sheets without it) and
header (default true: the first row with a value names the columns). Paths may be files or folders, in any file system that pyarrow
opens from executors; several are separated by commas. The schema's columns are found by name, or by place without a header; a column that a sheet
lacks is null. Columns named source_file and source_sheet, if the schema has them, tell where a row comes from.

Cells: numbers, texts (shared, in line, or a formula's), booleans, and dates as day numbers, which become dates or timestamps where the schema has these. A value that
doesn't fit its column's type is null, as are errors and blanks; rows without any value are left out. The texts that a workbook's sheets share are held by each task that reads a sheet.
"""

from __future__ import annotations

import datetime as dt
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from typing import Any
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, DataType, DateType, DecimalType, IntegralType, NumericType, StringType, StructType, TimestampNTZType, TimestampType

#: Fixed values of the format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_EPOCH = dt.datetime(1899, 12, 30)  # day 0, so that days from March 1900 on are right
_LETTERS = re.compile(r"[A-Z]+")


@dataclass
class Sheet(InputPartition):
    path: str
    member: str
    name: str


def _files(path: str) -> list[str]:
    """The workbooks of a comma-separated list of files and folders, in order."""
    from pyarrow import fs

    found = []
    for one in filter(None, (p.strip() for p in path.split(","))):
        system, inner = fs.FileSystem.from_uri(one) if "://" in one or one.startswith("file:") else (fs.LocalFileSystem(), one)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(one)
        if info.type == fs.FileType.File:
            found.append(one)
            continue
        inside = (i for i in system.get_file_info(fs.FileSelector(inner)) if i.type == fs.FileType.File)
        found += sorted(f"{one.rstrip('/')}/{i.base_name}" for i in inside if i.base_name.endswith(".xlsx") and not i.base_name.startswith(("~", ".", "_")))
    return found


def _opened(path: str) -> zipfile.ZipFile:
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return zipfile.ZipFile(system.open_input_file(inner))


def sheets(path: str) -> list[Sheet]:
    """The sheets of one workbook in its order."""
    with _opened(path) as book:
        relations = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in relations}
        names = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
        return [Sheet(path, posixpath.normpath(posixpath.join("xl", targets[s.get(_RELATION)])).lstrip("/") if not targets[s.get(_RELATION)].startswith("/") else targets[s.get(_RELATION)][1:], s.get("name")) for s in names]


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, item in ElementTree.iterparse(stream):
            if item.tag == f"{_MAIN}si":
                out.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
                item.clear()
    return out


def place(reference: str) -> int:
    """The column's number from 0 on of a cell such as AB12."""
    n = 0
    for letter in _LETTERS.match(reference)[0]:
        n = 26 * n + ord(letter) - 64
    return n - 1


def cells(book: zipfile.ZipFile, member: str) -> Iterator[dict[int, tuple[str, str]]]:
    """Rows as {column: (kind, text)}, kind one of n, s, b; blanks and errors have no entry. One row is held at a time."""
    shared = _shared(book)
    with book.open(member) as stream:
        parsed = ElementTree.iterparse(stream, ("start", "end"))
        _, root = next(parsed)
        for event, row in parsed:
            if event != "end" or row.tag != f"{_MAIN}row":
                continue
            out, following = {}, 0
            for cell in row.iter(f"{_MAIN}c"):
                column = place(cell.get("r")) if cell.get("r") else following
                following = column + 1
                kind, value = cell.get("t", "n"), cell.findtext(f"{_MAIN}v")
                if kind == "inlineStr":
                    kind, value = "s", "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                elif kind == "s" and value is not None:
                    value = shared[int(value)]
                elif kind in ("str", "d"):
                    kind = "s"
                if kind in ("n", "s", "b") and value not in (None, ""):
                    out[column] = kind, value
            yield out
            row.clear()
            for done in list(root.iter(f"{_MAIN}sheetData")):
                done.clear()


def _number(kind: str, value: str) -> float | None:
    try:
        return float(value)
    except ValueError:
        return None


def _moment(kind: str, value: str) -> dt.datetime | None:
    try:
        return _EPOCH + dt.timedelta(days=float(value)) if kind == "n" else dt.datetime.fromisoformat(value.strip())
    except (ValueError, OverflowError):
        return None


def _text(kind: str, value: str) -> str:
    if kind == "b":
        return "true" if value == "1" else "false"
    return value[:-2] if kind == "n" and value.endswith(".0") else value


def converter(kind: DataType) -> Callable[[str, str], Any]:
    """Turns (cell kind, text) into a value of a Spark type, or None."""
    if isinstance(kind, StringType):
        return _text
    if isinstance(kind, BooleanType):
        return lambda k, v: {"1": True, "0": False, "true": True, "false": False}.get(v.strip().lower())
    if isinstance(kind, DateType):
        return lambda k, v: None if (m := _moment(k, v)) is None else m.date()
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return _moment
    if isinstance(kind, IntegralType):
        return lambda k, v: None if (n := _number(k, v)) is None or n != n or n != int(n) else int(n)
    if isinstance(kind, DecimalType):
        return lambda k, v: None if _number(k, v) is None else Decimal(v.strip())
    if isinstance(kind, NumericType):
        return _number
    raise ValueError(f"workbooks have no {kind.simpleString()} cells")


class WorkbookReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        if not options.get("path"):
            raise ValueError("a workbook needs a path")
        self.schema, self.path, self.sheet = schema, options["path"], options.get("sheet")
        self.header = options.get("header", "true").lower() == "true"

    def partitions(self) -> list[Sheet]:
        found = [s for path in _files(self.path) for s in sheets(path) if self.sheet in (None, s.name)]
        if not found:
            raise ValueError(f"no sheet {self.sheet or ''} in {self.path}")
        return found

    def read(self, partition: Sheet) -> Iterator[tuple]:
        made = [converter(f.dataType) for f in self.schema.fields]
        known = {"source_file": posixpath.basename(partition.path), "source_sheet": partition.name}
        places = None if self.header else {f.name: k for k, f in enumerate(f for f in self.schema.fields if f.name not in known)}
        with _opened(partition.path) as book:
            for row in cells(book, partition.member):
                if not row:
                    continue
                if places is None:
                    places = {}
                    for column, cell in row.items():
                        places.setdefault(_text(*cell).strip(), column)
                    continue
                out = []
                for field, make in zip(self.schema.fields, made):
                    cell = row.get(places.get(field.name, -1))
                    out.append(known[field.name] if field.name in known else make(*cell) if cell else None)
                yield tuple(out)


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def reader(self, schema: StructType) -> WorkbookReader:
        return WorkbookReader(schema, dict(self.options))


def read_workbooks(spark: SparkSession, path: str, schema: StructType | str, sheet: str | None = None) -> DataFrame:
    """The rows of all workbooks of a path, a partition a sheet."""
    spark.dataSource.register(WorkbookSource)
    reader = spark.read.format("workbook").schema(schema)
    return (reader.option("sheet", sheet) if sheet else reader).load(path)
