"""Spreadsheets (.xlsx) read on the executors: files come by Spark's binary source, so from any store it reads, and a task has a range of a sheet's rows.

A workbook is a zip of XML parts. Its sheets' sizes are looked at first (one row a sheet), then each range of `rows_per_task` rows is a row of its own, dealt
over the cluster; the task that gets it reads the sheet's part as a stream up to the range's end. Cells are texts as the file has them: numbers as
written there, true and false, dates as their numbers. Old binary files (.xls) are not read.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import ship, small

ROWS_PER_TASK = 50_000
# fixed values of the format
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _sheets(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, part) of each sheet, in order."""
    targets = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    out = []
    for s in book.iter(f"{_MAIN}sheet"):
        t = targets[s.get(f"{_REL}id")]
        out.append((s.get("name", ""), t.lstrip("/") if t.startswith("/") else f"xl/{t}"))
    return out


def _said(node: ElementTree.Element) -> str:
    """A text with its runs, without phonetic hints."""
    return "".join(t.text or "" for part in ([node] if node.find(f"{_MAIN}t") is not None else node.findall(f"{_MAIN}r")) for t in part.findall(f"{_MAIN}t"))


def _shared(z: zipfile.ZipFile) -> list[str]:
    """The texts that cells refer to by number."""
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    with z.open("xl/sharedStrings.xml") as f:
        for _, node in ElementTree.iterparse(f):
            if node.tag == f"{_MAIN}si":
                out.append(_said(node))
                node.clear()
    return out


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]*", ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def _rows(z: zipfile.ZipFile, part: str, shared: list[str], begin: int, end: int) -> Iterator[tuple[int, list[str | None]]]:
    """(number from 0, cells) of a sheet's rows from begin up to end; rows and cells that the file leaves out are not there, or null."""
    number = -1
    with z.open(part) as f:
        for _, row in ElementTree.iterparse(f):
            if row.tag != f"{_MAIN}row":
                continue
            number = int(row.get("r", number + 2)) - 1
            if number >= end:
                return
            if number >= begin:
                cells: list[str | None] = []
                for c in row.findall(f"{_MAIN}c"):
                    at = _column(c.get("r", "")) if c.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    kind, v = c.get("t", "n"), c.find(f"{_MAIN}v")
                    if kind == "inlineStr" and c.find(f"{_MAIN}is") is not None:
                        cells[at] = _said(c.find(f"{_MAIN}is"))
                    elif v is not None and v.text is not None:
                        cells[at] = shared[int(v.text)] if kind == "s" else ("true" if v.text == "1" else "false") if kind == "b" else v.text
                yield number, cells
            row.clear()


def _looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, sheet, ord, n (its rows), header (its first row's cells) of each sheet of files (path, content)."""
    for b in batches:
        out: list[list] = [[], [], [], [], []]
        for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            z = zipfile.ZipFile(io.BytesIO(raw))
            shared = _shared(z)
            for k, (name, part) in enumerate(_sheets(z)):
                n, header = 0, []
                for number, cells in _rows(z, part, shared, 0, 1 << 40):
                    n, header = number + 1, cells if number == 0 else header
                for c, v in zip(out, (path, name, k, n, header), strict=True):
                    c.append(v)
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["path", "sheet", "ord", "n", "header"])


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, sheet, row, cells of ranges (path, sheet, begin, end, content)."""
    for b in batches:
        for path, sheet, begin, end, raw in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
            z = zipfile.ZipFile(io.BytesIO(raw))
            held: list[tuple[int, list[str | None]]] = []
            found = _rows(z, dict(_sheets(z))[sheet], _shared(z), begin, end)
            while True:
                held = [x for _, x in zip(range(1000), found, strict=False)]
                if not held:
                    break
                n = len(held)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([sheet] * n), pa.array([k for k, _ in held], pa.int64()), pa.array([c for _, c in held], pa.list_(pa.string()))], names=["path", "sheet", "row", "cells"])


def sheets(spark: SparkSession, path: str) -> DataFrame:
    """path, sheet, ord, n (rows), header of every sheet of the workbooks at path."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_looked, "path string, sheet string, ord int, n long, header array<string>")


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows below the header of one sheet (the first, if none is named) of a workbook, all columns as texts, in the order of no row but with
    nothing left out: rows without any cell are not there. A header cell that is empty or occurs before gets its column's number."""
    found = sheets(spark, path).filter(F.col("ord") == 0 if sheet is None else F.col("sheet") == sheet).collect()  # one row for each workbook at path
    if not found:
        raise ValueError(f"{path} has no sheet {sheet}")
    names: list[str] = []
    for k, h in enumerate(found[0]["header"]):
        names.append(h if h and h not in names else f"{h or 'column'}_{k + 1}")
    tasks = [(r["path"], r["sheet"], a, min(a + rows_per_task, r["n"])) for r in found for a in range(1, r["n"], rows_per_task)]
    empty = ", ".join(f"`{n}` string" for n in names)
    if not tasks or not names:
        return spark.createDataFrame([], empty or "column_1 string")
    ranges = spark.createDataFrame(tasks, "path string, sheet string, begin long, end long")  # a few for each workbook
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = files.join(small(ranges), "path").select("path", "sheet", "begin", "end", "content").repartition(len(tasks))
    cells = rows.mapInArrow(_ranges, "path string, sheet string, row long, cells array<string>")
    return cells.select(*[F.get("cells", F.lit(k)).alias(n) for k, n in enumerate(names)])
