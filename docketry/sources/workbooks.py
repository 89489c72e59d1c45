"""Workbooks (.xlsx) as tables: a data source of their rows."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as X
from ..functions import vocab as V
from . import readers

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
SCHEMA = "path string, sheet string, row int, cells array<string>"


def _text(item) -> str:
    """The words of a string item: its runs together, phonetic marks left out."""
    return "".join(t.text or "" for child in item for t in ([child] if child.tag == f"{_MAIN}t" else child.findall(f"{_MAIN}t") if child.tag == f"{_MAIN}r" else []))


def _column(ref: str) -> int:
    k = 0
    for c in re.match("[A-Z]+", ref.upper())[0]:
        k = 26 * k + ord(c) - 64
    return k - 1


def sheet_rows(book: bytes, sheet: str | None = None) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row, cells) of a workbook: cells stand where their reference says, empty ones are null, formulas give their last value.

    Rows are taken one at a time; only shared strings are held.
    """
    with zipfile.ZipFile(io.BytesIO(book)) as z:
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = [_text(item) for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{_MAIN}si")]
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            if sheet not in (None, s.get("name")):
                continue
            target = targets[s.get(f"{_REL}id")]
            part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            at = 0
            with z.open(part) as f:
                for _, row in ElementTree.iterparse(f):
                    if row.tag != f"{_MAIN}row":
                        continue
                    at = int(row.get("r") or at + 1)
                    cells: list[str | None] = []
                    for c in row.findall(f"{_MAIN}c"):
                        k = _column(c.get("r")) if c.get("r") else len(cells)
                        cells += [None] * (k + 1 - len(cells))
                        value, inline = c.find(f"{_MAIN}v"), c.find(f"{_MAIN}is")
                        if c.get("t") == "inlineStr":
                            cells[k] = _text(inline) if inline is not None else None
                        elif value is not None and value.text is not None:
                            cells[k] = shared[int(value.text)] if c.get("t") == "s" else value.text
                    yield s.get("name"), at, cells
                    row.clear()


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths, self.sheet = options["path"].split(","), options.get("sheet")

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, partition):
        for sheet, row, cells in sheet_rows(readers.read_bytes(partition.path), self.sheet):
            yield partition.path, sheet, row, cells


class Workbooks(DataSource):
    """`workbook`: rows of one or more .xlsx files (option path, separated by commas), of one sheet or all (option sheet)."""

    @classmethod
    def name(cls):
        return "workbook"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(path, sheet, row, cells) of a workbook, a task a file."""
    spark.dataSource.register(Workbooks)
    reader = spark.read.format("workbook").option("path", path)
    return (reader.option("sheet", sheet) if sheet else reader).load()


def read_descriptions(spark: SparkSession, path: str, mapping: dict[int, str | None], sheet: str = "Sheet1", reported=V.REPORTED) -> DataFrame:
    """(param_id, description) of a sheet of (number, item, description).

    mapping: the parameter of each number, None for one that is left out on purpose. A number
    that mapping lacks, or a parameter that is not reported, is an error: a wrong id would
    describe a whole sheet of the register wrongly.
    """
    wrong = sorted({p for p in mapping.values() if p is not None} - set(reported))
    if wrong:
        raise ValueError(f"unknown parameters in the mapping: {wrong}")
    rows = read_workbook(spark, path, sheet).select(F.get("cells", 0).alias("number"), F.get("cells", 1).alias("item"), F.get("cells", 2).alias("text"))
    n = X.strip("number")
    numbers = [r["n"] for r in rows.where(n.rlike(r"^[+-]?\d{1,9}$")).select(n.cast("int").alias("n")).distinct().limit(1000).collect()]  # numbers of a vocabulary
    unmapped = sorted(set(numbers) - set(mapping))
    if unmapped:
        raise ValueError(f"numbers without a parameter: {unmapped}")
    return readers.descriptions(rows, {k: p for k, p in mapping.items() if p is not None})
