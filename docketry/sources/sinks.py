"""Sinks: tables that are merged, never overwritten, and the workbook."""

from __future__ import annotations

import json
import time
import zipfile
from collections.abc import Iterable
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators.resolve import upsert
from . import ledger


#: Parts of a merged table, by a hash of its keys; a table keeps the number that it began with.
PARTS = 64
_PART = "__part"


def _manifest(spark, path: str) -> tuple[int, dict]:
    """(version, record) of the latest manifest: which folder holds each part. (-1, {}) before the first."""
    found = ledger.records(spark, f"{path}/manifest")
    return len(found) - 1, found[-1] if found else {}


def _read(spark, path: str, record: dict, parts=None) -> DataFrame:
    """Rows of some parts of a table, or of all."""
    folders = [f"{path}/{f}" for k, f in sorted(record["held"].items()) if parts is None or k in parts]
    schema = T.StructType.fromJson(json.loads(record["schema"]))
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def merge_table(new: DataFrame, path: str, keys: list[str], parts: int = PARTS) -> DataFrame:
    """Upsert rows into the table under path, rewriting only the parts that they fall into; returns the table.

    New rows replace those with the same keys; others stay. Columns that either side lacks are
    null there. A version is a manifest that names a folder for each part, and is there at once
    or not at all: a run that dies leaves the last one whole. A writer that finds its version
    taken by another merges again on top of that one, so neither loses rows.
    """
    spark = new.sparkSession
    record = _manifest(spark, path)[1]
    parts = record.get("parts", parts)
    staged = f"{path}/staged/{ledger.stamp()}"
    new.withColumn(_PART, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(parts)).cast("int")).repartition(_PART).write.partitionBy(_PART).parquet(staged)
    touched = {n.partition("=")[2] for n in ledger.names(spark, staged) if n.startswith(f"{_PART}=")}
    rows = spark.read.schema(T.StructType([*new.schema.fields, T.StructField(_PART, T.IntegerType())])).parquet(staged) if touched else new.limit(0).withColumn(_PART, F.lit(0))
    try:
        while True:
            version, record = _manifest(spark, path)
            held = dict(record.get("held", {}))
            merged = rows
            if record:
                merged = upsert(_read(spark, path, record, touched), rows.drop(_PART), keys)
                merged = merged.withColumn(_PART, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(parts)).cast("int"))
            if record and not touched:
                break
            data = f"data/{ledger.stamp()}"
            merged.repartition(_PART).write.partitionBy(_PART).parquet(f"{path}/{data}")
            held |= {k: f"{data}/{_PART}={k}" for k in touched}
            if ledger.claim(spark, f"{path}/manifest", f"{version + 1:08d}.json", {"parts": parts, "held": held, "schema": merged.drop(_PART).schema.json()}):
                break
            ledger.remove(spark, f"{path}/{data}")
    finally:
        ledger.remove(spark, staged)
    return read_table(spark, path)


def read_table(spark, path: str) -> DataFrame:
    """The latest version of a merged table."""
    return _read(spark, path, _manifest(spark, path)[1])


def sweep_table(spark, path: str, lease: float = 86_400) -> list[str]:
    """Remove the folders that the latest version does not use and that are older than the lease in seconds, in which readers of older versions end."""
    used = {f.rpartition("/")[0] for f in _manifest(spark, path)[1].get("held", {}).values()}
    old = [f"data/{n}" for n in ledger.names(spark, f"{path}/data") if f"data/{n}" not in used and int(n.partition("-")[0]) / 1e9 < time.time() - lease]
    for f in old:
        ledger.remove(spark, f"{path}/{f}")
    return old


_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _column(k: int) -> str:
    name = ""
    while k >= 0:
        name, k = chr(65 + k % 26) + name, k // 26 - 1
    return name


def write_workbook(path: str, sheets: list[tuple[str, list[str], list[int], Iterable]]) -> None:
    """An .xlsx of (name, headers, widths, rows): rows are taken one at a time, so a sheet may be an iterator.

    A row is a list of cells, or such a list and the height of the row, or a piece of finished XML.
    """
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{k + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(len(sheets)))
        z.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{types}</Types>')
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>' + "".join(f'<sheet name="{escape(n[:31])}" sheetId="{k + 1}" r:id="s{k + 1}"/>' for k, (n, *_) in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="s{k + 1}" Type="{_REL}/worksheet" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(sheets))) + f'<Relationship Id="st" Type="{_REL}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'{_HEAD}<styleSheet xmlns="{_MAIN}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf><alignment vertical="top" wrapText="1"/></xf><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>')
        for k, (_, headers, widths, rows) in enumerate(sheets):
            with z.open(f"xl/worksheets/sheet{k + 1}.xml", "w") as f:
                cols = "".join(f'<col min="{c + 1}" max="{c + 1}" width="{w}" customWidth="1"/>' for c, w in enumerate(widths))
                f.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews><cols>{cols}</cols><sheetData>'.encode())
                f.write(_row(1, headers, 1))
                for r, row in enumerate(rows, 2):
                    f.write(row if isinstance(row, bytes) else _row(r, row, 0))
                f.write(b"</sheetData></worksheet>")


def _row(r: int, cells, style: int) -> bytes:
    cells, height = cells if isinstance(cells, tuple) else (cells, None)
    out = []
    for c, v in enumerate(cells):
        at = f'r="{_column(c)}{r}" s="{style}"'
        if isinstance(v, int | float) and not isinstance(v, bool):
            out.append(f"<c {at}><v>{v}</v></c>")
        else:
            out.append(f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape("" if v is None else str(v))}</t></is></c>')
    tall = "" if height is None else f' ht="{height}" customHeight="1"'
    return f'<row r="{r}"{tall}>{"".join(out)}</row>'.encode()


def register_workbook(register_: DataFrame, contents: DataFrame, path: str, notice_only: bool = False, parts: str | None = None) -> None:
    """The contents and a sheet for every parameter, also those that no case raised.

    Executors write the rows of each sheet as XML under parts (a shared folder; beside the
    workbook if none is given), the driver only puts these files into the archive.
    """
    from ..operators.register import sheet

    names = ["notice"] if notice_only else ["notice", "reply", "finding"]
    headers = ["GSTIN", "Trade name", "Notice (SCN) defect", "Taxpayer reply", "Officer finding"][: 2 + len(names)]
    widths = [20, 30, 95, 85, 80][: 2 + len(names)]
    index = contents.orderBy("position").collect()  # a row per parameter
    total = ["", "Total", *[sum(r[c] for r in index) for c in ("companies", "replies", "no_reply", "findings", "no_finding")]]
    front = ("Contents", ["Sheet", "Parameter", "Companies", "Replies", "No reply", "Findings", "No finding"], [30, 60, 12, 12, 12, 12, 12], [*[[r["sheet"], r["title"], r["companies"], r["replies"], r["no_reply"], r["findings"], r["no_finding"]] for r in index], total])
    pages = sheet(register_, notice_only).withColumn("height", X.row_height(names, widths[2:]))
    scratch = f"{parts or path + '.parts'}/{ledger.stamp()}"
    row_xml(pages, ["case_id", "trade_name", *names]).repartition("param_id").sortWithinPartitions("param_id", "r").select("param_id", "xml").write.partitionBy("param_id").text(scratch)

    def rows(pid):
        folder = f"{scratch}/param_id={pid}"
        for name in ledger.names(register_.sparkSession, folder):
            if not name.startswith(("_", ".")):
                yield from ledger.chunks(f"{folder}/{name}")

    try:
        write_workbook(path, [front, *[(r["sheet"], headers, widths, rows(r["param_id"])) for r in index]])
    finally:
        ledger.remove(register_.sparkSession, scratch if parts else f"{path}.parts")


def row_xml(pages: DataFrame, names: list[str]) -> DataFrame:
    """(param_id, r, xml) of the rows of sheets (param_id, case_id, ..., height): rows of a sheet count from 2, below its headers."""
    def cell(name: str, k: int):
        words = F.coalesce(F.col(name), F.lit(""))
        for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            words = F.replace(words, F.lit(sign), F.lit(entity))
        return F.concat(F.lit(f'<c r="{_column(k)}'), F.col("r").cast("string"), F.lit('" s="0" t="inlineStr"><is><t xml:space="preserve">'), words, F.lit("</t></is></c>"))

    numbered = pages.withColumn("r", F.row_number().over(Window.partitionBy("param_id").orderBy("case_id")) + 1)  # a sheet holds 1,048,576 rows at most
    head = F.concat(F.lit('<row r="'), F.col("r").cast("string"), F.lit('" ht="'), F.col("height").cast("string"), F.lit('" customHeight="1">'))
    return numbered.select("param_id", "r", F.concat(head, *[cell(n, k) for k, n in enumerate(names)], F.lit("</row>")).alias("xml"))
