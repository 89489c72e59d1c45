"""Workbooks written by executors and read back, and the verbatim check."""

from __future__ import annotations

import zipfile

import pytest

from docketry.operators import checks, register
from docketry.sources import sinks, workbooks


def test_a_register_goes_through_a_workbook_and_back(spark, tmp_path):
    rows = [(f"c{k:03}", "A1" if k % 3 else "B6", f"Mills & <Co> {k}", f"line one\nline  two {k} \x07 ü €", "No reply", "" if k % 2 else None) for k in range(40)]
    r = spark.createDataFrame(rows, "case_id string, param_id string, trade_name string, notice string, reply string, finding string").repartition(5)
    path = f"{tmp_path}/r.xlsx"
    sinks.register_workbook(r, register.contents(r, register.param_dim(spark)), path)
    got = workbooks.read_workbook(spark, path).collect()
    assert not (tmp_path / "r.xlsx.parts").exists() and len({x["sheet"] for x in got}) == 22
    body = [x for x in got if x["sheet"].startswith("01 ") and x["row"] > 1]
    want = sorted(x for x in rows if x[1] == "A1")
    assert [x["row"] for x in body] == list(range(2, len(want) + 2))
    assert [x["cells"] for x in body] == [[w[0], w[2], w[3].replace("\x07", ""), w[4], w[5] or ""] for w in want]
    front = [x["cells"] for x in workbooks.read_workbook(spark, path, "Contents").collect()]
    assert front[0][:2] == ["Sheet", "Parameter"] and front[1][2] == str(len(want)) and front[-1][1] == "Total"
    sinks.register_workbook(r, register.contents(r, register.param_dim(spark)), path, notice_only=True, parts=f"{tmp_path}/shared")
    assert [x["cells"] for x in workbooks.read_workbook(spark, path).where("sheet like '01 %' and row = 2").collect()] == [[want[0][0], want[0][2], want[0][3].replace("\x07", "")]]
    assert b'ht="' in zipfile.ZipFile(path).read("xl/worksheets/sheet2.xml") and list((tmp_path / "shared").iterdir()) == []


SHARED = """<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>S.no</t></si><si><r><t>Two </t></r><r><t>runs</t></r><rPh><t>x</t></rPh></si></sst>"""
SHEET = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row>
<row r="3"><c r="A3"><v>1</v></c><c r="C3" t="s"><v>1</v></c><c r="AB3" t="str"><f>1</f><v>far</v></c></row><row><c><v>16</v></c><c t="inlineStr"><is><t>in</t></is></c><c/></row></sheetData></worksheet>"""


def book(path, sheet=SHEET):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Sheet1" sheetId="1" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="a" Target="/xl/worksheets/one.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", SHARED)
        z.writestr("xl/worksheets/one.xml", sheet)


def test_cells_stand_where_their_reference_says(spark, tmp_path):
    book(tmp_path / "b.xlsx")
    got = [tuple(r)[1:] for r in workbooks.read_workbook(spark, f"{tmp_path}/b.xlsx").collect()]
    assert got == [("Sheet1", 1, ["S.no"]), ("Sheet1", 3, ["1", None, "Two runs"] + [None] * 24 + ["far"]), ("Sheet1", 4, ["16", "in", None])]


def test_descriptions_need_a_whole_mapping(spark, tmp_path):
    book(tmp_path / "b.xlsx")
    path = f"{tmp_path}/b.xlsx"
    assert [tuple(r) for r in workbooks.read_descriptions(spark, path, {1: "A1", 16: None}).collect()] == [("A1", "Two runs")]
    with pytest.raises(ValueError, match=r"numbers without a parameter: \[16\]"):
        workbooks.read_descriptions(spark, path, {1: "A1"})
    with pytest.raises(ValueError, match=r"unknown parameters in the mapping: \['Q9'\]"):
        workbooks.read_descriptions(spark, path, {1: "Q9", 16: None})


def test_sections_are_looked_for_among_their_lines_and_then_everywhere(spark):
    docs = spark.createDataFrame([("c", "one\ntwo  words\nthree\n"), ("d", ""), ("e", None)], "case_id string, text string")
    rows = [("c", "in place", "two words\nthree", 2, 3), ("c", "moved", "three", 1, 1), ("c", "absent", "four", 1, 3), ("c", "beyond", "one", 0, 99), ("c", "backwards", "zzz", 3, 1), ("d", "empty", "", 1, 1), ("d", "gone", "x", 1, 1)]
    s = spark.createDataFrame(rows, "case_id string, param_id string, text string, start_line int, end_line int")
    assert sorted(r["param_id"] for r in checks.unprinted(s, docs).collect()) == ["absent", "backwards", "gone"]
