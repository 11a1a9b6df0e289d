"""Workbooks written by hand, read back on executors."""

import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from textmill.sources import tables, workbook

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def letters(k):
    out = ""
    k += 1
    while k:
        k, d = divmod(k - 1, 26)
        out = chr(65 + d) + out
    return out


def write(path, sheets):
    """sheets: name to rows of cells; texts are shared, (text,) is written in its place, None is left out."""
    shared, parts = [], {}
    for n, rows in enumerate(sheets.values()):
        body = []
        for r, cells in enumerate(rows):
            if cells is None:
                continue
            xml = []
            for c, v in enumerate(cells):
                ref = f'r="{letters(c)}{r + 1}"'
                if v is None:
                    continue
                if isinstance(v, bool):
                    xml.append(f'<c {ref} t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, (int, float)):
                    xml.append(f"<c {ref}><v>{v}</v></c>")
                elif isinstance(v, tuple):
                    xml.append(f'<c {ref} t="inlineStr"><is><t>{escape(v[0])}</t></is></c>')
                else:
                    xml.append(f'<c {ref} t="s"><v>{len(shared)}</v></c>')
                    shared.append(v)
            body.append(f'<row r="{r + 1}">{"".join(xml)}</row>')
        parts[f"xl/worksheets/sheet{n + 1}.xml"] = f"<worksheet {MAIN}><sheetData>{''.join(body)}</sheetData></worksheet>"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts["xl/workbook.xml"] = f'<workbook {MAIN} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(s)}" sheetId="{k + 1}" r:id="r{k + 1}"/>' for k, s in enumerate(sheets)) + "</sheets></workbook>"
    parts["xl/_rels/workbook.xml.rels"] = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{k + 1}" Type="{rel}/worksheet" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(sheets))) + "</Relationships>"
    parts["xl/sharedStrings.xml"] = f"<sst {MAIN}>" + "".join(f"<si><r><t>{escape(t[:2])}</t></r><r><t xml:space='preserve'>{escape(t[2:])}</t></r><rPh><t>no</t></rPh></si>" if k % 2 else f"<si><t>{escape(t)}</t></si>" for k, t in enumerate(shared)) + "</sst>"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)


def test_a_workbook_by_ranges(spark, tmp_path):
    rows = [["id", "name", None, "name"], [1, "a & <b>", (" in place ",), True], None, [2.5, None, None, False], [None, "ünï"], *[[k, f"row {k}", ("x",), k % 2 == 0] for k in range(3, 1200)]]
    path = f"{tmp_path}/book.xlsx"
    write(path, {"First": rows, "Second & last": [["only"], ["v"]], "Empty": []})
    want = [("1", "a & <b>", " in place ", "true"), ("2.5", None, None, "false"), (None, "ünï", None, None), *[(str(k), f"row {k}", "x", "true" if k % 2 == 0 else "false") for k in range(3, 1200)]]
    for n in (7, 100, 50_000):
        got = workbook.read_workbook(spark, path, rows_per_task=n)
        assert got.columns == ["id", "name", "column_3", "name_4"] and sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert workbook.read_workbook(spark, path, rows_per_task=100).select(F.spark_partition_id()).distinct().count() > 3
    assert [tuple(r) for r in workbook.read_workbook(spark, path, "Second & last").collect()] == [("v",)]
    assert workbook.read_workbook(spark, path, "Empty").collect() == []
    with pytest.raises(ValueError):
        workbook.read_workbook(spark, path, "none")
    assert tables.read_table(spark, path).count() == len(want)
    assert [(r.sheet, r.n) for r in workbook.sheets(spark, path).orderBy("ord").collect()] == [("First", len(rows)), ("Second & last", 2), ("Empty", 0)]
