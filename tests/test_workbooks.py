"""Workbooks as other programs write them, and round trips."""

import io
import zipfile

import pytest

from quillon.sources import workbooks

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(sheet_xml, shared="", styles=""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets><sheet name="First" sheetId="1" r:id="a"/><sheet name="Second" sheetId="2" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="b" Target="/xl/worksheets/x.xml"/><Relationship Id="a" Target="worksheets/y.xml"/></Relationships>')
        z.writestr("xl/worksheets/x.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{sheet_xml}</sheetData></worksheet>')
        z.writestr("xl/worksheets/y.xml", f'<worksheet xmlns="{MAIN}"><sheetData/></worksheet>')
        if shared:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{shared}</sst>')
        if styles:
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>')
    return out.getvalue()


def test_kinds_of_cells():
    styles = '<numFmts><numFmt numFmtId="170" formatCode="dd/mm/yyyy &quot;y&quot;"/><numFmt numFmtId="171" formatCode="0.00 &quot;days&quot;"/></numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
    shared = "<si><t>plain</t></si><si><r><t>rich </t></r><r><t>text</t></r><rPh><t>no</t></rPh></si>"
    rows = (
        '<row r="2"><c r="B2" t="s"><v>1</v></c><c r="AA2" t="inlineStr"><is><t>in &amp; line</t></is></c></row><row r="3"/><row r="4"><c r="A4" s="1"><v>45292</v></c><c r="B4" s="2"><v>45292.5</v></c><c r="C4" s="3"><v>2.50</v></c>'
        '<c r="D4" t="b"><v>1</v></c><c r="E4" t="e"><v>#N/A</v></c><c r="F4" t="str"><f>A1</f><v>007</v></c><c r="G4"><v>1E3</v></c></row><row><c t="s"><v>0</v></c><c><v>3</v></c></row>'
    )
    got = list(workbooks.rows_of(book(rows, shared, styles), "Second"))
    assert got == [(2, {1: "rich text", 26: "in & line"}), (4, {0: "2024-01-01", 1: "2024-01-01 12:00:00", 2: "2.5", 3: "true", 5: "007", 6: "1000"}), (5, {0: "plain", 1: "3"})]
    assert list(workbooks.rows_of(book(rows, shared), 0)) == []
    with pytest.raises(ValueError, match="Third"):
        list(workbooks.rows_of(book(rows, shared), "Third"))


def test_round_trip(spark, tmp_path):
    data = [["Name", "Code", "N"], ["São  <x>", "0101", 7], [None, "", 2.5], [], ["b", "0000", None]]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.xlsx").write_bytes(workbooks.workbook(data))
    (tmp_path / "a" / "two.xlsx").write_bytes(workbooks.workbook([["t"], ["x"], *data]))
    (tmp_path / "a" / "notes.txt").write_text("no workbook")
    got = workbooks.read(spark, str(tmp_path / "a" / "one.xlsx"), "Code string, N double, Lost int", with_path=True).orderBy("row").collect()
    assert [tuple(r)[1:] for r in got] == [(2, "0101", 7.0, None), (3, None, 2.5, None), (5, "0000", None, None)]
    assert sorted(r.N for r in workbooks.read(spark, str(tmp_path / "a" / "two.xlsx"), "N int", skip=2).collect() if r.N is not None) == [7]
    by_place = workbooks.read(spark, str(tmp_path / "a"), "a string, b string", header=False)
    assert by_place.count() == 4 + 6 and by_place.filter("b = '0101'").count() == 2
