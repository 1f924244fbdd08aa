"""Licence notices that are wrapped over several lines."""

import textwrap

import pytest

from quillon.llm import licenses

NOTICES = {
    "MIT": licenses.TEMPLATES["MIT"][3] + ", including without limitation the rights to use, copy, modify, merge, publish and distribute copies of the Software.",
    "GPL-3.0": licenses.TEMPLATES["GPL-3.0"][1],
    "LGPL": licenses.TEMPLATES["LGPL"][0],
    "BSD": licenses.TEMPLATES["BSD"][0] + ":",
}


def test_wrapped_notices(spark):
    texts, want = [], []
    for family, notice in NOTICES.items():
        for width in (60, 70, 76, 80):
            lines = textwrap.wrap(notice, width)
            for body in ("\n".join(lines), "/*\n" + "\n".join(f" * {x}" for x in lines) + "\n */", "\n".join(f"# {x}" for x in lines), "\r\n".join(f"// {x}" for x in lines)):
                texts.append(f"Some story about a river.\n\n{body}\n\nint main(void);\n")
                want.append(family)
    got = licenses.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r.doc_id: (r.licenses, r.n_license_paragraphs) for r in got}
    assert [found[i] for i in range(len(texts))] == [(f, 1) for f in want]


@pytest.mark.parametrize("text", ["The driver showed his\nlicense to the officer\nat the gate.", "A story of permission\nand of copyright\nthat grants nothing."])
def test_wrapped_prose_names_no_family(spark, text):
    (row,) = licenses.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.license in (None, "unknown")


def test_a_line_beside_a_known_one_is_judged_by_itself(spark):
    text = "Released under the MIT License.\nLicensed under the Flying Teapot Licence of 1907, see the attic."
    (row,) = licenses.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.licenses in ("MIT", "MIT,unknown") and row.n_license_paragraphs == len(row.licenses.split(","))
