"""The workbook sink: its archive, its rows and their order, sheets beyond the limit."""

import re
import time
import zipfile
import zlib
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from docloom.sources import xlsx

NS = {"m": xlsx.MAIN}


def read(path):
    """Sheet name -> rows of (value, style) as a reader of the format sees them."""
    with zipfile.ZipFile(path) as book:
        assert book.testzip() is None
        names = [s.get("name") for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{{{xlsx.MAIN}}}sheet")]
        out = {}
        for k, name in enumerate(names, 1):
            sheet = ElementTree.fromstring(book.read(f"xl/worksheets/sheet{k}.xml"))
            cell = lambda c: (float(v.text) if (v := c.find("m:v", NS)) is not None else t.text or "" if (t := c.find("m:is/m:t", NS)) is not None else None, c.get("s"))
            out[name] = [[cell(c) for c in row] for row in sheet.iter(f"{{{xlsx.MAIN}}}row")]
        return out


def test_checksums_of_joined_bytes():
    for a, b in ((b"", b""), (b"a", b""), (b"", b"b"), (b"some bytes", b"more " * 1000), (b"\x00" * 99, b"\xff" * 100_001)):
        assert xlsx.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_cells_sheets_and_replacement(spark, tmp_path):
    rows = [(1, "a & <b> \"c\" \x01\x0b\n  d", 2.5, True, "red"), (None, None, float("nan"), None, None), (-3, "", float("inf"), False, "none of them"), (2**40, "한국 😀", 1e300, True, "yellow")]
    sheet = spark.createDataFrame(rows, "id long, `te.xt` string, x double, flag boolean, id_fill string").coalesce(1)
    path = str(tmp_path / "book.xlsx")
    for _ in range(2):
        xlsx.write_workbook({"검토": sheet, "none": sheet.limit(0), "dates": spark.range(3).select(F.to_date(F.lit("2024-01-02")).alias("d"))}, path, widths={"검토": {"x": 30}}, choices={"flag": ["O", "X"]}, centered=["flag"])
    found = read(path)
    assert list(found) == ["검토", "none", "dates"] and [c[0] for c in found["none"][0]] == ["id", "te.xt", "x", "flag"] and len(found["none"]) == 1
    assert [[c[0] for c in r] for r in found["검토"][1:]] == [[1.0, 'a & <b> "c" \n  d', 2.5, "true"], [None, None, "NaN", None], [-3.0, "", "Infinity", "false"], [float(2**40), "한국 😀", 1e300, "true"]]
    assert [r[0][1] for r in found["검토"]] == ["1", "5", "7", "7", "2"] and [r[3][1] for r in found["검토"]] == ["1"] + ["8"] * 4 and found["dates"][1][0][0] == "2024-01-02"
    with zipfile.ZipFile(path) as book:
        text, styles = book.read("xl/worksheets/sheet1.xml").decode(), ElementTree.fromstring(book.read("xl/styles.xml"))
    looks = styles.find("m:cellXfs", NS)
    assert len(looks) == 15 and looks[0].get("borderId") == "0" and all(x.get("borderId") == "1" for x in looks[1:]) and {f.find("m:sz", NS).get("val") for f in styles.find("m:fonts", NS)} == {"11"}
    assert [x.find("m:alignment", NS).get("horizontal") for x in (looks[1], looks[2], looks[7], looks[8], looks[10])] == ["center", None, None, "center", "center"]
    assert 'width="30"' in text and '<autoFilter ref="A1:D5"/>' in text and 'sqref="D2:D5"' in text and '"O,X"' in text
    assert [p.name for p in tmp_path.iterdir()] == ["book.xlsx"]


def test_a_failed_write_leaves_the_old_book(spark, tmp_path):
    path = tmp_path / "book.xlsx"
    xlsx.write_workbook({"a": spark.range(2)}, f"file://{path}")
    before = path.read_bytes()
    with pytest.raises(Exception):
        xlsx.write_workbook({"a": spark.range(4).select(F.raise_error(F.lit("no")).cast("string").alias("x"))}, f"file://{path}")
    assert path.read_bytes() == before and [p.name for p in tmp_path.iterdir()] == ["book.xlsx"]


def test_three_million_rows_keep_their_order(spark, tmp_path):
    began = time.time()
    path = str(tmp_path / "large.xlsx")
    xlsx.write_workbook({"rows": spark.range(3_000_000, numPartitions=6).select("id", F.concat(F.lit("row "), F.col("id").cast("string")).alias("t"))}, path)
    assert time.time() - began < 150
    with zipfile.ZipFile(path) as book:
        names = [n for n in book.namelist() if "worksheets" in n]
        assert len(names) == 3 and 'name="rows (3)"' in book.read("xl/workbook.xml").decode()
        ids = []
        for k in range(1, 4):
            text = book.read(f"xl/worksheets/sheet{k}.xml").decode()  # its checksum is looked at too
            own = [int(x) for x in re.findall(r'<row><c s="7"><v>(\d+)</v></c>', text)]
            assert len(own) < xlsx.MOST_ROWS and f'<autoFilter ref="A1:B{len(own) + 1}"/>' in text
            ids += own
    assert ids == list(range(3_000_000))
