import gzip
import hashlib
import os
import sqlite3
import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark.sql import functions as F

from sigweave.operators import exports
from sigweave.sources import vocab

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _cells(path):
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None
        root = ET.fromstring(z.read("xl/worksheets/sheet1.xml"))
    return [{c.get("r"): "".join(c.itertext()) for c in row} for row in root.iter(f"{_M}row")]


def test_workbook(spark, tmp_path):
    df = spark.createDataFrame([(2, "a<b>&\x01 é", None, True), (1, "", 1.5, False), (10**17, "中文", 0.0, None)], "n bigint, `t\"` string, d double, b boolean")
    path = str(tmp_path / "x.xlsx")
    assert exports.write_workbook(df, path, "n", sheet='q"') == 3
    assert _cells(path) == [{"A1": "n", "B1": 't"', "C1": "d", "D1": "b"}, {"A2": "1", "B2": "", "C2": "1.5", "D2": "0"}, {"A3": "2", "B3": "a<b>&_x0001_ é", "D3": "1"}, {"A4": str(10**17), "B4": "中文", "C4": "0.0"}]
    assert exports.write_workbook(df.limit(0), path) == 0 and len(_cells(path)) == 1
    with pytest.raises(ValueError):
        exports.write_workbook(spark.range(1).select(F.repeat(F.lit("x"), 40000).alias("t")), path)
    assert not os.path.exists(path) and [exports._letters(i) for i in (1, 26, 27, 703)] == ["A", "Z", "AA", "AAA"]


def test_database(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", 0.5), (1, None, None), (1, None, None)], 'k int, `s "x"` string, d double').repartition(3)
    made = [exports.write_database({"nodes": df, "none": df.limit(0)}, str(tmp_path / f"{i}.gz")) for i in range(2)]
    raw = (tmp_path / "0.gz").read_bytes()
    assert made[0] == made[1] == (len(raw), hashlib.sha256(raw).hexdigest()) and not list(tmp_path.glob("*.tmp"))
    (tmp_path / "db").write_bytes(gzip.decompress(raw))
    db = sqlite3.connect(tmp_path / "db")
    assert db.execute("SELECT * FROM nodes").fetchall() == [(1, None, None), (1, None, None), (2, "b", 0.5)] and db.execute("SELECT count(*) FROM none").fetchone() == (0,)


def test_override_list_and_folder(spark, tmp_path):
    for p in ("z/deep/MedAscii", "z/MedAscii", "y"):
        (tmp_path / "v" / p).mkdir(parents=True)
    for p in ("z/deep/MedAscii", "z/MedAscii"):
        (tmp_path / "v" / p / "pt.asc").write_text("1$a$\n")
    (tmp_path / "v/y/other.asc").write_text("")
    assert vocab.find_folder(spark, str(tmp_path / "v")).endswith("/v/z/MedAscii") and vocab.find_folder(spark, str(tmp_path / "v/y")) is None
    (tmp_path / "o.csv").write_bytes("\ufeffpt_norm,pt_code,note\n  pain ,10,x\n,11,\nfever,,\nache, 12 ,\n".encode())
    assert [tuple(r)[:2] for r in vocab.override_list(spark, str(tmp_path / "o.csv")).orderBy("line_no").collect()] == [("PAIN", "10"), ("ACHE", "12")]
