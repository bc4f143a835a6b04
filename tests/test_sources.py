"""Readers of files written here byte by byte."""

import gzip
import json
import struct
import zipfile

from safra.sources import dbase, files


def dbf(rows):
    head = struct.pack("<B3xIHH20x", 3, len(rows), 32 + 64 + 1, 1 + 4 + 3)
    fields = b"".join(n.ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([size]) + b"\0" * 15 for n, size in ((b"uf", 4), (b"n", 3)))
    return head + fields + b"\r" + b"".join(mark + a.ljust(4) + b.ljust(3) for mark, a, b in rows)


def test_explode_known_stream():
    assert dbase.explode(bytes.fromhex("00048224258f807f")) == b"AIAIAIAIAIAIA"


def test_dbase_tables(spark, tmp_path):
    (tmp_path / "x.dbf").write_bytes(dbf([(b" ", b"SP", b"1"), (b"*", b"XX", b"9"), (b" ", b"S\xe3o", b"")]))
    rows = dbase.read_dbase(spark, str(tmp_path)).orderBy("row_number").collect()
    assert [r["fields"] for r in rows] == [{"UF": "SP", "N": "1"}, {"UF": "São", "N": None}]
    assert [r["name"] for r in dbase.read_layouts(spark, str(tmp_path)).orderBy("position").collect()] == ["UF", "N"]
    spark.dataSource.register(dbase.DBase)
    assert spark.read.format("dbase").option("sample_rows", 1).load(str(tmp_path / "x.dbf")).count() == 1


def test_tables_of_every_format(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"meta": [{"x": 1}], "rows": [{"uf": "AL", "n": 1}, {"uf": "SP", "n": 2}]}))
    (tmp_path / "b.xml").write_text("<r><i><uf>AL</uf></i><i><uf>SP</uf></i><t>1</t></r>")
    (tmp_path / "c.csv").write_text("uf,n\nRJ,5\n")
    (tmp_path / "d.json.gz").write_bytes(gzip.compress(b'[{"uf": "BA"}]'))
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
        z.writestr("x.csv", "uf\nMG\n")
        z.writestr("y.json", '[{"uf": "PR"}]')
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("note.txt", "n")
    (tmp_path / "g.json").write_text("{")
    got = {}
    for r in files.read_tables(spark, str(tmp_path)).orderBy("raw_file", "row_number").collect():
        got.setdefault(r["raw_file"][-5], []).append(r["error"] is None and r["fields"])
    flat = [f for rows in got.values() for f in rows]
    for want in ({"UF": "AL", "N": "1"}, {"UF": "AL"}, {"UF": "RJ", "N": "5"}, {"UF": "BA"}, {"UF": "PR"}, {"ARCHIVE_MEMBER": "note.txt"}):
        assert want in flat
    assert False in flat


def test_empty_csv_writes_nothing(spark, tmp_path):
    assert not files.write_csv(spark.range(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_excerpts(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("ação".encode("latin-1"))
    (tmp_path / "b.pdf").write_bytes(b"%PDF")
    got = {r["path"][-5:]: (r["excerpt"], r["status"]) for r in files.excerpts(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": ("ação", "ok"), "b.pdf": (None, "unsupported_format")}
