"""Avro files: bytes of the format's own examples, round trips, damage and foreign files."""

from __future__ import annotations

import glob
import io

import pytest

from corpusloom.functions import avro
from corpusloom.sinks import avro as sink
from corpusloom.sinks import write_avro
from corpusloom.sources import read_avro


def put(kind, value):
    out = bytearray()
    avro.writer(kind)(value, out)
    return out.hex()


def test_bytes_of_values():
    longs = {0: "00", -1: "01", 1: "02", -2: "03", 2: "04", -64: "7f", 64: "8001"}
    assert {n: put("long", n) for n in longs} == longs
    assert put("string", "foo") == "06666f6f" and put({"type": "array", "items": "long"}, [3, 27]) == "04063600"
    assert put(["null", "string"], None) == "00" and put(["null", "string"], "a") == "020261" and put("boolean", True) == "01"
    for n in (0, -1, 1 << 62, -(1 << 63), (1 << 63) - 1):
        assert avro.get_long(io.BytesIO(bytes.fromhex(put("long", n)))) == n
    sized = bytes.fromhex("0304" + "0636" + "00")  # an array block with its size in bytes
    assert avro.reader({"type": "array", "items": "long"})(io.BytesIO(sized)) == [3, 27]


@pytest.mark.parametrize("codec", ["deflate", "null"])
def test_round_trip(spark, tmp_path, monkeypatch, codec):
    monkeypatch.setattr(sink, "BLOCK_BYTES", 200)
    rows = [
        (i, (1 << 60) - i, i / 3, float(i), bytes([i % 256, 10, 13]), None if i % 3 else f"line\nfeed {i} 漢字 \U00010400", [None, "", "a\nb"][: i % 4], i % 2 == 0)
        for i in range(300)
    ] + [(None,) * 8]
    schema = "i int, l long, d double, f float, b binary, s string, a array<string>, t boolean"
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / codec)
    write_avro(df.repartition(3), path, codec=codec)
    got = read_avro(spark, path)
    assert got.schema == df.schema
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, df.collect()), key=key)
    with open(sorted(glob.glob(f"{path}/part-*"))[0], "rb") as file:
        data = io.BytesIO(file.read())
    schema, own, sync = avro.read_header(data)
    assert own == codec and schema["name"] == "Row" and sum(1 for _ in avro.blocks(data, own, sync)) > 1


def test_empty_tables_and_errors(spark, tmp_path):
    empty = spark.createDataFrame([], "a long, b array<long>")
    write_avro(empty, str(tmp_path / "e"))
    assert read_avro(spark, str(tmp_path / "e")).collect() == []
    with pytest.raises(TypeError, match="map"):
        write_avro(spark.sql("select map(1, 2) as m"), str(tmp_path / "m"))
    with pytest.raises(ValueError, match="codec"):
        write_avro(empty, str(tmp_path / "c"), codec="snappy")
    with pytest.raises(ValueError, match="no Avro"):
        avro.read_header(io.BytesIO(b"PAR1 and so on"))
    sync = bytes(range(16))
    whole = avro.block(1, b"\x02", "null", sync)
    with pytest.raises(ValueError, match="damaged"):
        list(avro.blocks(io.BytesIO(whole[:-1] + b"x"), "null", sync))


def test_a_file_of_another_writer(spark, tmp_path):
    """No codec given, a sync mark of any bytes, unions the other way round, columns in another order."""
    schema = {"type": "record", "name": "R", "fields": [{"name": "s", "type": ["string", "null"]}, {"name": "n", "type": "int"}]}
    sync = bytes(range(240, 256))
    records = bytearray()
    for s, n in (("x", 1), (None, -5)):
        avro.writer(["string", "null"])(s, records)
        avro.writer("int")(n, records)
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.avro").write_bytes(avro.header(schema, "null", sync) + avro.block(2, bytes(records), "null", sync))
    got = read_avro(spark, str(tmp_path / "f"))
    assert [tuple(r) for r in got.collect()] == [("x", 1), (None, -5)] and got.dtypes == [("s", "string"), ("n", "int")]
