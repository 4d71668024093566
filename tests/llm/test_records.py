"""Binary records: exact round trips through files, and damage that is noticed."""

from __future__ import annotations

import struct
import zlib

import public_tokenizers
from tokenizers import Tokenizer

from corpusloom.llm import records
from corpusloom.llm.catalog import QUERIES
from corpusloom.runtime import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    None,
    "",
    "The end. the END, the\nend\t.. ?! 1,234 x.y. don't I'll",
    "Straße ÉTÉ été été ΑΣ ΣΑΣ. İstanbul ǅ 漢字 𐐀𐐁 <|endoftext|>. x<|endoftext|>,",
    "a b c \x1cq ́ ́, ., ,. . , é. É,",
    "long " * 20000,
    "x" * 5000,
]


def test_round_trip_equals_the_library(spark):
    rows = [(i * 7 - 3, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(None, "no id", "c", 1), (-3, "again", "c", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, start int").repartition(3)
    library = Tokenizer.from_file(VOCABULARY)
    want = sorted(
        ((r[0] is not None, r[0] or 0), [*library.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in rows
    )
    folder = scratch_path(spark, "records-test")
    records.write_records(docs, folder, VOCABULARY)
    got = sorted(((r["key"] is not None, r["key"] or 0), list(r["ids"])) for r in records.read_sequences(spark, folder).collect())
    assert got == want
    index = records.read_index(spark, folder).collect()
    assert sorted(r["ids_crc32"] for r in index) == sorted(zlib.crc32(struct.pack(f"<{len(i)}I", *i)) for _, i in want)
    placed = sorted(index, key=lambda r: r["start"])
    assert [(r["key"] is not None, r["key"] or 0) for r in placed] == [k for k, _ in want]
    total = 0
    for r in placed:
        assert r["start"] == total
        total += r["n_tokens"]


def test_query(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op9_binary_records"](spark, sf_dir).collect()}
    library = Tokenizer.from_file(VOCABULARY)
    start = 0
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc, text in sorted(map(tuple, rows)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (got[doc]["start"], got[doc]["n_tokens"]) == (start, len(ids))
        assert got[doc]["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_damage_is_noticed():
    good = records.frame(b"payload \n of bytes") + b"\n" + records.frame(b"") + b"\n"
    assert [bytes(p) for _, p in records.records(good)] == [b"payload \n of bytes", b""]
    for at in range(len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        if at == len(good) // 2 and good[at] == 10:
            continue
        try:
            same = [bytes(p) for _, p in records.records(bytes(bad))] == [b"payload \n of bytes", b""]
        except (ValueError, struct.error):
            continue
        assert same and good[at] == 10  # only an end mark carries nothing


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert records.tokens_by_document(docs, VOCABULARY).count() == 0
