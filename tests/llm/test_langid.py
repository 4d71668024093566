"""Language labels: exact gradients, held-out accuracy, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import langid
from corpusloom.llm.catalog import QUERIES


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    net = langid.Network(
        ["a", "b", "c"],
        langid.new_direction(rng, 3, np.float64),
        langid.new_direction(rng, 3, np.float64),
        rng.normal(size=(3, 6)),
        rng.normal(size=3),
    )
    x = rng.integers(0, 5, (7, 4))
    x[5:, 0] = langid.PAD
    y = np.array([0, 1, 2, 1])
    values = [net.forward.E, net.forward.U, net.backward.E, net.backward.U, net.W, net.b]
    _, slopes = langid.loss_and_slopes(net, x, y)
    for v, s in zip(values, slopes):
        flat, own = v.reshape(-1), s.reshape(-1)
        for i in rng.choice(flat.size, min(12, flat.size), replace=False):
            if v.shape[-1] == langid.PAD + 1:
                i = i % v.shape[0] * v.shape[1] + i % 5  # a byte that occurs
            old, step = flat[i], 1e-6
            flat[i] = old + step
            up, _ = langid.loss_and_slopes(net, x, y)
            flat[i] = old - step
            down, _ = langid.loss_and_slopes(net, x, y)
            flat[i] = old
            assert abs((up - down) / (2 * step) - own[i]) < 1e-6


def test_blocks_do_not_change_results(monkeypatch):
    rng = np.random.default_rng(1)
    net = langid.Network(
        ["a", "b"], langid.new_direction(rng, 4), langid.new_direction(rng, 4),
        rng.normal(size=(2, 8)).astype(np.float32), np.zeros(2, np.float32),
    )
    texts = [b"", b"x", b"some text " * 50, bytes(range(200)) * 9, b"end"]
    want, shares = langid.document_probabilities(net, texts)
    assert np.allclose(want.sum(axis=1), [0, 1, 1, 1, 1], atol=1e-5)
    assert np.allclose(shares.sum(axis=1), [0, 1, 1, 1, 1], atol=1e-5)
    monkeypatch.setattr(langid, "BLOCK", 3)
    got, _ = langid.document_probabilities(net, texts)
    assert np.allclose(want, got, atol=1e-5)


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op2_language_id"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text").collect()
    assert len(got) == len(rows)
    right = total = 0
    for doc, lang, text in rows:
        r = got[doc]
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        if r["held_out"] and len(text) >= 100:
            total, right = total + 1, right + (r["lang_pred"] == lang)
    assert right >= 0.95 * total > 0


def test_edge_cases(spark):
    rows = [(i, f"the {w} of the house and garden " * 5, "en", 1) for i, w in enumerate("abcdefghij")]
    rows += [(20 + i, f"der {w} des Hauses und Gartens " * 5, "de", 1) for i, w in enumerate("abcdefghij")]
    odd = [(50, None, "en", 1), (51, "", None, 1), (52, "123 ... !", "de", 1), (53, "der und des " * 20000, None, 1)]
    odd += [(None, "the house of the", None, 2), (0, "the the and", None, 2)]
    schema = "doc_id long, text string, lang string, score int"
    docs = spark.createDataFrame(rows + odd, schema)
    net = langid.fit(docs)
    assert net.langs == ["de", "en"]
    got = langid.predict(docs, net).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[i]["lang_pred"] for i in (50, 51, 52)] == ["und"] * 3
    assert by_id[53]["lang_pred"] == "de" and by_id[None]["lang_pred"] == "en"
    assert langid.fit(docs, usable=lambda key: F.lit(False)) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}
    empty = spark.createDataFrame([], schema)
    assert langid.fit(empty) is None and langid.predict(empty, None).count() == 0


def test_share_of_common_languages(spark):
    sizes = (1, 500, 501, 10**6, 524_288_001, 10**12, 10**18)
    taken = [langid.share(500, n) for n in sizes]
    assert taken[:2] == [langid.HASHES] * 2 and taken == sorted(taken, reverse=True) and taken[-1] > 0
    ids = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(langid.HASHES)).alias("h"))
    assert 400 < ids.where(F.col("h") < langid.share(500, 200_000)).count() < 600
