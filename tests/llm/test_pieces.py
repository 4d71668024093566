"""Piece encoding and counting against an exhaustive segmentation, and exact round trips."""

from __future__ import annotations

import functools

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm.catalog import QUERIES
from corpusloom.llm.encoding import PieceCodec, decode_documents, encode_documents
from corpusloom.llm.pieces import SPACE
from corpusloom.llm.tokencounts import Counter, count_tokens

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None,
    "",
    " ",
    "   ",
    "one two",
    "  lead and  double   spaces and trail ",
    "lines\nand\n\nmore \n x",
    f"literal {SPACE} mark{SPACE}{SPACE}",
    "été Straße 漢字 𐐀𐐁 \x00\x01 ﬁ ①",
    "x" * 3000,
    "nospace" * 2000,
    "many words " * 5000,
]


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(VOCABULARY)


def plain_best(text: str, pieces) -> tuple[int, int]:
    """Best score and fewest ids over the whole text at once, with no units."""
    whole = (" " + text).replace(SPACE, "\ud800").replace(" ", SPACE) if text else ""
    longest = max(map(len, pieces.scores))
    best = [(0, 0)]
    for end in range(1, len(whole) + 1):
        char = whole[end - 1].replace("\ud800", SPACE)
        s, n = best[end - 1]
        options = [(s + pieces.spelt, n - len(char.encode()))]
        for start in range(max(0, end - longest), end):
            gain = pieces.scores.get(whole[start:end])
            if gain is not None:
                options.append((best[start][0] + gain, best[start][1] - 1))
        best.append(max(options))
    return best[-1][0], -best[-1][1]


@functools.cache
def counter() -> Counter:
    return Counter(VOCABULARY)


def check(text: str, codec: PieceCodec) -> None:
    import numpy as np
    import pyarrow as pa

    ids = codec.encode(text)
    assert np.array_equal(codec.encode_all(pa.array(["a", text, text], pa.large_string()))[1], ids)
    assert codec.decode(ids) == text
    score, n = plain_best(text, codec.pieces)
    assert len(ids) == n
    spelt = 0
    by_id = {i: codec.pieces.scores[p] for p, i in codec.pieces.ids.items()}
    for i in ids.tolist():
        if i in by_id:
            spelt += by_id[i]
        elif codec.pieces.data[i][0] & 0xC0 != 0x80:  # the first byte of a spelt character
            spelt += codec.pieces.spelt
    assert spelt == score
    assert counter().documents(pa.array([text], pa.large_string()))[0] == n


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None and len(t) < 5000])
def test_best_segmentation(text, codec):
    check(text, codec)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeinrst theou  \nÉ漢▁\x00"), max_size=60))
def test_best_segmentation_of_any_text(text):
    check(text, _codec())


@functools.cache
def _codec() -> PieceCodec:
    return PieceCodec(VOCABULARY)


def test_documents(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(0, "again", "c", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    encoded = encode_documents(docs, VOCABULARY, "doc_id")
    got = encoded.collect()
    assert len(got) == len(rows) and all(r["lossless"] for r in got)
    texts = sorted((r["doc_id"], r["text"]) for r in decode_documents(encoded, VOCABULARY).collect())
    assert texts == sorted((r[0], r[1] or "") for r in rows)
    counts = sorted(map(tuple, count_tokens(docs, VOCABULARY).collect()))
    assert counts == sorted((r["doc_id"], r["n_tokens"]) for r in got)


def test_queries_agree(spark, sf_dir):
    encoded = {r["doc_id"]: r for r in QUERIES["op6_sentencepiece"](spark, sf_dir).collect()}
    counted = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op7_token_counts"](spark, sf_dir).collect()}
    assert all(r["lossless"] and r["n_tokens"] == len(r["ids"]) for r in encoded.values())
    assert counted == {d: r["n_tokens"] for d, r in encoded.items()}
    codec = _codec()
    for doc, text in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(20).collect():
        if len(text) < 5000:
            assert counted[doc] == plain_best(text, codec.pieces)[1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert encode_documents(docs, VOCABULARY, "doc_id").count() == 0
    assert count_tokens(docs, VOCABULARY).count() == 0
