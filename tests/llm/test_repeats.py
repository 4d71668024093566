"""Long repeats against a plain search of all strings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from corpusloom.llm import repeats
from corpusloom.llm.catalog import QUERIES


def brute_force(rows):
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen: Counter = Counter()
    for _, t in texts:
        seen.update(t[i : i + 200] for i in range(len(t) - 199))
    found = []
    for k, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\x01" * 200
        left = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        found.append((k is None, k or 0, len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(found)


def result(df):
    return sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
        for r in df.collect()
    )


def test_the_cover_holds_every_difference():
    found = Counter((a - b) % repeats.MODULUS for a in repeats.COVER for b in repeats.COVER if a != b)
    assert set(found) == set(range(1, repeats.MODULUS))


@pytest.mark.parametrize("chunk", [700, 2 << 20])
def test_any_texts(spark, chunk, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk)
    rng = random.Random(chunk)

    def words(n):
        return " ".join(rng.choice(["alpha", "é", "gamma", "delta", "eps", "漢字", "x"]) + str(rng.randrange(90)) for _ in range(n))

    base = [words(rng.choice([20, 40, 60, 200])) for _ in range(10)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(40):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            t = rng.choice(base)
            a = rng.randrange(len(t))
            parts += [words(rng.randrange(0, 12)), t[a : a + rng.choice([150, 199, 200, 201, 260, 500])]]
        rows.append((100 + i, "".join(parts)))
    exact = words(60)[:199]
    rows += [(200, exact), (201, exact), (202, exact + "!"), (203, exact + "!"), (204, "a" * 201), (205, "a" * 199)]
    rows += [(206, "ab" * 300), (207, None), (208, ""), (None, base[0]), (0, base[0]), (0, words(70))]
    rows += [(209, base[3] * 3), (210, "z" + words(100) + base[4] + base[5])]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, b"") for r in rows], "doc_id long, text string, chunk int, payload binary")
    assert result(repeats.remove_repeats(docs.repartition(3))) == brute_force(rows)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op8_suffix_dedup"](spark, sf_dir)) == brute_force(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(docs).count() == 0
