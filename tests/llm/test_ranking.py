"""Ranked search against brute force: copies, ties, nulls, blocks and tiles of any size."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from corpusloom.llm import ranking

DOCS = "doc_id long, text string, item_id int, n long, rank string, class_id string"
ITEMS = "item_id long, text string, number string, doc_id string"


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(ranking.TERM, lowered)


def brute(docs, items, best=20):
    bags = [(doc, Counter(terms(text))) for doc, text in docs]
    n_docs = sum(1 for _, bag in bags if bag)
    length = sum(sum(bag.values()) for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    want = []
    for item in {i for i, _ in items}:
        uses = Counter(t for i, text in set(items) if i == item for t in terms(text))
        scored = []
        for doc, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n_docs // length if bag else 0
            score = sum(
                n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
                for t, n in uses.items() if bag[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        want += [(item, i, row[3], -row[0]) for i, row in enumerate(sorted(scored)[:best], 1)]
    return want


def fixture():
    rng = random.Random(12)
    words = [f"w{i}" for i in range(40)] + ["Straße", "ÉTÉ", "été", "x1y", "漢字", "\U00010400b"]

    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-", "_", "."]) for _ in range(n))

    docs = [(i, text(rng.randrange(1, 30))) for i in range(150)]
    docs += [(i, docs[5][1]) for i in range(150, 260)]  # one bag of more members than are asked for
    docs += [(i, " ".join(reversed(docs[7][1].split()))) for i in range(-30, 0)]
    docs += [(None, docs[7][1]), (None, "w1"), (3, docs[9][1]), (3, docs[9][1]), (400, None), (401, ""), (402, "?! -")]
    docs += [(500, text(30_000)), (501, "W1 " * 9), (502, "never seen elsewhere")]
    items = [(i, text(rng.randrange(1, 40))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "absent word"), (5, text(3)), (5, text(3)), (None, "w3 w4"), (33, "w1 " * 50)]
    items += [items[0], (34, docs[5][1])]
    return docs, items


def frames(spark, docs, items):
    docs = spark.createDataFrame([(*r, 1, 2, "clash", "clash") for r in docs], DOCS).repartition(5)
    return docs, spark.createDataFrame([(*r, "clash", "clash") for r in items], ITEMS)


def answer(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture(scope="module")
def want():
    return sorted(brute(*fixture()), key=str)


def test_equals_brute_force(spark, want):
    assert answer(ranking.ranked_documents(*frames(spark, *fixture()))) == want


def test_small_tiles_blocks_and_integers(spark, want, monkeypatch):
    for name, value in {"ROWS": 7, "COLUMNS": 5, "ITEMS": 3, "CELLS": 60, "EXACT": 10_000_000, "BROADCAST_BYTES": -1}.items():
        monkeypatch.setattr(ranking, name, value)
    monkeypatch.setattr(ranking, "BLOCK_BYTES", 4000)
    assert answer(ranking.ranked_documents(*frames(spark, *fixture()))) == want


def test_empty_tables(spark):
    docs, items = fixture()
    for d, i in (([], items), (docs, []), ([], []), ([(1, None), (2, "..")], items), (docs, [(1, None)])):
        assert answer(ranking.ranked_documents(*frames(spark, d, i))) == []
