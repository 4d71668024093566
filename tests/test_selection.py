"""The highest words by selection equal the first ones of a whole sort."""

from __future__ import annotations

import random

import pytest

from corpusloom.operators import dictionary


def frame(spark, rows):
    return spark.createDataFrame(rows, "word string, cnt long").repartition(3)


@pytest.mark.parametrize("bits", [2, 16])
def test_selection_equals_a_sort(spark, monkeypatch, bits):
    monkeypatch.setattr(dictionary, "DIGIT", bits)
    rng = random.Random(bits)
    rows = [(f"w{i:03}", rng.choice([0, 1, 1, 1, 2, 3, 3, 70, 65_536, 65_537, 1 << 40])) for i in range(200)]
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    words = frame(spark, rows)
    for n in (1, 7, 60, 199, 200, 500):
        got = [(r["id"], r["word"], r["cnt"]) for r in dictionary.top_words(words, "cnt", n).orderBy("id").collect()]
        assert got == [(i, *r) for i, r in enumerate(ordered[:n])]


def test_edges(spark):
    one = frame(spark, [("a", 5)])
    assert dictionary.top_words(one, "cnt", 0).count() == 0
    assert dictionary.top_words(one.limit(0), "cnt", 3).count() == 0
    assert dictionary.lowest_kept(frame(spark, [("a", 5), ("b", 5), ("c", 4)]), "cnt", 2) == (5, 0)


def test_only_ties_are_sorted(spark, monkeypatch):
    """Words of another weight than the last one kept take no part in any sort of the selection."""
    sorted_rows = []
    plain = dictionary.dense_index

    def counted(df, *order, **named):
        sorted_rows.append(df.count())
        return plain(df, *order, **named)

    monkeypatch.setattr(dictionary, "dense_index", counted)
    words = frame(spark, [(f"w{i}", i // 10) for i in range(1000)])
    assert dictionary.top_words(words, "cnt", 15).count() == 15
    assert sorted_rows == [10, 15]  # the ties, and what is kept
