"""Frequent lines of small and large hosts, blocks of them, and groups of near copies."""

from __future__ import annotations

import random

from corpusloom.llm import quality

BLOCK = [" ".join(f"{part}{i}" for i in range(20)) for part in ("rights", "contact", "imprint")]


def rows():
    rng = random.Random(4)
    words = [f"word{i}" for i in range(2000)]

    def prose():
        return [" ".join(rng.choice(words) for _ in range(20)) for _ in range(5)]

    def text(i):
        return "\n".join(prose() + (BLOCK if i % 9 == 0 else []))

    large = [(i, text(i), "large") for i in range(360)]  # 40 of 360 texts hold the block
    alike = prose() + prose()
    copies = [(1000 + i, "\n".join([*alike, prose()[0]]), "copies") for i in range(40)]
    depleted = [(2000, "\n".join(BLOCK + prose()[:1]), "large")]
    return large + copies + depleted


def judged(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    return {r["doc_id"]: r["quality"] for r in quality.add_quality(docs).collect()}


def test_lines_of_few_documents_of_a_large_host_go(spark):
    got = judged(spark)
    assert {got[i]["n_lines_removed"] for i in range(0, 360, 9)} == {3}
    assert {got[i]["n_lines_removed"] for i in range(360) if i % 9} == {0}
    assert not any(line in got[i]["clean_text"] for i in range(360) for line in BLOCK)
    assert not got[2000]["kept"] and not got[2000]["base_failed"] and got[2000]["n_lines_removed"] == 3


def test_near_copies_do_not_reject_each_other(spark):
    got = judged(spark)
    assert all(got[1000 + i]["kept"] and got[1000 + i]["n_lines_removed"] == 0 for i in range(40))


def test_many_lines_are_joined_by_shuffle(spark, monkeypatch):
    want = judged(spark)
    monkeypatch.setattr(quality, "BROADCAST_BYTES", -1)
    assert judged(spark) == want
