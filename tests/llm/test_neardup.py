"""Near duplicates against all pairs of small tables; signatures against exact similarity."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from corpusloom.llm import bagminhash, neardup
from corpusloom.llm.catalog import QUERIES


def bag(text: str | None) -> Counter:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_force(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """Class ids from all pairs (of texts that share a shingle)."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders: dict = {}
    for i, b in enumerate(bags):
        for s in b:
            holders.setdefault(s, []).append(i)
    tried = set()
    for held in holders.values():
        for x in range(len(held)):
            for y in range(x):
                pair = held[y], held[x]
                if pair in tried:
                    continue
                tried.add(pair)
                a, b = bags[pair[0]], bags[pair[1]]
                if sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                    parent[root(pair[0])] = root(pair[1])
    lowest: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        lowest[root(i)] = min(doc, lowest.get(root(i), doc))
    return {doc: lowest[root(i)] for i, (doc, _) in enumerate(rows)}


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(2)
    m = 4000
    for shared, own, top in ((30, 10, 1), (30, 10, 9), (5, 2, 40), (1, 0, 17)):
        names = rng.integers(1, 1 << 62, shared + 2 * own).astype(np.uint64)
        a, b = Counter(), Counter()
        for i, x in enumerate(names.tolist()):
            if i < shared + own:
                a[x] = int(rng.integers(1, top + 1))
            if i < shared or i >= shared + own:
                b[x] = int(rng.integers(1, top + 1))
        rows = [(k, x, w) for k, c in enumerate((a, b)) for x, w in c.items()]
        found = bagminhash.signatures(
            np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.uint64), np.array([r[2] for r in rows]), 3, m
        )
        exact = sum((a & b).values()) / sum((a | b).values())
        assert abs((found[0] == found[1]).mean() - exact) < 0.04
        assert not found[2].any()


def test_classes_equal_all_pairs(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows: list[tuple[int, str | None]] = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([8, 30, 80, 200]))]
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            base = copy if rng.random() < 0.4 else base  # chains of copies
            rows.append((0, " ".join(copy)))
    rows += [(0, "la " * 3000), (0, "la " * 2700), (0, "la " * 1000), (0, "LA la\tla"), (0, "one two"), (0, "one  two\n")]
    rows += [(0, None), (0, None), (0, ""), (0, " \n"), (0, rows[0][1])]
    order = list(range(len(rows)))
    rng.shuffle(order)
    rows = [(i, t) for i, (_, t) in zip(order, rows)]
    docs = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id long, text string, node int, bucket binary")
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    assert got == brute_force(rows)
    kept = neardup.without_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c in got.values()})


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    """Hundreds of texts that are alike, some of them below the limit, in blocks of a few."""
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 3)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 20)
    rng = random.Random(9)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            copy[rng.randrange(150)] = f"x{rng.randrange(9999)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    want = brute_force(rows)
    assert len(set(want.values())) > 5
    assert got == want


def test_blocks_give_forests(spark, monkeypatch):
    """However many pairs are alike, links found in a block are fewer than its members."""
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 3)
    plain = neardup._links

    def counted(table):
        found = plain(table)
        assert found.num_rows < len(set(table["node"].to_pylist()))
        return found

    monkeypatch.setattr(neardup, "_links", counted)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(120):
        copy = base[:]
        for at in rng.sample(range(100), 2):
            copy[at] = f"x{i}.{at}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()} == brute_force(rows)


def test_long_bags_make_more_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 2)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 5000)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        copy = base[:]
        for _ in range(rng.randrange(4, 9)):
            copy[rng.randrange(300)] = f"x{rng.randrange(9999)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()} == brute_force(rows)


def test_texts_of_one_id_are_judged_by_themselves(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a.replace("a7 ", "z7 ")
    rows = [(3, a), (5, a), (5, b), (7, b), (7, c), (3, near), (7, None), (7, ""), (7, None), (9, near), (11, "d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in neardup.without_duplicates(docs).collect()]
    assert sorted(kept, key=str) == sorted([(3, min(a, near)), (5, b), (7, c), (7, None), (7, ""), (11, "d e f")], key=str)


def test_query_equals_all_pairs(spark, sf_dir):
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op5_near_duplicates"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got == brute_force([tuple(r) for r in rows])


def test_repeated_rows_and_missing_ids(spark):
    text = "one two three four five six seven eight"
    rows = [(5, text), (5, text), (3, "other words that stand alone here"), (None, text), (9, text), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["class_id"]) for r in neardup.near_duplicates(docs).collect())
    assert got == [(3, 3), (3, 3), (5, 5), (5, 5), (9, 5)]
    assert [r["doc_id"] for r in neardup.without_duplicates(docs).orderBy("doc_id").collect()] == [None, 3, 3, 5]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(docs).count() == 0
    assert neardup.without_duplicates(docs).count() == 0
