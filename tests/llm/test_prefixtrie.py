"""The prefix trie against brute force, for few and many shards, ties, nulls and deep paths."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from corpusloom.llm import prefixtrie
from corpusloom.llm.common import WORD

SCHEMA = "conv_id long, turn long, role string, text string, path string, n string, low string, ids string, depth string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", digest(role or "", text or "")[:32], text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rest = abs(c) % 20 * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(c - rest, [])[:h] + turns[h:])
    nodes = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes[path[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in nodes:
        if node:
            children[node[:-1]] += 1
    for node, convs in nodes.items():
        own_saved = (len(convs) - 1) * (len(re.findall(WORD, node[-1][1])) if node else 0)
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += own_saved
    return sorted(
        (
            min(convs), len(node), min(nodes[node[:-1]]) if node else -1, len(convs), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if paths[c] == node).encode()).hexdigest(),
        )
        for node, convs in nodes.items()
    )


def fixture():
    rng = random.Random(13)
    said = ["a b", "", "c", "d  e\tf", "Straße 漢字", "\U00010400 x", None]
    rows = []
    for c in range(-45, 400):
        if c % 20 == 0 and rng.random() < 0.3:
            continue  # conversations whose lender is missing
        for turn in range(rng.randrange(1, 6)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(said)))
    same = [("user", "hot one"), ("assistant", "hot two words"), ("user", "three")]
    rows += [(c, k, *t) for c in range(1000, 1600) for k, t in enumerate(same)]
    rows += [(c, 0, "user", "one turn only") for c in (5021, 5041, 5061, 5062)]
    rows += [(7000, k % 300, "user", f"deep {k % 3}") for k in range(600)] + [(7001, k, "user", f"deep {k % 3}") for k in range(400)]
    rows += [(7003, k, "user", f"deep {k % 3}" if k < 390 else "end") for k in range(400)]
    rows += [(8000, None, "user", "null turn"), (8000, None, "user", "null turn"), (8000, -1, "a", "x"), (8000, -1, "a", "y")]
    rows += [(None, 1, "user", "no conversation"), (9001, 1, "user", "long " * 50_000), (10**12 + 7, 3, None, None)]
    rng.shuffle(rows)
    return rows


def answer(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", "clash", "clash", "clash", "clash") for r in rows], SCHEMA).repartition(4)
    got = prefixtrie.prefix_trie(frame).collect()
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in got)


@pytest.fixture(scope="module")
def want():
    return brute(fixture())


@pytest.mark.parametrize("shards", ["1", "5", "64"])
def test_equals_brute_force(spark, want, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        assert answer(spark, fixture()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sparse_sample_and_small_chunks(spark, want, monkeypatch):
    for name, value in {"SAMPLED": 1, "DEPTH": 2, "CHUNK_BITS": 3}.items():
        monkeypatch.setattr(prefixtrie, name, value)
    assert answer(spark, fixture()) == want


def test_small_tables(spark):
    assert answer(spark, []) == [] == answer(spark, [(None, 1, "user", "x")])
    turnless = [(c, 1, "user", "lost") for c in (1, 2, 3, 4, 5, 6)]  # some take more turns than they have, from nobody
    got = answer(spark, turnless)
    assert got == brute(turnless) and got[0][7] != hashlib.sha256().hexdigest()


def test_splitters_part_the_sample():
    rng = random.Random(3)
    paths = sorted({b"".join(bytes([rng.randrange(3)]) * 16 for _ in range(rng.randrange(9))) for _ in range(500)})
    bounds = prefixtrie.splitters(paths, 20)
    assert bounds == sorted(set(bounds)) and len(bounds) == 19
    sizes = [sum(a <= p < b for p in paths) for a, b in zip([b"", *bounds], [*bounds, b"\xff"])]
    assert max(sizes) <= 2 * len(paths) / 20
