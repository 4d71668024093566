"""Toxicity: held-out accuracy, counterfactual scores, edge cases."""

from __future__ import annotations

import random
import zlib

from pyspark.sql import functions as F

from corpusloom.llm import toxicity
from corpusloom.llm.catalog import QUERIES

INSULTS = "trash pathetic idiot worthless disgusting stupid clown scum loser moron".split()


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op10_toxicity"](spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    named = clean = caught = alarms = 0
    for doc, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        if r["held_out"]:
            rude = any(w in INSULTS for w in toxicity.words_of(texts[doc]))
            named, clean = named + rude, clean + (not rude)
            caught, alarms = caught + (rude and r["predicted"]), alarms + (not rude and r["predicted"])
    assert caught >= 0.9 * named > 0
    assert alarms <= 0.02 * clean


def labelled(spark, n=600):
    """Toxic texts mostly name one group; the insults decide, the group must not."""
    rng = random.Random(5)
    filler = [f"word{i}" for i in range(40)]
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        group = "muslims" if rng.random() < (0.8 if toxic else 0.1) else "christians"
        insult = rng.choice(["idiots", "scum", "trash"]) if toxic and rng.random() < 0.75 else rng.choice(filler)
        rows.append((i, " ".join([*rng.sample(filler, 5), group, insult]), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return toxicity.labelled_sample(docs, labels, lambda k: F.lit(True), "doc_id", "text", "toxic", 10_000)


def test_group_names_do_not_move_the_score(spark):
    sample = labelled(spark)
    free, held = toxicity.fit(sample, penalty=0.0), toxicity.fit(sample)

    def gap(model):
        return abs(model.score("word1 muslims word2") - model.score("word1 christians word2"))

    assert gap(free) > 0.2
    assert gap(held) < 0.02
    assert held.score("word1 muslims word2") < 0.5
    assert held.score("muslims idiots word2") > 0.5 and held.score("word3 christians scum") > 0.5


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (2, "", 5), (3, "scum " * 30000, 5), (3, "again", 5), (None, "x", 5)],
        "doc_id long, text string, toxic int",
    )
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 1), (None, 1), (99, 1), (3, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert [r["score"] for r in none] == [0.0] * 5
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
