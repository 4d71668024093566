"""The pipeline against a plain version of its stages, and its edge cases."""

from __future__ import annotations

import public_tokenizers
import re

import corpus_pipeline
from corpusloom.llm.catalog import ORACLE, QUERIES
from corpusloom.llm.encoding import PieceCodec
from tests.check_catalog import connect
from tests.llm.test_neardup import brute_force
from tests.llm.test_pii import base_spans


def masked(text: str) -> str:
    names = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")
    runs: list[list[int]] = []
    for a, k, b in base_spans(text):
        if runs and a < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b, k])
    out, at = [], 0
    for a, b, k in runs:
        out += [text[at:a], names[k]]
        at = b
    return "".join([*out, text[at:]])


def test_rows_equal_a_plain_version(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["pipeline"](spark, sf_dir).collect()}
    connection = connect(sf_dir)
    judged = connection.execute(ORACLE["op4_quality_rules"]).df()
    assert not judged[judged["kept"]]["n_lines_removed"].any()  # lines are cut in the test below
    kept = set(judged[judged["kept"]]["doc_id"])
    rows = connection.execute("select doc_id, text from documents").fetchall()
    rows = [(d, t) for d, t in rows if d in kept]
    classes = brute_force(rows)
    found = set(connection.execute(ORACLE["op3_decontamination"]).df()["doc_id"])
    want = {d: masked(t) for d, t in rows if classes[d] == d and d not in found}
    assert got.keys() == want.keys()
    codec = PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    for doc, r in got.items():
        import numpy as np

        assert r["lossless"] and codec.decode(np.array(r["ids"], np.int32)) == want[doc]


def test_stages_keep_columns_and_rows_that_are_clean(spark, tmp_path):
    rng = __import__("random").Random(6)
    words = [f"word{i}" for i in range(500)]

    def prose(n=80):
        return " ".join(rng.choice(words) for _ in range(n))

    common = "All rights of this page are reserved 2024"
    rows = [(i, prose() + "\n" + common.replace("2024", str(2000 + i % 9)), "en", "one", 1, "x") for i in range(30)]
    rows += [(100, f"{common}\n" * 9 + prose(50), "en", "one", 1, "x"), (101, None, None, None, None, None)]
    rows += [(102, "short", "en", "two", 1, "x"), (103, rows[0][1], "en", "two", 1, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, quality string"
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, rows[3][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == [c.strip().split()[0] for c in schema.split(",")], name
        left = {r["doc_id"]: r for r in docs.collect()}
        if name == "quality":
            assert set(left) == {*range(30), 103}  # 100 is depleted
            assert all(not re.search("rights", left[i]["text"]) for i in range(30))
            assert all(r["n_chars"] == len(r["text"]) for r in left.values())
        if name == "near_dedup":
            assert set(left) == set(range(30))
    assert set(left) == set(range(30)) - {3}


def test_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
