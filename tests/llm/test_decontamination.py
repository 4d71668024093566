"""Templates against a plain search, re-parameterised questions, edge cases."""

from __future__ import annotations

from corpusloom.llm import decontamination
from corpusloom.llm.catalog import QUERIES

ITEM = (
    "A train leaves the station at 9 and drives 120 km to meet Alice in the harbour. "
    "How long does the train need for 120 km if it drives 60 km in an hour?"
)
CHANGED = ITEM.replace("120", "350").replace("Alice", "Robert").replace("60", "70").replace("at 9", "at 11")
MIXED = ITEM.replace("120 km to", "1 km to").replace("120 km if", "2 km if")


def test_reparameterised_questions(spark):
    items = spark.createDataFrame([(7, ITEM), (7, ITEM), (8, "too short"), (9, None)], "item_id long, text string")
    rows = [
        (1, "Some words before. " + ITEM + " And some behind."),
        (2, "before " + CHANGED + " behind"),
        (3, ITEM.lower().replace("?", "")),
        (4, "A train leaves the station. " + "Nothing else is like the question here at all. " * 5),
        (5, None),
        (6, ""),
        (None, CHANGED),
        (10, "nothing " * 20000),
        (11, ITEM[: len(ITEM) // 2] + " and then the text goes on with other things altogether."),
    ]
    rows += [rows[0]]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, item int, window string")
    got = {r["doc_id"]: r for r in decontamination.contaminated(docs, items).collect()}
    assert set(got) >= {1, 2, None} and not set(got) & {4, 5, 6, 10}
    assert got[1]["item_ids"] == "7" and not got[1]["reparameterised"] and got[1]["coverage"] == 1.0
    assert got[2]["reparameterised"] and got[None]["reparameterised"]
    kept = decontamination.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({4, 5, 6, 10, 3, 11} - set(got))


def test_inconsistent_slots_are_no_match(spark):
    item = "Take 5 of them, then 5 of those, then 5 of these, then 5 of all, then 5 of none, in the end 5 of each."
    other = item
    for n in ("11", "12", "13", "14", "15", "16"):
        other = other.replace(" 5 ", f" {n} ", 1)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item.replace("5", "8")), (2, other)], "doc_id long, text string")
    assert [r["doc_id"] for r in decontamination.contaminated(docs, items).collect()] == [1]


def test_large_benchmarks_are_joined_by_shuffle(spark, sf_dir, monkeypatch):
    want = sorted(map(tuple, QUERIES["op3_decontamination"](spark, sf_dir).collect()))
    monkeypatch.setattr("corpusloom.llm.common.BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert sorted(map(tuple, QUERIES["op3_decontamination"](spark, sf_dir).collect())) == want != []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_whole_passages_are_caught(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"] for r in QUERIES["op3_decontamination"](spark, sf_dir).collect()}
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    whole = {r["doc_id"] for r in docs if r["text"] and any(i in r["text"] for i in items)}
    assert whole and whole <= got

    def runs(text):
        words = text.lower().split()
        return {" ".join(words[i : i + 8]) for i in range(len(words) - 7)}

    passages = set().union(*map(runs, items))
    assert all(passages & runs(r["text"]) for r in docs if r["doc_id"] in got)


def test_empty_tables(spark):
    items = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert decontamination.contaminated(docs.limit(0), items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0


def test_capitals_do_not_hide_an_item(spark):
    items = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    rows = [(1, ITEM.upper()), (2, ITEM.title()), (3, ITEM.lower()), (4, "NOTHING OF THE KIND " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.contaminated(docs, items).collect()}
    assert set(got) == {1, 2, 3}
    assert not any(r["reparameterised"] for r in got.values())


def test_variants_beside_an_item_do_not_hide_it(spark):
    def variant(n):
        return ITEM.replace("120", str(200 + n)).replace("60", str(70 + n)).replace("at 9", f"at {10 + n}").replace("Alice", f"Bob{n}")

    items = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    rows = [(1, " ".join([ITEM, *map(variant, range(6))])), (2, " ".join([*map(variant, range(6)), ITEM]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.contaminated(docs, items).collect()}
    assert set(got) == {1, 2} and all(r["coverage"] == 1.0 for r in got.values())


def test_every_text_of_an_item_counts(spark):
    other = "The baker sells 12 loaves in the morning and 30 more after noon, how many loaves are sold in the whole day?"
    docs = spark.createDataFrame(
        [(1, "Some words before. " + ITEM + " Behind."), (2, "Some words before. " + other + " Behind."), (3, "nothing of the kind " * 9)],
        "doc_id long, text string",
    )
    for texts in ([ITEM, other], [other, ITEM], [ITEM, other, None, "", other]):
        items = spark.createDataFrame([(7, t) for t in texts], "item_id long, text string")
        got = {r["doc_id"]: r for r in decontamination.contaminated(docs, items).collect()}
        assert set(got) == {1, 2}
        assert all(r["item_ids"] == "7" and r["n_items"] == 1 and r["coverage"] == 1.0 for r in got.values())
