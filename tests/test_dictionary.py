from __future__ import annotations

import itertools
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import spark_queries
from corpusloom import sinks, sources
from corpusloom.operators import bagofwords, dictionary, rowlookup
from corpusloom.operators.numbering import dense_index
from corpusloom.operators.rowlookup import LOOKUP_BYTES
from corpusloom.operators.tokens import word_counts
from corpusloom.operators.vectors import from_vectors, lookup_vectors, to_vectors
from corpusloom.runtime import fits_broadcast, scratch_path, scratch_root, spread, value_bytes

RNG = random.Random(3)
#: Documents of Zipf-like words; every third token is the same word.
DOCS = {
    i: [
        "common" if RNG.random() < 0.33 else f"w{int(RNG.paretovariate(0.6)) % 300}"
        for _ in range(RNG.randrange(0, 60))
    ]
    for i in range(200)
}
DF = Counter(w for words in DOCS.values() for w in set(words))
TF = Counter(w for words in DOCS.values() for w in words)


@pytest.fixture(scope="module")
def counts(spark):
    return word_counts(spark.createDataFrame(list(DOCS.items()), "id long, tokens array<string>")).cache()


def expected_dictionary(base, above, below, keep_n):
    kept = [(w, n) for w, n in DF.items() if below <= n <= int(above * base)]
    kept.sort(key=lambda item: (-item[1], item[0]))
    return {w: (i, n) for i, (w, n) in enumerate(kept[:keep_n])}


@pytest.mark.parametrize(
    "above, below, keep_n, above_base",
    [
        (0.5, 5, 1_000_000, "docs"),
        (0.5, 1, 10, "docs"),
        (1.0, 2, 50, "docs"),
        (0.2, 3, 1_000_000, "vocab"),
        (0.0, 1, 5, "docs"),
    ],
)
def test_dictionary(counts, above, below, keep_n, above_base):
    got = dictionary.build_dictionary(counts, above, below, keep_n, above_base)
    base = len(DOCS) if above_base == "docs" else len(DF)
    assert {r.word: (r.id, r.occurrences) for r in got.collect()} == expected_dictionary(
        base, above, below, keep_n
    )


def test_unknown_base_is_refused(counts):
    with pytest.raises(ValueError):
        dictionary.build_dictionary(counts, above_base="words")


@pytest.mark.parametrize("n", [-1, 0, 7, 10_000])
def test_vocabulary(counts, n):
    ordered = sorted(TF.items(), key=lambda item: (-item[1], item[0]))
    want = {w: (i, c) for i, (w, c) in enumerate(ordered if n < 0 else ordered[:n])}
    assert {r.word: (r.id, r.cnt) for r in dictionary.vocabulary(counts, n).collect()} == want


def test_stop_words_leave_the_dictionary(spark, counts):
    stop = spark.createDataFrame([("common",), ("w1",)], "word string")
    words = {r.word for r in dictionary.build_dictionary(counts, 1.0, 1, stopwords=stop).collect()}
    assert words == set(DF) - {"common", "w1"}


def expected_bow(lookup):
    rows = {}
    for doc, words in DOCS.items():
        cells = sorted(Counter(lookup[w] for w in words if w in lookup).items())
        rows[doc] = ([w for w, _ in cells], [c for _, c in cells])
    return rows


@pytest.mark.parametrize("limit, hot_rows", [(None, 1_000_000), (0, 1_000_000), (0, 20), (0, 1)])
def test_join_strategies_agree(counts, limit, hot_rows):
    words = dictionary.build_dictionary(counts, 1.0, 2)
    lookup = {r.word: r.id for r in words.collect()}
    entries = counts.select("id", F.explode("terms").alias("t")).select("id", "t.word", "t.cnt")
    joined = bagofwords.join_words(entries, words, limit, hot_rows)
    got = {r.id: (r.words, r.counts) for r in bagofwords.collect_corpus(joined).collect()}
    assert got == {d: row for d, row in expected_bow(lookup).items() if row[0]}


@pytest.mark.parametrize("keep_empty", [False, True])
@pytest.mark.parametrize("limit", [0, LOOKUP_BYTES])
def test_documents_without_words(counts, keep_empty, limit):
    words = dictionary.vocabulary(counts, 3)
    want = expected_bow({r.word: r.id for r in words.collect()})
    corpus = bagofwords.bag_of_words(counts, words, keep_empty, limit)
    got = {r.id: (r.words, r.counts) for r in corpus.collect()}
    assert got == {d: row for d, row in want.items() if row[0] or keep_empty}
    assert any(not row[0] for row in want.values())


def test_lookup_vectors_equal_the_join(counts):
    words = dictionary.vocabulary(counts, 30)
    joined = bagofwords.bag_of_words(counts, words, keep_empty=True)
    want = {r.id: (r.words, r.counts) for r in joined.collect()}
    looked_up = from_vectors(lookup_vectors(counts, words))
    assert {r.id: (r.words, r.counts) for r in looked_up.collect()} == want
    stored = to_vectors(joined, 30)
    assert {r.id: (r.words, r.counts) for r in from_vectors(stored).collect()} == want
    assert stored.first().features.size == 30


def test_lookup_in_many_small_batches(spark, counts):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    words = dictionary.build_dictionary(counts, 1.0, 2).withColumn("id", F.col("id") * 3 + 5)
    want = expected_bow({r.word: r.id for r in words.collect()})
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        got = bagofwords.bag_of_words(counts, words, keep_empty=True).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {r.id: (r.words, r.counts) for r in got} == want


def test_empty_dictionary_and_empty_corpus(counts):
    none = dictionary.build_dictionary(counts, 0.0, 1)
    assert bagofwords.bag_of_words(counts, none).count() == 0
    assert bagofwords.bag_of_words(counts, none, keep_empty=True).count() == len(DOCS)
    words = dictionary.vocabulary(counts, 3)
    assert bagofwords.bag_of_words(counts.where("id < 0"), words, keep_empty=True).count() == 0


def test_corpus_stats(counts):
    words = dictionary.build_dictionary(counts, 1.0, 2)
    rows = expected_bow({r.word: r.id for r in words.collect()})
    row = bagofwords.corpus_stats(bagofwords.bag_of_words(counts, words), words).first()
    assert row.n_words == words.count()
    assert row.n_docs == sum(1 for w, _ in rows.values() if w)
    assert row.n_entries == sum(len(w) for w, _ in rows.values())
    assert row.n_tokens == sum(sum(c) for _, c in rows.values())


# --- numbering --------------------------------------------------------------------


def test_numbers_follow_the_order_across_partitions(spark):
    values = list(range(5000))
    RNG.shuffle(values)
    df = spark.createDataFrame([(v % 7, v) for v in values], "a int, b int").repartition(9)
    got = dense_index(df, F.desc("a"), "b", name="n").collect()
    want = sorted(((v % 7, v) for v in values), key=lambda p: (-p[0], p[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.n)] == want
    assert sorted(r.n for r in got) == values_range(5000)


def values_range(n):
    return list(range(n))


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_storage_numbers_are_dense(spark, rows):
    got = dense_index(spark.range(0, rows, 1, 6).withColumnRenamed("id", "v")).collect()
    assert sorted(r.id for r in got) == values_range(rows)


# --- files ------------------------------------------------------------------------


def test_corpus_file(spark, counts):
    words = dictionary.build_dictionary(counts, 1.0, 2)
    corpus = bagofwords.bag_of_words(counts, words)
    path = scratch_path(spark, "t")
    sinks.write_corpus(corpus.repartition(5), words.count(), path)
    lines = [r.value for r in spark.read.text(path).coalesce(1).collect()]
    assert set(lines) >= {"# comment", f"{words.count()} {corpus.count()}"}
    header = sources.read_corpus_header(spark, path)
    assert header == (words.count(), corpus.count())
    got = {r.id: (r.words, [int(c) for c in r.counts]) for r in sources.read_corpus(spark, path).collect()}
    assert got == {r.id: (r.words, r.counts) for r in corpus.collect()}


def test_corpus_file_begins_with_its_header(spark, counts):
    path = scratch_path(spark, "t")
    words = dictionary.vocabulary(counts, 30)
    sinks.write_corpus(bagofwords.bag_of_words(counts, words), 30, path)
    parts = spark.read.format("binaryFile").load(path).orderBy("path").collect()
    text = b"".join(bytes(p.content) for p in parts).decode().splitlines()
    assert text[0] == "# comment" and text[1].startswith("30 ")
    ids = [int(line.split(";")[0]) for line in text[2:]]
    assert ids == sorted(ids)


def write_lines(spark, lines):
    path = scratch_path(spark, "t")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_corpus_rows_of_all_forms(spark):
    path = write_lines(spark, [" # note ;-)", "9 3", "0;1,8;2,1", "", "5;;", " 7;0;2.5 "])
    assert sources.read_corpus_header(spark, path) == (9, 3)
    rows = {r.id: (r.words, r.counts) for r in sources.read_corpus(spark, path).collect()}
    assert rows == {0: ([1, 8], [2.0, 1.0]), 5: ([], []), 7: ([0], [2.5])}


@pytest.mark.parametrize("row", ["x;1;1", "1;a;1", "1;1;b"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_rows_without_numbers_fail_the_read(spark, row, ansi):
    path = write_lines(spark, ["# c", "9 3", row])
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        with pytest.raises(Exception, match="not a number"):
            sources.read_corpus(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_corpus_without_header_is_refused(spark):
    with pytest.raises(ValueError):
        sources.read_corpus_header(spark, write_lines(spark, ["0;1;1"]))


@pytest.mark.parametrize("header_again", [False, True])
def test_matrix_market(spark, header_again):
    entries = ["1 2 3", "3 1 1", "1 1 4", "", "% note", "3 4 7"]
    header = "3 4 5" if header_again else "3 9 4"
    entries += ["3 4 5"] if header_again else []  # an entry that reads like the header
    path = write_lines(spark, ["%%MatrixMarket x", "% more", header, *entries])
    assert sources.read_matrix_market_header(spark, path) == tuple(map(int, header.split()))
    rows = {r.id: (r.words, r.counts) for r in sources.read_matrix_market(spark, path).collect()}
    last = [1.0, 12.0] if header_again else [1.0, 7.0]
    assert rows == {0: ([0, 1], [4.0, 3.0]), 2: ([0, 3], last)}


def test_matrix_market_of_many_files(spark, counts):
    words = dictionary.build_dictionary(counts, 1.0, 2)
    corpus = bagofwords.bag_of_words(counts, words)
    path = scratch_path(spark, "t")
    sinks.write_matrix_market(corpus, words.count(), path)
    got = {r.id: (r.words, [int(c) for c in r.counts]) for r in sources.read_matrix_market(spark, path).collect()}
    assert got == {r.id: (r.words, r.counts) for r in corpus.collect()}


def test_stop_word_file(spark):
    path = write_lines(spark, ["the a  an", "", " the\tof "])
    assert {r.word for r in sources.read_stopwords(spark, path).collect()} == {"the", "a", "an", "of"}


def test_mail_directory_reads_whole_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "1").write_text("a\n\nb\n")
    (tmp_path / "sub" / "2").write_text("ü")
    rows = sources.read_mail_directory(spark, str(tmp_path)).collect()
    assert {r.path.rsplit("/", 1)[-1]: r.document for r in rows} == {"1": "a\n\nb\n", "2": "ü"}


def test_samples(spark):
    df = spark.range(20_000)
    kept = sources.sample_by_hash(df, F.col("id"), 0.1)
    assert kept.count() == sources.sample_by_hash(df.repartition(7), F.col("id"), 0.1).count()
    assert 1800 < kept.count() < 2200
    assert 1800 < sources.sample_documents(df, 0.1, seed=1).count() < 2200


# --- sizes and plans --------------------------------------------------------------


def test_sizes(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "w string, n int")
    assert value_bytes(df) == 2 * (32 + 8) + 2
    assert fits_broadcast(df, 100) and not fits_broadcast(df, 50)


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


class Session:
    """Just what the scratch folder is decided by."""

    def __init__(self, master, configured=None, folder=None):
        self.master, self.configured, self.folder = master, configured, folder
        self.conf = self.sparkContext = self

    def get(self, name, default):
        return self.configured

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_folder_without_a_setting():
    assert scratch_root(Session("yarn", "/shared/tmp/")) == "/shared/tmp"
    assert scratch_root(Session("yarn", folder="/shared/x")) == "/shared/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session("yarn"))
    local = Session("local[2]")
    assert scratch_root(local) == scratch_root(local) == local.folder


def test_only_small_inputs_are_spread(spark):
    assert spread(spark.range(0, 10, 1, 1), "id").rdd.getNumPartitions() == 8
    many = spark.range(0, 1000, 1, 70)
    assert spread(many, "id") is many


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_shuffle_once_and_stay_in_the_jvm(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("doc_id", "id")
    from corpusloom.operators.tokens import tokenize
    from corpusloom.runtime import materialize

    lazy = word_counts(tokenize(docs, "text"))
    plan = physical_plan(dictionary.document_frequency(lazy))
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan
    assert "ReadSchema: struct<text:string>" in plan

    stored = materialize(lazy, "t")
    plan = physical_plan(dictionary.document_frequency(stored))
    assert "ReadSchema: struct<terms:array<struct<word:string>>>" in plan

    words = dictionary.build_dictionary(stored)
    plan = physical_plan(bagofwords.bag_of_words(stored, words))
    assert "Exchange hashpartitioning" not in plan and "MapInArrow" in plan

    plan = physical_plan(bagofwords.bow_entries(stored, words))
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan
    assert "BroadcastHashJoin" in plan and "Cartesian" not in plan

    plan = physical_plan(bagofwords.collect_corpus(bagofwords.bow_entries(stored, words)))
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(id#" in plan


@pytest.mark.parametrize("split", ["1k", "128m"])
def test_rows_that_read_like_the_first_line_stay(spark, split):
    """Headers are told by their place, in files of one split and of many."""
    rows = [f"{i};1,2;{i % 9 + 1},1" for i in range(300)]
    path = write_lines(spark, [rows[7], "3 300", *rows])
    entries = [f"{i + 1} {i % 5 + 1} 2" for i in range(300)]
    matrix = write_lines(spark, [entries[0], "% note", entries[3], "%", *entries])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert sorted(r.id for r in sources.read_corpus(spark, path).collect()) == list(range(300))
        found = sources.read_matrix_market(spark, matrix).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.id, r.words, r.counts) for r in found) == [(i, [i % 5], [2.0]) for i in range(300)]


def test_lookup_in_slices_of_few_words(counts, monkeypatch):
    lists = pa.array([["a", "b"], [], ["c"], ["d", "e", "f", "g"], ["h"]])
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.concat_arrays([pa.array([["x"]]), lists])], ["id", "words"]).slice(1)
    monkeypatch.setattr(rowlookup, "SLICE_WORDS", 3)
    assert [s.column("id").to_pylist() for s in rowlookup._slices(iter([batch]))] == [[1, 2, 3], [4], [5]]
    words = dictionary.build_dictionary(counts, 1.0, 2)
    want = expected_bow({r.word: r.id for r in words.collect()})
    assert {r.id: (r.words, r.counts) for r in bagofwords.bag_of_words(counts, words, keep_empty=True).collect()} == want


def test_mails_are_written_by_many_tasks(spark, sf_dir, monkeypatch, tmp_path):
    monkeypatch.setattr(spark_queries, "scratch_path", lambda spark, label: str(tmp_path / label))
    spark_queries.mail_directory(spark, sf_dir)
    assert len({p.name.split("-")[1] for p in tmp_path.rglob("part-*.txt")}) > 1


def test_mails_are_written_without_check_files(spark, monkeypatch, tmp_path):
    texts = [(1, 0, "a\nb"), (1, 1, ""), (2, 0, None), (2, 1, "ü"), (None, 1, "c")]
    folder = str(tmp_path / "tables")
    spark.createDataFrame(texts, "conv_id long, turn long, text string").write.parquet(f"{folder}/conversations.parquet")
    monkeypatch.setattr(spark_queries, "scratch_path", lambda spark, label: str(tmp_path / label))
    found = {(r.path, r.document) for r in spark_queries.mail_directory(spark, folder).collect()}
    places = {(c, t): f"conv_id={c}/turn={t}" if c else "" for c, t, _ in texts}
    assert found == {(places[c, t], f"{text or ''}\n") for c, t, text in texts}
    assert not [*(tmp_path / "mail-files").rglob("*/.part-*.crc")]


def test_corpus_file_keeps_no_tables(spark, sf_dir, monkeypatch, tmp_path):
    """The counted words and the corpus are gone when the text is written; the dictionary is small."""
    from corpusloom import runtime

    numbers = itertools.count()
    place = lambda spark, label: f"{tmp_path}/{label}-{next(numbers)}"
    for module in (runtime, spark_queries):
        monkeypatch.setattr(module, "scratch_path", place)
    path = spark_queries.corpus_file(spark, sf_dir)
    left = sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    assert "counts" not in left and "corpus" not in left and "corpus-text" in left
    assert sources.read_corpus(spark, path).count() == sources.read_corpus_header(spark, path).n_docs > 0
