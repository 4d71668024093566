from __future__ import annotations

import itertools
import random

import pytest
from pyspark.ml.clustering import DistributedLDAModel, LocalLDAModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpusloom import sinks
from corpusloom.operators import topics
from corpusloom.operators import vectors as vectors_module
from corpusloom.operators.vectors import to_vectors, vector_entries
from corpusloom.plans import apply_job, mail_job, text_job, train_job
from corpusloom.plans.topics import preprocess
from corpusloom.runtime import scratch_path
from corpusloom.sinks.topics import matrix_rows

N_WORDS, K = 12, 2
RNG = random.Random(11)
#: Two kinds of documents that share no word.
CORPUS = []
for _i in range(60):
    _low = 0 if _i % 2 else N_WORDS // 2
    _words = sorted(RNG.sample(range(_low, _low + N_WORDS // 2), 4))
    CORPUS.append((_i, _words, [RNG.randrange(1, 9) for _ in _words]))
USES = [sum(c for _, ws, cs in CORPUS for w, c in zip(ws, cs) if w == word) for word in range(N_WORDS)]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(CORPUS, "id long, words array<int>, counts array<int>")


@pytest.fixture(scope="module")
def vectors(corpus):
    return to_vectors(corpus, N_WORDS)


@pytest.fixture(scope="module", params=topics.ALGORITHMS)
def trained(request, spark, vectors):
    model = topics.train(vectors, N_WORDS, K, 30, algorithm=request.param.upper(), seed=3)
    path = scratch_path(spark, "model")
    topics.save_model(model, path)
    return request.param, model, path


def test_loading_finds_the_kind_of_model(spark, trained):
    name, _, path = trained
    kind = DistributedLDAModel if name == "em" else LocalLDAModel
    loaded = topics.load_model(spark, path)
    assert isinstance(loaded, kind)
    assert type(topics.local_model(loaded)) is LocalLDAModel


def test_topic_words_are_the_topic_matrix(spark, trained):
    name, model, path = trained
    matrix = model.topicsMatrix().toArray()
    rows = topics.topic_words(spark, path).collect()
    assert len(rows) == K * N_WORDS
    for row in rows:
        assert row.weight == pytest.approx(matrix[row.word_id, row.topic])
    for topic in range(K):
        assert sum(r.share for r in rows if r.topic == topic) == pytest.approx(1.0)
    if name == "em":
        sums = [sum(r.weight for r in rows if r.word_id == w) for w in range(N_WORDS)]
        assert sums == pytest.approx(USES)


def test_training_separates_the_two_kinds(spark, vectors, trained):
    name, model, _ = trained
    if name == "online":
        pytest.skip("few updates on a tiny corpus")
    rows = topics.document_topics(model, vectors).collect()
    best = {r.id % 2: set() for r in rows}
    for row in rows:
        assert sum(row.topic_distribution) == pytest.approx(1.0)
        best[row.id % 2].add(max(range(K), key=lambda t: row.topic_distribution[t]))
    assert len(best[0]) == len(best[1]) == 1 and best[0] != best[1]


def test_words_join_the_matrix(spark, trained):
    words = spark.createDataFrame([(i, f"word{i}") for i in range(N_WORDS)], "id int, word string")
    rows = topics.topic_words(spark, trained[2], words).collect()
    assert len(rows) == K * N_WORDS and all(r.word == f"word{r.word_id}" for r in rows)


def test_matrix_files(spark, trained):
    table = topics.topic_words(spark, trained[2])
    matrix = trained[1].topicsMatrix().toArray()
    for orient, want in (("words", matrix), ("topics", matrix.T)):
        path = scratch_path(spark, "matrix")
        sinks.write_topic_matrix(table, path, orient)
        parts = spark.read.format("binaryFile").load(path).orderBy("path").collect()
        lines = b"".join(bytes(p.content) for p in parts).decode().splitlines()
        got = [[float(x) for x in line.split(",")] for line in lines]
        assert len(got) == len(want)
        for have, wanted in zip(got, want):
            assert have == pytest.approx(list(wanted))
    with pytest.raises(ValueError):
        matrix_rows(table, "rows")


def test_same_seed_same_topics(spark, vectors):
    first, second = (
        topics.train(vectors, N_WORDS, K, 5, algorithm="em", seed=9).topicsMatrix().toArray()
        for _ in range(2)
    )
    assert first == pytest.approx(second)


def test_concentrations_are_passed_on(vectors):
    model = topics.train(vectors, N_WORDS, K, 2, 3.0, 2.0, "online")
    assert list(model.estimatedDocConcentration()) == [3.0, 3.0]
    assert model.getTopicConcentration() == 2.0
    model = topics.train(vectors, N_WORDS, K, 2, algorithm="em")
    assert list(model.estimatedDocConcentration()) == pytest.approx([50 / K + 1] * K)


def test_bad_parameters_are_refused_before_any_job(vectors):
    with pytest.raises(ValueError, match="supported"):
        topics.train(vectors, N_WORDS, K, algorithm="gibbs")
    with pytest.raises(ValueError, match="matrix"):
        topics.train(vectors, 2_000_000, 2_000)


def test_empty_documents_have_no_topics(spark, trained):
    empty = spark.createDataFrame([(1, [], [])], "id long, words array<int>, counts array<int>")
    row = topics.document_topics(trained[1], to_vectors(empty, N_WORDS)).first()
    assert row.topic_distribution == [0.0] * K


def test_online_training_leaves_keeping_its_input_to_spark(vectors, monkeypatch):
    """Spark keeps vectors; of a table that is kept already it makes them anew in every iteration."""
    seen, fit = [], topics.LDA.fit

    def watched(self, rows, *more):
        seen.append(rows.storageLevel)
        return fit(self, rows, *more)

    monkeypatch.setattr(topics.LDA, "fit", watched)
    model = topics.train(vectors, N_WORDS, K, 2, algorithm="online", seed=4)
    assert not any(level.useMemory or level.useDisk for level in seen) and len(seen) == 1
    assert model.vocabSize() == N_WORDS


def test_topics_of_a_document_are_made_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def shares(i):
        calls.add(1)
        return [0.25, None, 0.75] if i % 2 else [] if i % 4 else None

    documents = spark.range(12, numPartitions=2).select("id", shares("id").alias("topic_distribution"))
    rows = topics.exploded_topics(documents).collect()
    assert sorted((r.id, r.topic) for r in rows) == [(i, t) for i in range(1, 12, 2) for t in range(3)]
    assert {(r.topic, r.proportion) for r in rows} == {(0, 0.25), (1, None), (2, 0.75)}
    assert calls.value == 12


# --- jobs -------------------------------------------------------------------------


def test_train_and_apply_jobs(spark, corpus):
    source, out, proportions = (scratch_path(spark, name) for name in ("c", "m", "p"))
    sinks.write_corpus(corpus, N_WORDS, source)
    train_job(spark, source, out, k=K, max_iterations=5)
    apply_job(spark, f"{out}.model", source, proportions)
    lines = [r.value for r in spark.read.text(proportions).collect()]
    assert len(lines) == len(CORPUS) and all(line.startswith("(") and line.endswith("])") for line in lines)
    assert spark.read.text(out).count() == N_WORDS


TEXTS = [(f"p{i}", f"cats purr softly {'sleep ' * (i % 3)} number{i} x") for i in range(30)]


def test_text_job(spark):
    documents = spark.createDataFrame(TEXTS, "path string, document string")
    out = scratch_path(spark, "text")
    done = text_job(documents, out, fraction=1.0, vocab_size=3, stopwords=["purr"], k=K, max_iterations=2)
    words = {r.word: (r.id, r.cnt) for r in done.vocabulary.collect()}
    assert words == {"cats": (0, 30), "sleep": (1, 30), "softly": (2, 30)}
    assert (done.n_words, done.n_tokens) == (3, 90)
    assert sorted(r.id for r in done.lookup.collect()) == list(range(30))
    assert spark.read.text(out).count() == K


def test_preprocess_takes_one_sample_for_all_outputs(spark):
    documents = spark.createDataFrame(TEXTS * 20, "path string, document string")
    done = preprocess(documents, fraction=0.3, vocab_size=-1)
    ids = {r.id for r in done.lookup.collect()}
    assert ids == {r.id for r in done.vectors.collect()} and 0 < len(ids) < 600
    assert ids == set(range(len(ids)))


def test_mail_job_writes_only_what_is_asked_for(spark):
    mails = spark.createDataFrame(
        [(f"m{i}", f"Subject: s{i}\n\nThe cats sleep {'often' if i % 2 else ''}") for i in range(10)],
        "path string, document string",
    )
    meta, words, bags = (scratch_path(spark, name) for name in ("m", "d", "c"))
    only_meta = mail_job(mails, metadata=meta)
    assert only_meta.metadata.count() == 10 and only_meta.dictionary is None
    assert sorted(r.id for r in only_meta.metadata.collect()) == list(range(10))
    done = mail_job(mails, dictionary=words, corpus=bags, above=1.0, below=1)
    assert done.metadata is None
    lines = {r.value for r in spark.read.csv(words, sep="\t").selectExpr("concat_ws(' ', _c0, _c1, _c2) value").collect()}
    assert lines == {"0 cats 10", "1 sleep 10", "2 often 5"}
    assert "3 10" in {r.value for r in spark.read.text(bags).collect()}


def test_mail_job_with_a_lexicon(spark):
    mails = spark.createDataFrame([("m", "A: b\n\nThe cats slept")], "path string, document string")
    lexicon = spark.createDataFrame(
        [("cats", "cat", "NNS"), ("slept", "sleep", "VBD")], "surface string, lemma string, tag string"
    )
    done = mail_job(mails, dictionary=scratch_path(spark, "d"), above=1.0, below=1, lexicon=lexicon)
    assert {r.word for r in done.dictionary.collect()} == {"cat", "sleep"}


def test_em_makes_no_graph_of_the_corpus(spark, vectors, monkeypatch):
    """Spark's own training, a graph with an edge per entry, sees one word; the model holds the whole corpus."""
    seen, fit = [], topics.LDA.fit

    def counted(self, rows, *more):
        seen.append(rows.count())
        return fit(self, rows, *more)

    monkeypatch.setattr(topics.LDA, "fit", counted)
    model = topics.train(vectors, N_WORDS, K, 1, algorithm="em", seed=2)
    assert sum(seen) <= 1
    assert model.topicsMatrix().toArray().sum(axis=1) == pytest.approx(USES)
    assert model.getMaxIter() == 1 and model.vocabSize() == N_WORDS
    local = topics.local_model(model)
    assert local.topicsMatrix().toArray() == pytest.approx(model.topicsMatrix().toArray())
    odd = spark.createDataFrame([(1, Vectors.dense([2.5, 0.0, 1.0])), (1, Vectors.sparse(3, [1, 2], [0.0, 4.0])), (None, Vectors.sparse(3, [], []))], ["id", "features"])
    rows = vector_entries(odd).collect()
    assert sorted((r.words, r.counts) for r in rows) == [([], []), ([0, 2], [2.5, 1.0]), ([2], [4.0])]


def test_em_leaves_no_copies_of_its_input(spark, monkeypatch, tmp_path):
    """What the documents went through is gone when the model is stored."""
    from corpusloom import runtime

    numbers = itertools.count()
    place = lambda spark, label: f"{tmp_path}/{label}-{next(numbers)}"
    corpus = spark.createDataFrame([(i % 5, [i % 7, 8], [1.0, 2.0]) for i in range(40)], "id long, words array<int>, counts array<double>")
    stored = to_vectors(corpus, 10)
    for module in (runtime, topics, vectors_module):
        monkeypatch.setattr(module, "scratch_path", place)
    model = topics.train(stored, 10, 3, 2)
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert "numbered" not in left and "block-words" not in left and "answers" not in left
    assert sum(p.name.startswith("vectors-") for p in tmp_path.iterdir()) == 2  # of the model itself
    edges = spark.read.parquet(f"{model.stored_at}/oldModel/data/tokenCounts")
    assert edges.count() == 80 and edges.select("srcId").distinct().count() == 40


def test_a_large_local_model_is_saved_topic_by_topic(spark, monkeypatch, tmp_path):
    """Spark would send the matrix within one task, which it refuses from 128 MB on."""
    corpus = spark.createDataFrame([(i, [i % 7, 8], [1.0, 2.0 + i]) for i in range(40)], "id long, words array<int>, counts array<double>")
    stored = to_vectors(corpus, 10)
    model = topics.train(stored, 10, 3, 4, 0.4, 0.3, algorithm="online")
    plain, parted = str(tmp_path / "plain"), str(tmp_path / "parted")
    topics.save_model(model, plain)
    tasks = []
    monkeypatch.setattr(topics, "SAVED_AT_ONCE", 29)
    sent = topics._sent_topics
    monkeypatch.setattr(topics, "_sent_topics", lambda *a: tasks.append(sent(*a).rdd.getNumPartitions()) or sent(*a))
    topics.save_model(model, parted)
    assert tasks == [3]  # a task per topic
    one, other = topics.load_model(spark, plain), topics.load_model(spark, parted)
    assert (one.topicsMatrix().toArray() == other.topicsMatrix().toArray()).all() and one.vocabSize() == other.vocabSize() == 10
    assert one.estimatedDocConcentration() == other.estimatedDocConcentration()
    assert {p.name: v for p, v in one.extractParamMap().items()} == {p.name: v for p, v in other.extractParamMap().items()}
    rows = [spark.read.parquet(f"{p}/data").drop("topicsMatrix").first() for p in (plain, parted)]
    assert rows[0] == rows[1] and spark.read.parquet(f"{plain}/data").schema == spark.read.parquet(f"{parted}/data").schema
    assert sorted(topics.topic_words(spark, plain).collect()) == sorted(topics.topic_words(spark, parted).collect())
    found = [sorted((r["id"], r["topic_distribution"]) for r in topics.document_topics(m, stored).collect()) for m in (one, other)]
    assert found[0] == found[1]
