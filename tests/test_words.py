from __future__ import annotations

import subprocess
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions.arrays import value_counts, without_trailing_empty
from corpusloom.functions.words import PUNCTUATION_WORDS, broken_words, is_term, mail_words, terms
from corpusloom.operators import rowlookup
from corpusloom.operators import tokens as tokens_module
from corpusloom.operators.rowlookup import LOOKUP_BYTES
from corpusloom.operators.tokens import apply_lexicon, tokenize, tokenize_mail, word_counts


def one(spark, value, build):
    row = spark.createDataFrame([(value,)], "v string").select(build(F.col("v")).alias("r")).first()
    return row.r


def test_words_joined_by_marks_are_not_terms(spark):
    text = "Don't stop the well-known foo.bar, said Ms. Smith: 1st U2 naïve e.g. it"
    assert one(spark, text, terms) == ["stop", "the", "said", "smith", "naïve"]


def test_empty_and_null_texts_have_no_words(spark):
    assert one(spark, "", terms) == []
    assert one(spark, None, terms) == []


def test_two_letters_outside_the_basic_plane_are_long_enough(spark):
    assert one(spark, "\U00010400\U00010400", is_term) is True
    assert one(spark, "ab", is_term) is False
    assert one(spark, "abc", is_term) is True
    assert one(spark, "ab1", is_term) is False


def test_stop_words_are_compared_in_lower_case(spark):
    assert one(spark, "The cat THE dog", lambda v: terms(v, ["the"])) == ["cat", "dog"]


def test_plain_numbers_are_no_mail_words(spark):
    assert one(spark, "at 8:00 sold 100,000 for 0.5 to 3rd", mail_words) == ["at", "sold", "for", "to", "3rd"]


def test_word_order_is_kept(spark):
    assert one(spark, "One. Two three! Four", broken_words) == ["one", "two", "three", "four"]


def test_value_counts(spark):
    words = "b a c a b a".split()
    df = spark.createDataFrame([(words,), ([],)], "t array<string>")
    rows = [r.c for r in df.select(value_counts(F.col("t")).alias("c")).collect()]
    assert {r.word: r.cnt for r in rows[0]} == Counter(words)
    assert [r.word for r in rows[0]] == ["a", "b", "c"]
    assert rows[1] == []


def test_trailing_empty_parts_are_dropped(spark):
    df = spark.createDataFrame(
        [(["a", "", "b", "", ""],), (["", ""],), ([""],), (["x"],)], "p array<string>"
    )
    got = [r.q for r in df.select(without_trailing_empty(F.col("p")).alias("q")).collect()]
    assert got == [["a", "", "b"], [], [""], ["x"]]


LEXICON = [
    ("walked", "walk", "VBD"),
    ("walks", "walk", "VBZ"),
    ("the", "the", "DT"),
    ("can", "can", "MD"),
    ("Boss", "boss", "NN"),
]


@pytest.mark.parametrize("way", ["in rows", "broadcast", "shuffle", "hot words"])
def test_lexicon_lemmatizes_and_filters_tags(spark, way, monkeypatch):
    limit = LOOKUP_BYTES if way == "in rows" else 0
    if way in ("shuffle", "hot words"):
        monkeypatch.setattr(tokens_module, "fits_broadcast", lambda df, limit=None: False)
    if way == "hot words":
        monkeypatch.setattr(tokens_module, "HOT_WORD_ROWS", 2)
    lexicon = spark.createDataFrame(LEXICON, "surface string, lemma string, tag string")
    docs = spark.createDataFrame(
        [(1, "The boss walked; Rex walks. It can."), (2, "the can"), (3, ""), (4, "walked")],
        "id long, text string",
    )
    found = tokenize_mail(docs, "text", lexicon, lookup_limit=limit)
    want = {1: ["boss", "walk", "rex", "walk"], 2: [], 3: [], 4: ["walk"]}
    assert {r.id: r.tokens for r in found.collect()} == want

    plain = word_counts(tokenize_mail(docs, "text", stopwords=None))
    counts = apply_lexicon(plain, lexicon, lookup_limit=limit)
    got = {r.id: {t.word: t.cnt for t in r.terms} for r in counts.collect()}
    assert got == {i: dict(Counter(words)) for i, words in want.items()}


def test_without_a_lexicon_all_but_stop_words_stay(spark):
    docs = spark.createDataFrame([(1, "The boss can walk")], "id long, text string")
    assert tokenize_mail(docs, "text").first().tokens == ["boss", "can", "walk"]
    assert tokenize_mail(docs, "text", stopwords=None).first().tokens == ["the", "boss", "can", "walk"]


def test_punctuation_words():
    assert len(PUNCTUATION_WORDS) == 11 and "" in PUNCTUATION_WORDS


def test_tokenize_keeps_documents_without_words(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "word")], "id long, text string")
    assert {r.id: r.tokens for r in tokenize(docs).collect()} == {1: [], 2: ["word"]}


def test_workers_need_no_package(tmp_path):
    """Functions that run in Python workers are sent along with the job."""
    payload = cloudpickle.dumps(rowlookup._find)
    script = (
        "import pickle, sys, pyarrow as pa;"
        "find = pickle.loads(sys.stdin.buffer.read());"
        "print(find(pa.array(['b', 'x']), pa.array(['a', 'b'])).tolist(), 'corpusloom' in sys.modules)"
    )
    done = subprocess.run([sys.executable, "-c", script], input=payload, cwd=tmp_path, capture_output=True)
    assert done.stdout.decode().split("\n")[0] == "[1, -1] False", done.stderr.decode()


def test_words_of_many_rows_are_not_shuffled(spark, monkeypatch):
    """Words of many rows are looked up in place, in the lexicon or not, and their rows and empty ones stay out of the shuffle."""
    lexicon = spark.createDataFrame([("running", "run", "VBG"), ("ran", "run", "VBD"), ("every", "every", "DT")], "surface string, lemma string, tag string")
    texts = [(i, ["often", "running", "every", f"w{i}"] + (["ran"] if i == 3 else [])) for i in range(6)] + [(7, []), (8, ["the"]), (3, ["ran"])]
    counts = word_counts(spark.createDataFrame(texts, "id long, tokens array<string>"))
    rows = lambda df: sorted((r["id"], [tuple(t) for t in r["terms"]]) for r in df.collect())
    seen, split = [], tokens_module.join_split

    def watched(rows, table, key, hot, **options):
        seen.append(({r[key] for r in hot.collect()}, options))
        return split(rows, table, key, hot, **options)

    monkeypatch.setattr(tokens_module, "join_split", watched)
    got = rows(apply_lexicon(counts, lexicon, lookup_limit=0, broadcast_limit=0, hot_rows=4))
    assert seen == [({"often", "running", "every"}, {"stored": True})]
    assert (7, []) in got and (8, []) in got and (1, [("often", 1), ("run", 1), ("w1", 1)]) in got
    assert (3, [("often", 1), ("run", 3), ("w3", 1)]) in got
    assert got == rows(apply_lexicon(counts, lexicon, lookup_limit=0, broadcast_limit=0, hot_rows=100))
    entry = spark.createDataFrame([("a", 1)], "word string, n_of long")
    hot = spark.createDataFrame([("a", 3, 1), ("b", 2, None)], "word string, n long, n_of long")
    many = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), (None,), ("c",)], "word string")
    found = split(many, entry, "word", hot, stored=True)
    assert sorted(found.collect(), key=str) == sorted(split(many, entry, "word", hot).collect(), key=str)
    assert "monotonically" not in found._jdf.queryExecution().toString()  # no keys of their own for a shuffle
