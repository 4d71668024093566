"""The tagger against all paths, lemma rules against all endings, and both on words held out."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import tagging_queries as queries
from corpusloom.functions.words import marked_sentences
from corpusloom.operators import lemmas as lemma_module
from corpusloom.operators import tagging, tokens
from corpusloom.operators.lemmas import learn_rules, lemmas
from corpusloom.plans.mail import mail_job, mail_tokens

SENTENCES = [
    ("the dog runs", "DT NN VBZ"), ("a dog barks loudly", "DT NN VBZ RB"), ("dogs run", "NNS VBP"),
    ("the run ended", "DT NN VBD"), ("a fast run", "DT JJ NN"), ("run", "VB"), ("the dogs run fast", "DT NNS VBP RB"),
    ("London ended the run", "NNP VBD DT NN"), ("Paris barks", "NNP VBZ"),
]


def trained(spark):
    rows = [(s.split(), t.split()) for s, t in SENTENCES]
    rows += [([], []), (None, None), (["dog", None, "odd"], ["NN", "NN", None])]
    return tagging.train_tagger(spark.createDataFrame(rows, "words array<string>, tags array<string>"))


def brute_model():
    uses, follows = Counter(), Counter()
    for words, tags in [(s.split(), t.split()) for s, t in SENTENCES] + [(["dog"], None)]:
        if tags is None:  # the row with nulls: one word with a class, at a start; what follows a gap is unknown
            uses["dog", "NN"] += 1
            follows[None, "NN"] += 1
            follows["NN", "NN"] += 1
            continue
        uses.update(zip(words, tags))
        follows.update(zip([None, *tags], [*tags, None]))
    return uses, follows


def test_weights(spark):
    tagger = trained(spark)
    uses, follows = brute_model()
    totals = Counter()
    for (_, tag), n in uses.items():
        totals[tag] += n
    assert tagger.tags == sorted(totals)
    known = {r["word"]: {tagger.tags[e["tag"]]: e["weight"] for e in r["entry"]} for r in tagger.words.collect()}
    log = lambda p: math.floor(1000 * math.log(p) + 0.5)
    assert known["run"] == {t: log(uses["run", t] / totals[t]) for t in ("NN", "VB", "VBP")}
    assert set(known["london"]) == {"NNP"}
    row = Counter({b: n for (a, b), n in follows.items() if a == "DT"})
    size = len(totals) + 1
    want = [log((row[b] + 1) / (sum(row.values()) + size)) for b in [*tagger.tags, None]]
    assert tagger.moves[tagger.tags.index("DT")] == want
    endings = {r["word"]: {tagger.tags[e["tag"]] for e in r["entry"]} for r in tagger.endings.collect()}
    assert endings["^on"] == {"NNP"} and endings["ly"] == {"RB"} and "" not in endings


def test_counts_do_not_depend_on_groups_and_sentences_are_not_stored(spark, monkeypatch):
    def model():
        found = trained(spark)
        tables = ({r["word"]: [tuple(e) for e in r["entry"]] for r in t.collect()} for t in (found.words, found.endings))
        return [found.tags, found.moves, *tables]

    stored, kept = [], tagging.materialize
    monkeypatch.setattr(tagging, "materialize", lambda df, label: stored.append(df.columns) or kept(df, label))
    whole = model()
    assert stored and not any("words" in c or "tags" in c for c in stored)
    monkeypatch.setattr(tagging, "COUNTED_WORDS", 2)
    assert model() == whole


def test_counted_pairs_of_batches():
    words, tags = [["a", None, "b"], [], None, ["b"], ["a", "a"]], [["X", "Y", None], [], ["X"], ["Y"], ["X", "X"]]
    batch = pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), pa.array(tags, pa.list_(pa.string()))], ["words", "tags"])
    got = Counter()
    for part in tagging.count_pairs([batch.slice(0, 2), batch.slice(2, 1), batch.slice(3)]):
        for r in part.to_pylist():
            got[r["a"], r["b"], r["follows"]] += r["n"]
    edge = tagging._EDGE
    assert got == {
        ("a", "X", False): 3, ("b", "Y", False): 1,
        (edge, "X", True): 2, ("X", "Y", True): 1, (edge, "Y", True): 1, ("Y", edge, True): 1, ("X", "X", True): 1, ("X", edge, True): 1,
    }


def test_rule_tags_are_those_of_the_rule(spark):
    forms = ["7up", "The", "the", "OF", "von", "Is", "was", "RUNNING", "Running", "running", "used", "Used", "only", "Only", "X", "x", "Émile", "ß", ""]
    rows = spark.createDataFrame([([a, b],) for a in forms for b in forms] + [([],), (forms,)], "words array<string>")
    want = F.expr(f"transform(words, (w, i) -> {queries.rule_tag('w', 'get(words, i - 1)')})")
    plan = rows.select(F.expr(queries.rule_tags("words")).alias("got"), want.alias("want"))
    assert all(r["got"] == r["want"] for r in plan.collect())
    assert queries.rule_tags("words").count("lower(w)") == 1  # a word is lower-cased once


def test_texts_are_decoded_in_groups(spark, monkeypatch):
    """Beside a shuffled model, texts are decoded many at a time and not one by one."""
    calls, decode = [], tagging._tagged
    monkeypatch.setattr(tagging, "_tagged", lambda *a: calls.append(1) or decode(*a))
    captured = {}
    frame = spark.createDataFrame([(i, [["the", "run"], ["dogs", "run"]]) for i in range(50)], "id long, sentences array<array<string>>")
    tagger, real = trained(spark), type(frame).mapInArrow
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, f, schema: captured.update(run=f, rows=self) or real(self, f, schema))
    tagging.tag_sentences(frame, tagger, lookup_limit=0)
    batch = captured["rows"].toArrow().combine_chunks().to_batches()[0]
    got = [r["tags"] for b in captured["run"]([batch]) for r in b.to_pylist()]
    assert got == [[["DT", "NN"], ["NNS", "VBP"]]] * 50 and len(calls) == 1


def test_best_tags_is_the_best_of_all_paths():
    rng = np.random.default_rng(5)
    n = 4
    for _ in range(20):
        table = rng.integers(-6, 1, (7, n))  # small numbers, so paths tie
        table[rng.random(table.shape) < 0.2] = tagging._NEVER
        table[:, 0] = np.maximum(table[:, 0], -9)
        moves = rng.integers(-4, 1, (n + 1, n + 1))
        lengths = rng.integers(1, 6, 5)
        word = rng.integers(0, 7, lengths.sum())
        got, at = tagging.best_tags(table, moves, word, lengths), 0
        for length in lengths.tolist():
            rows = table[word[at : at + length]]

            def value(path, rows=rows):
                steps = sum(int(moves[a, b]) for a, b in itertools.pairwise((n, *path, n)))
                return steps + sum(int(rows[i, t]) for i, t in enumerate(path))

            paths = list(itertools.product(range(n), repeat=length))
            best = max(map(value, paths))
            # of equal paths the lower class at the last difference
            want = min((p for p in paths if value(p) == best), key=lambda p: p[::-1])
            assert got[at : at + length].tolist() == list(want)
            at += length


def test_context_decides_and_odd_inputs(spark, monkeypatch):
    tagger = trained(spark)
    rows = [
        (1, [["the", "run"], ["run"], ["dogs", "run"]]),
        (2, []), (3, None), (4, [[], None, ["Berlin", "barks"], ["quickly"], ["漢字"], [""]]),
        (5, [["the", "run"] * 3000]), (-9, [["the"], ["run"]] * 700),
    ]
    frame = spark.createDataFrame(rows, "id long, sentences array<array<string>>")
    got = {r["id"]: r["tags"] for r in tagging.tag_sentences(frame, tagger).collect()}
    assert got[1] == [["DT", "NN"], ["VB"], ["NNS", "VBP"]]
    assert got[2] == [] == got[3]
    assert [len(s) for s in got[4]] == [0, 0, 2, 1, 1, 1] and got[4][2] == ["NNP", "VBZ"] and got[4][3] == ["RB"]
    assert got[5][0][:2] == ["DT", "NN"] and len(got[5][0]) == 6000 and len(got[-9]) == 1400
    monkeypatch.setattr(tagging, "GROUP_SENTENCES", 2)
    monkeypatch.setattr(tagging, "GROUP_WORDS", 3)
    again = tagging.tag_sentences(frame, tagger, lookup_limit=0, hot_rows=2).collect()
    assert {r["id"]: r["tags"] for r in again} == got
    assert tagging.tag_sentences(frame.limit(0), tagger).collect() == []


def test_texts_without_an_id_are_tagged_beside_a_shuffled_model(spark):
    frame = spark.createDataFrame([(None, [["the", "run"]]), (1, [["run"]]), (None, [["dogs", "barks"]])], "id long, sentences array<array<string>>")
    tagger = trained(spark)
    want, got = (sorted(tagging.tag_sentences(frame, tagger, **k).collect(), key=str) for k in ({}, {"lookup_limit": 0}))
    assert got == want and len(got) == 3


def test_refused_training(spark):
    one = spark.createDataFrame([(["a", "b"], ["X"])], "words array<string>, tags array<string>")
    with pytest.raises(Exception, match="differ in number"):
        tagging.train_tagger(one)
    with pytest.raises(ValueError, match="no tagged words"):
        tagging.train_tagger(one.limit(0))


def test_held_out_accuracy(spark, sf_dir):
    """Trained on three quarters of the documents, far better than the commonest class of a word."""
    rows = queries.ruled_sentences(spark, sf_dir).persist()
    held = F.col("id") % 4 == 0
    model = tagging.train_tagger(rows.where(~held))
    rest = rows.where(held).select(F.monotonically_increasing_id().alias("id"), "words", F.col("tags").alias("truth")).persist()
    tagged = tagging.tag_sentences(rest.select("id", F.array("words").alias("sentences")), model).join(rest, "id").collect()
    commonest = {r["word"]: max(r["entry"], key=lambda e: e["weight"])["tag"] for r in model.words.collect()}
    total = sum(len(r["truth"]) for r in tagged)
    right = sum(g == t for r in tagged for g, t in zip(r["tags"][0], r["truth"]))
    plain = sum(model.tags[commonest.get(w.lower(), 0)] == t for r in tagged for w, t in zip(r["words"], r["truth"]))
    rest.unpersist()
    rows.unpersist()
    assert right / total > 0.85 and right / total > plain / total + 0.1


LEXICON = [
    ("running", "run", "VBG"), ("barking", "bark", "VBG"), ("walking", "walk", "VBG"), ("sing", "sing", "VB"),
    ("cities", "city", "NNS"), ("dogs", "dog", "NNS"), ("cats", "cat", "NNS"), ("parties", "party", "NNS"),
    ("went", "go", "VBD"), ("walked", "walk", "VBD"), ("a", "a", "DT"), ("Sänge", "Sang", "NN"), (None, "x", "NN"), ("x", None, "NN"),
]


def brute_rules(lexicon):
    nodes = defaultdict(Counter)
    seen = set()
    for surface, lemma, tag in lexicon:
        if not surface or not lemma:
            continue
        word, lemma = surface.lower(), lemma.lower()
        for t in (tag, ""):
            if (t, word, lemma) in seen:
                continue
            seen.add((t, word, lemma))
            kept = next((i for i, (x, y) in enumerate(zip(word, lemma)) if x != y), min(len(word), len(lemma)))
            for n in range(len(word) - kept, len(word) + 1):
                nodes[t, word[len(word) - n :]][len(word) - kept, lemma[kept:]] += 1
    return {k: min(c, key=lambda r: (-c[r], *r)) for k, c in nodes.items()}


def brute_lemma(word, tag, lexicon, rules):
    listed = [(t != tag, lemma.lower()) for s, lemma, t in lexicon if s and lemma and s.lower() == word]
    if listed:
        return min(listed)[1]
    for t in (tag, ""):
        for n in range(len(word), -1, -1):
            if (t, word[len(word) - n :]) in rules:
                cut, added = rules[t, word[len(word) - n :]]
                if word[: len(word) - cut] + added:
                    return word[: len(word) - cut] + added
    return word


def test_lemmas_equal_brute_force(spark):
    lexicon = spark.createDataFrame(LEXICON, "surface string, lemma string, tag string")
    words = "running talking ing ed s ies berries boxes sing ring sänge klänge went bent a zzz".split()
    rows = [(w, t) for w in words for t in ("VBG", "NNS", "VBD", "XX", None)] + [("Talking", "VBG"), ("talking", "VBG")]
    rules = brute_rules(LEXICON)
    want = {(w.lower(), t): brute_lemma(w.lower(), t, LEXICON, rules) for w, t in rows}
    got = lemmas(spark.createDataFrame(rows, "word string, tag string"), lexicon, learn_rules(lexicon)).collect()
    assert {(r["word"], r["tag"]): r["lemma"] for r in got} == want and len(got) == len(want)
    assert want["talking", "VBG"] == "talk" and want["berries", "NNS"] == "berry" and want["zzz", "XX"] == "zzz"
    assert learn_rules(lexicon.limit(0)).count() == 0


def test_lemmas_of_held_out_words(spark):
    rng = random.Random(8)
    stems = {"".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 4))) + rng.choice("bdfgklmnprst") for _ in range(600)}
    forms = [("{}ing", "VBG"), ("{}ed", "VBD"), ("{}s", "NNS"), ("{}", "NN")]
    rows = [(f.format(s), s, t) for s in sorted(stems) for f, t in forms]
    rng.shuffle(rows)
    cut = len(rows) * 3 // 4
    lexicon = spark.createDataFrame(rows[:cut], "surface string, lemma string, tag string")
    held = spark.createDataFrame(rows[cut:], "word string, lemma string, tag string")
    found = lemmas(held.select("word", "tag"), lexicon, learn_rules(lexicon)).withColumnRenamed("lemma", "got")
    right = found.join(held, ["word", "tag"]).agg(F.avg((F.col("got") == F.col("lemma")).cast("int"))).first()[0]
    assert right > 0.97


def test_mail_tokens_keep_classes_and_lemmas(spark):
    tagger = trained(spark)
    lexicon = spark.createDataFrame(LEXICON, "surface string, lemma string, tag string")
    mails = spark.createDataFrame([(1, "The dogs run. Dogs barking!"), (2, ""), (3, None), (4, "the a the")], "id long, contents string")
    for limits in ({}, {"lookup_limit": 0, "broadcast_limit": 0, "hot_rows": 1}):
        found = tokens.tag_mail_tokens(mails, tagger, lexicon, sentences=marked_sentences, **limits)
        got = {r["id"]: r["tokens"] for r in found.collect()}
        assert got[1][:2] == ["dog", "run"] and got[2] == got[3] == got[4] == []
    whole = tokens.tag_mail_tokens(mails, tagger, lexicon).collect()
    assert {r["id"] for r in whole} == {1, 2, 3, 4}


def test_mail_job_with_a_tagger(spark, tmp_path):
    tagger = trained(spark)
    lexicon = spark.createDataFrame(LEXICON, "surface string, lemma string, tag string")
    mails = [(i, str(i), f"From: a@b.example\nSubject: s\n\nThe dogs run fast. A dog barks {'loudly' if i % 2 else 'fast'}.\n") for i in range(6)]
    mails = spark.createDataFrame(mails, "id long, path string, document string")
    result = mail_job(mails, dictionary=str(tmp_path / "d"), above=1.0, below=1, tagger=tagger, lexicon=lexicon)
    found = mail_tokens(mails, lexicon, tagger=tagger).select("id", F.explode(F.array_distinct("tokens")).alias("word"))
    want = {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}
    assert {r["word"]: r["occurrences"] for r in result.dictionary.collect()} == want and want["dog"] == 6 and want["loudly"] == 3
    plain = tokens.tag_mail_tokens(mails.select("id", F.lit("dogs").alias("contents")), tagger).first()
    assert plain["tokens"] == ["dogs"]


def test_endings_are_never_sent_to_the_driver(spark, monkeypatch):
    """The endings of the words, many times the words, are no side of a broadcast."""
    lexicon = spark.createDataFrame(LEXICON, "surface string, lemma string, tag string")
    rules = learn_rules(lexicon)
    words = spark.createDataFrame([("walking", "VBG"), ("zzz", "NN"), ("odd", None)], "word string, tag string")
    want = sorted(lemma_module.rule_lemmas(words, rules).collect(), key=str)
    monkeypatch.setattr(lemma_module, "RULES_BYTES", 0, raising=False)
    found = lemma_module.rule_lemmas(words, rules)
    assert sorted(found.collect(), key=str) == want and len(want) == 3
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_training_makes_the_classes_once(spark):
    made = spark.sparkContext.accumulator(0)

    def tag(words):
        made.add(1)
        return ["NN"] * len(words)

    rows = spark.createDataFrame([(["dog"],), (["run", "fast"],)], "words array<string>").withColumn("tags", F.udf(tag, "array<string>")("words"))
    assert tagging.train_tagger(rows).tags == ["NN"] and made.value == 2
