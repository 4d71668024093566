"""Word classes by sentence: a hidden Markov model trained and applied as Spark jobs.

Training counts in one pass over tagged sentences how often a class follows another, and how
often a word bears a class.  A word that training has not seen is judged by its longest known
ending, learnt from rare words.  The class sequence of a sentence is the one of the highest
total weight (Viterbi), so a word's class depends on its whole sentence.

All weights are logarithms as integers, in thousandths, so sums are exact and results do not
depend on order; of equal sequences the one with the lower class at the last difference wins.

Applying joins the *distinct* words of the texts with the model, whatever the size of either.
The joined table is looked up inside the rows if its size allows that; else the words of each
text are joined by a shuffle that treats words of very many rows apart.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.arrays import explode_values
from corpusloom.operators.bagofwords import HOT_WORD_ROWS, join_split
from corpusloom.operators.rowlookup import LOOKUP_BYTES
from corpusloom.runtime import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Longest ending, in characters, that tells the class of an unknown word.
LONGEST_ENDING = 4

#: Words of at most so many uses teach endings, as unknown words are like them.
RARE_USES = 10

#: Weights are in this part of a natural logarithm's unit.
SCALE = 1000

#: Most word classes of a model; tag sets have some dozens.
MAX_TAGS = 1000

#: Sentences decoded at once, and their words, unless one has more.
GROUP_SENTENCES, GROUP_WORDS = 256, 1 << 16

#: Words of training that a task adds up at once, unless a batch has more.
COUNTED_WORDS = 1 << 22

_NEVER = -(1 << 44)
#: Stands for the edges of a sentence, beside null for a class that is missing.
_EDGE = "\0"


@dataclass(frozen=True)
class Tagger:
    """A trained model; ``words`` and ``endings`` are stored tables ``word, entry``.

    ``moves[a][b]`` is the weight of class ``b`` after class ``a``; row and column
    ``len(tags)`` stand for the begin and the end of a sentence.
    """

    tags: list[str]
    moves: list[list[int]]
    words: DataFrame
    endings: DataFrame


def weight(share: Column) -> Column:
    return F.round(F.log(share) * SCALE).cast("long")


def ending_key(word: Column, length: Column) -> Column:
    """The last characters of a word, with a mark before those of words with capitals."""
    return F.concat(F.when(word != F.lower(word), "^").otherwise(""), F.right(F.lower(word), length))


def _edged(tags: pa.Array, lengths: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Each class and the one after it, with an edge before and after the classes of every sentence."""
    ends, edge = np.cumsum(lengths), len(tags)
    at, after = (np.insert(np.arange(edge), places, edge) for places in (ends - lengths, ends))
    held = pa.concat_arrays([tags, pa.array([_EDGE], tags.type)])
    return held.take(pa.array(at)), held.take(pa.array(after))


def _counted(a: list[pa.Array], b: list[pa.Array], follows: bool) -> pa.RecordBatch:
    """``a, b, n, follows`` of the distinct pairs without nulls."""
    pairs = pa.table({"a": pa.chunked_array(a, pa.string()), "b": pa.chunked_array(b, pa.string())}).drop_null()
    found = pairs.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
    columns = [pa.concat_arrays(found[c].chunks) if found.num_rows else pa.array([], found[c].type) for c in ("a", "b", "count_all")]
    flags = pa.array(np.full(found.num_rows, follows))
    return pa.RecordBatch.from_arrays([*columns, flags], ["a", "b", "n", "follows"])


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Uses of words with classes, and of classes after classes, added up for every COUNTED_WORDS words."""
    held: list[list[pa.Array]] = [[], [], [], []]
    size = 0
    for batch in batches:
        words, tags = batch.columns
        both = pc.and_(words.is_valid(), tags.is_valid())
        words, tags = words.filter(both), tags.filter(both)
        lengths = pc.list_value_length(words)
        if not lengths.equals(pc.list_value_length(tags)):
            raise ValueError("words and tags differ in number")
        lengths = lengths.to_numpy()
        inner = tags.flatten().cast(pa.string())
        for part, column in zip(held, (words.flatten().cast(pa.string()), inner, *_edged(inner, lengths[lengths > 0])), strict=True):
            part.append(column)
        size += len(inner)
        if size >= COUNTED_WORDS:
            yield _counted(held[0], held[1], False)
            yield _counted(held[2], held[3], True)
            held, size = [[], [], [], []], 0
    if size:
        yield _counted(held[0], held[1], False)
        yield _counted(held[2], held[3], True)


def _weights(uses: Column, totals: list[int]) -> Column:
    """``tag, weight`` of the classes of a word in order, from its ``tag, n`` rows."""
    of_all = F.array(*(F.lit(t).cast("long") for t in totals))

    def entry(tag: Column) -> Column:
        n = F.aggregate(F.filter(uses, lambda u: u["tag"] == tag), F.lit(0).cast("long"), lambda s, u: s + u["n"])
        return F.struct(tag.alias("tag"), weight(n / F.get(of_all, tag)).alias("weight"))

    return F.transform(F.sort_array(F.array_distinct(F.transform(uses, lambda u: u["tag"]))), entry)


def train_tagger(sentences: DataFrame, words: str = "words", tags: str = "tags") -> Tagger:
    """A model from one row per sentence: parallel arrays of words and classes.

    Null words or classes and empty sentences teach nothing; arrays of unlike lengths are an
    error.  Tasks add up what they read, so the sentences are read once and never stored; the
    words are shuffled once, by their lower-cased form, and all else is learnt from those groups.
    """
    rows = sentences.select(F.col(words).cast("array<string>").alias("words"), F.col(tags).cast("array<string>").alias("tags"))
    counts = materialize(rows.mapInArrow(count_pairs, "a string, b string, n long, follows boolean"), "tag-counts")
    uses = counts.where("not follows").select(F.col("a").alias("word"), F.col("b").alias("name"), "n")
    totals = dict(uses.groupBy("name").agg(F.sum("n")).limit(MAX_TAGS + 1).collect())
    if len(totals) > MAX_TAGS:
        raise ValueError(f"more than {MAX_TAGS} word classes")
    names = sorted(totals)
    if not names:
        raise ValueError("no tagged words to train with")
    number = {tag: i for i, tag in enumerate(names)}
    n_all = sum(totals.values())

    counted = counts.where("follows").groupBy("a", "b").agg(F.sum("n"))  # at most a row per pair of classes
    n = len(names)
    moves = np.ones((n + 1, n + 1))
    place = number | {_EDGE: n}
    for a, b, count in counted.collect():
        if a in place and b in place:
            moves[place[a], place[b]] += count
    moves = np.floor(np.log(moves / moves.sum(axis=1, keepdims=True)) * SCALE + 0.5).astype(int)

    spark = sentences.sparkSession
    known = spark.createDataFrame([(t, i, totals[t]) for t, i in number.items()], "name string, tag int, total long")
    placed = uses.join(F.broadcast(known.select("name", "tag")), "name").select(F.lower("word").alias("lower"), "word", "tag", "n")
    # The only shuffle of words; a group has a few rows from each task, as tasks have added up theirs.
    lower = placed.repartition("lower").groupBy("lower")
    lower = lower.agg(F.collect_list(F.struct("word", "tag", "n")).alias("uses"), F.sum("n").alias("times"))
    lower = materialize(lower, "lower-words")
    by_word = lower.select(F.col("lower").alias("word"), _weights(F.col("uses"), [totals[t] for t in names]).alias("entry"))
    by_word = materialize(by_word, "tagger-words")

    rare = explode_values(lower.where(F.col("times") <= RARE_USES), "uses", "u").select("u.*")
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.char_length("word"), F.lit(LONGEST_ENDING)))).alias("length")
    seen = rare.where("word <> ''").select("*", lengths)
    seen = seen.groupBy(ending_key(F.col("word"), F.col("length")).alias("word"), "tag").agg(F.sum("n").alias("n"))
    seen = seen.join(F.broadcast(known.select("tag", "total")), "tag")
    share = F.col("n") / F.col("of_ending") / (F.col("total") / F.lit(n_all))
    sums = seen.groupBy("word").agg(F.collect_list(F.struct("tag", "n", "total")).alias("uses"), F.sum("n").alias("of_ending"))
    shares = sums.select("word", "of_ending", F.explode("uses").alias("u")).select("word", "of_ending", "u.*")
    entry = F.sort_array(F.collect_list(F.struct("tag", weight(share).alias("weight")))).alias("entry")  # a class each
    by_ending = materialize(shares.groupBy("word").agg(entry), "tagger-endings")
    return Tagger(names, moves.tolist(), by_word, by_ending)


def save_tagger(tagger: Tagger, path: str) -> None:
    spark = tagger.words.sparkSession
    tagger.words.write.mode("overwrite").parquet(f"{path}/words")
    tagger.endings.write.mode("overwrite").parquet(f"{path}/endings")
    names = [*tagger.tags, None]
    rows = [(i, name, row) for i, (name, row) in enumerate(zip(names, tagger.moves))]
    spark.createDataFrame(rows, "number int, tag string, moves array<long>").coalesce(1).write.mode("overwrite").parquet(f"{path}/moves")


def load_tagger(spark: SparkSession, path: str) -> Tagger:
    rows = sorted(spark.read.parquet(f"{path}/moves").collect())
    words, endings = (spark.read.parquet(f"{path}/{part}") for part in ("words", "endings"))
    return Tagger([r["tag"] for r in rows[:-1]], [r["moves"] for r in rows], words, endings)


def word_entries(tagger: Tagger, words: DataFrame) -> DataFrame:
    """``word, entry`` of distinct words: what training knows of them, or of their ending.

    A word without a known ending may have any class, with no preference of its own.
    """
    known = tagger.words.select(F.col("word").alias("lower"), F.col("entry").alias("own"))
    found = materialize(words.select("word").join(known.hint("merge"), F.lower("word") == F.col("lower"), "left").drop("lower"), "known-words")
    endings = tagger.endings.select(F.col("word").alias("ending"), "entry")
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.char_length("word"), F.lit(LONGEST_ENDING)))).alias("length")
    tried = found.where("own is null and word <> ''").select("word", lengths)
    tried = tried.join(endings.hint("merge"), ending_key(F.col("word"), F.col("length")) == F.col("ending"))
    longest = tried.groupBy("word").agg(F.max_by("entry", "length").alias("entry"))
    rest = found.where("own is null").select("word").join(longest.hint("merge"), "word", "left")
    free = F.array(*(F.struct(F.lit(t).alias("tag"), F.lit(0).cast("long").alias("weight")) for t in range(len(tagger.tags))))
    rest = rest.select("word", F.coalesce("entry", free).alias("entry"))
    return found.where("own is not null").select("word", F.col("own").alias("entry")).unionByName(rest)


def best_tags(table: np.ndarray, moves: np.ndarray, word: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Class numbers of the words of sentences that follow each other in ``word``.

    ``word`` are rows of ``table``, which holds the weight of every class for a word.
    """
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    result = np.zeros(len(word), np.int64)
    n = moves.shape[0] - 1
    inner, last = moves[:n, :n], moves[:n, n]
    score = moves[n, :n] + table[word[starts]]
    back = []
    for step in range(1, int(lengths[0]) if len(lengths) else 0):
        going = int(np.searchsorted(-lengths, -step, side="left"))  # sentences of more words than step
        paths = score[:going, :, None] + inner
        best = paths.argmax(axis=1)
        back.append(best.astype(np.int16))
        moved = np.take_along_axis(paths, best[:, None, :], axis=1)[:, 0, :]
        score[:going] = moved + table[word[starts[:going] + step]]
    tag = (score + last).argmax(axis=1)
    for step in range(int(lengths[0]) - 1 if len(lengths) else -1, -1, -1):
        going = int(np.searchsorted(-lengths, -step, side="left"))
        result[starts[:going] + step] = tag[:going]
        if step:
            tag[:going] = back[step - 1][np.arange(going), tag[:going]]
    return result


def _tagged(tagger_tags: list[str], moves: np.ndarray, sentences: pa.ListArray, weights_of) -> pa.Array:
    """Class names in the shape of ``sentences``; ``weights_of(words)`` gives table and rows."""
    inner = sentences.flatten()
    words = inner.flatten()
    lengths = pc.fill_null(pc.list_value_length(inner), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    tags = np.zeros(len(words), np.int64)
    table, row = weights_of(words)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        low = ends[first] - lengths[first]
        last = min(first + GROUP_SENTENCES, max(first + 1, int(np.searchsorted(ends, low + GROUP_WORDS, side="right"))))
        filled = lengths[first:last]
        tags[low : ends[last - 1]] = best_tags(table, moves, row[low : ends[last - 1]], filled[filled > 0])
        first = last
    names = pa.array(tagger_tags, pa.string()).take(pa.array(tags))
    by_sentence = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), names)
    counts = pc.fill_null(pc.list_value_length(sentences), 0).to_numpy(zero_copy_only=False)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), by_sentence)


def _dense(entries: pa.Array, n_tags: int) -> np.ndarray:
    """Rows of weights from lists of ``tag, weight``; a class that is not listed is never taken."""
    flat = entries.flatten()
    row = np.repeat(np.arange(len(entries)), pc.list_value_length(entries).to_numpy(zero_copy_only=False))
    table = np.full((len(entries), n_tags), _NEVER, np.int64)
    table[row, flat.field("tag").to_numpy()] = flat.field("weight").to_numpy()
    return table


def _looked_up(words: pa.Array, known: pa.Array, entry: pa.Array, n_tags: int) -> tuple[np.ndarray, np.ndarray]:
    """A table of weights for the distinct words, and the row of each word in it."""
    distinct = words.dictionary_encode()
    at = pc.index_in(distinct.dictionary, known.cast(distinct.dictionary.type))
    return _dense(entry.take(at), n_tags), distinct.indices.to_numpy()


def tag_sentences(
    df: DataFrame, tagger: Tagger, sentences: str = "sentences", lookup_limit: int = LOOKUP_BYTES, hot_rows: int = HOT_WORD_ROWS
) -> DataFrame:
    """``id, sentences, tags``: a class for every word of every sentence of a text.

    ``id`` must be unique; null sentences are empty, null words are an error.
    """
    none = F.array().cast("array<array<string>>")
    rows = df.select("id", F.coalesce(sentences, none).alias("sentences"))
    rows = materialize(rows.withColumn("sentences", F.transform("sentences", lambda s: F.coalesce(s, F.array().cast("array<string>")))), "sentences")
    used = rows.select(F.explode(F.flatten("sentences")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    used = materialize(used, "used-words")
    entries = materialize(word_entries(tagger, used), "word-entries")
    size = entries.agg(F.sum(F.octet_length("word") + 16 * F.size("entry") + 48)).first()[0] or 0
    names, moves = tagger.tags, np.array(tagger.moves, np.int64)
    schema = f"id {df.schema['id'].dataType.simpleString()}, sentences array<array<string>>, tags array<array<string>>"
    if size <= lookup_limit:
        held = entries.toArrow()
        shared = df.sparkSession.sparkContext.broadcast(tuple(held[c].combine_chunks() for c in ("word", "entry")))

        def with_shared(words: pa.Array):
            return _looked_up(words, *shared.value, len(names))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tags = _tagged(names, moves, batch.column(1), with_shared)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], tags], ["id", "sentences", "tags"])

        return rows.mapInArrow(run, schema)

    words = rows.select("id", F.explode(F.array_distinct(F.flatten("sentences"))).alias("word"))
    hot = used.where(F.col("n") >= hot_rows).join(entries, "word")
    joined = join_split(words, entries, "word", hot)
    own = joined.groupBy("id").agg(F.collect_list(F.struct("word", "entry")).alias("own"))  # the distinct words of a text

    def run_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy(zero_copy_only=False))
            parts, first = [], 0
            while first < batch.num_rows:
                low = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, low + GROUP_WORDS, side="right")))
                part = batch.slice(first, last - first)
                known = part.column(2).flatten()
                held = known.field("word").dictionary_encode()
                at = np.unique(held.indices.to_numpy(), return_index=True)[1]  # texts share the entry of a word
                entry = known.field("entry").take(pa.array(at))

                def with_own(words: pa.Array, known=held.dictionary, entry=entry):
                    return _looked_up(words, known, entry, len(names))

                parts.append(_tagged(names, moves, part.column(1), with_own))
                first = last
            tags = pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], tags], ["id", "sentences", "tags"])

    own = own.withColumnRenamed("id", "of")
    return rows.join(own, F.col("id").eqNullSafe(F.col("of")), "left").select("id", "sentences", "own").mapInArrow(run_own, schema)
