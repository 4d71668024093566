"""Bags of words: joining the words of documents with a dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import explode_values
from corpusloom.operators.rowlookup import LOOKUP_BYTES, number_words
from corpusloom.runtime import fits_broadcast

#: Rows of one word that may meet in one task when the dictionary is shuffled.
HOT_WORD_ROWS = 1_000_000

#: Most words that are looked up in place beside a shuffled dictionary.
MAX_HOT_WORDS = 100_000


def bow_entries(
    counts: DataFrame, dictionary: DataFrame, broadcast_limit: int | None = None
) -> DataFrame:
    """``id, word_id, cnt`` of all dictionary words of all documents.

    A dictionary of checked size is broadcast and the documents stay where they
    are.  A larger one is joined by a shuffle; only the words of very many
    documents are still looked up in place, so that no task receives all rows
    of such a word.
    """
    entries = explode_values(counts, "terms", "t", "id").select("id", "t.word", "t.cnt")
    return join_words(entries, dictionary, broadcast_limit).select("id", "word_id", "cnt")


def join_words(
    entries: DataFrame,
    dictionary: DataFrame,
    broadcast_limit: int | None = None,
    hot_rows: int = HOT_WORD_ROWS,
) -> DataFrame:
    """Inner join of ``word`` rows with a dictionary, adding ``word_id``."""
    lookup = dictionary.select("word", F.col("id").alias("word_id"))
    if fits_broadcast(lookup, broadcast_limit):
        return entries.join(F.broadcast(lookup), "word")
    # The dictionary tells in how many rows a word comes.
    frequency = F.col("occurrences" if "occurrences" in dictionary.columns else "cnt")
    hot = dictionary.where(frequency >= hot_rows).select("word", F.col("id").alias("word_id"), frequency.alias("n"))
    return join_split(entries, lookup, "word", hot).where(F.col("word_id").isNotNull())


def join_split(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame, stored: bool = False) -> DataFrame:
    """Left join of ``rows`` with the large ``table`` on ``key`` by one shuffle, in one pass.

    ``hot`` holds the keys of very many rows, with their number ``n`` and the columns of
    ``table``.  The MAX_HOT_WORDS of most rows are looked up in place; their rows, and
    those without a key, go through the shuffle under keys of their own that match nothing.
    Rows that are ``stored`` are cheap to read twice: then these rows are not shuffled at all.
    """
    values = [c for c in table.columns if c != key]
    listed = hot.orderBy(F.desc("n"), key).limit(MAX_HOT_WORDS)
    near = listed.select(F.col(key).alias("__hot"), F.struct(*values).alias("__near"))
    placed = rows.join(F.broadcast(near), F.col(key) == F.col("__hot"), "left")
    far = table.select(F.col(key).alias("__key"), F.struct(*values).alias("__far"))
    if stored:
        here = F.col("__hot").isNotNull() | F.col(key).isNull()
        found = placed.where(~here).join(far.hint("merge"), F.col(key) == F.col("__key"), "left").withColumn("__near", F.col("__far"))
        both = placed.where(here).select(*rows.columns, "__near").unionByName(found.select(*rows.columns, "__near"))
        return both.select(*rows.columns, *(F.col("__near")[c].alias(c) for c in values))
    spread = F.concat(F.lit("\0"), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)).cast("string"))
    own = F.when(F.col("__hot").isNotNull() | F.col(key).isNull(), spread).otherwise(F.col(key))
    joined = placed.withColumn("__key", own).join(far.hint("merge"), "__key", "left")
    found = F.coalesce("__near", "__far")
    return joined.select(*rows.columns, *(found[c].alias(c) for c in values))


def collect_corpus(cells: DataFrame) -> DataFrame:
    """One row per document from distinct ``id, word_id, cnt`` cells, words sorted.

    A document holds each word once, so a group is never longer than the
    dictionary.
    """
    pairs = F.sort_array(F.collect_list(F.struct("word_id", "cnt")))
    return (
        cells.groupBy("id")
        .agg(pairs.alias("pairs"))
        .select("id", F.col("pairs.word_id").alias("words"), F.col("pairs.cnt").alias("counts"))
    )


def bag_of_words(
    counts: DataFrame,
    dictionary: DataFrame,
    keep_empty: bool = False,
    lookup_limit: int = LOOKUP_BYTES,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """``id, words, counts`` per document; the arrays are parallel, words ascending.

    Documents without a dictionary word have no row, or with ``keep_empty`` a row
    with empty arrays.  A dictionary of up to ``lookup_limit`` bytes is looked up
    inside each row; a larger one is joined, and the words of each document are
    collected again by one shuffle.
    """
    if fits_broadcast(dictionary.select("word", "id"), lookup_limit):
        corpus = number_words(counts, dictionary)
        return corpus if keep_empty else corpus.where(F.size("words") > 0)
    corpus = collect_corpus(bow_entries(counts, dictionary, broadcast_limit))
    if not keep_empty:
        return corpus
    empty = F.array().cast("array<int>")
    return counts.select("id").join(corpus, "id", "left").select(
        "id", F.coalesce("words", empty).alias("words"), F.coalesce("counts", empty).alias("counts")
    )


def corpus_stats(corpus: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row ``n_words, n_docs, n_entries, n_tokens`` of a corpus."""
    sizes = corpus.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n_entries"),
        F.coalesce(
            F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda total, c: total + c)),
            F.lit(0),
        ).alias("n_tokens"),
    )
    n_words = dictionary.agg(F.count(F.lit(1)).alias("n")).scalar()
    return sizes.select(n_words.alias("n_words"), "n_docs", "n_entries", "n_tokens")
