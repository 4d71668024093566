"""Dictionaries: word frequencies, filters and word numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import explode_values
from corpusloom.operators.numbering import dense_index
from corpusloom.runtime import materialize

#: Bits of a weight that one pass of a selection looks at.
DIGIT = 16


def distinct_tokens(tokens: DataFrame) -> DataFrame:
    """Distinct words of every document: ``id, tokens``."""
    return tokens.select("id", F.array_distinct("tokens").alias("tokens"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """Number of documents each word occurs in: ``word, occurrences``.

    ``counts`` holds every word of a document once, so one partial aggregation
    per task goes before the shuffle and a word of every document costs one row
    per task.
    """
    return (
        explode_values(counts, "terms.word", "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def term_frequency(counts: DataFrame) -> DataFrame:
    """Number of times each word occurs in all documents: ``word, cnt``."""
    return (
        explode_values(counts, "terms", "t")
        .groupBy(F.col("t.word").alias("word"))
        .agg(F.sum("t.cnt").alias("cnt"))
    )


def without_stopwords(words: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Drop stop words from a table of words.

    Tokens outside the dictionary are dropped anyway, so it is enough to take the
    stop words out of the word table, which is far smaller than the tokens.
    """
    return words.join(stopwords.select("word"), "word", "left_anti")


def frequency_band(
    words: DataFrame, base: int | Column, above: float = 0.5, below: int = 5
) -> DataFrame:
    """Keep words with ``below <= occurrences <= floor(above * base)``."""
    highest = F.floor(F.lit(float(above)) * base)
    return words.where(F.col("occurrences").between(F.lit(below), highest))


def build_dictionary(
    counts: DataFrame,
    above: float = 0.5,
    below: int = 5,
    keep_n: int = 1_000_000,
    above_base: str = "docs",
    stopwords: DataFrame | None = None,
) -> DataFrame:
    """Filtered, numbered dictionary ``id INT, word, occurrences`` of a corpus.

    ``above`` is a share of the documents (``above_base="docs"``) or of the
    distinct words (``"vocab"``).  Of the words inside the band the ``keep_n``
    most frequent stay, ties by word, and get the numbers 0, 1, 2, ... in that
    order.
    """
    if above_base not in ("docs", "vocab"):
        raise ValueError(f"above_base must be 'docs' or 'vocab', not {above_base!r}")
    words = document_frequency(counts)
    if stopwords is not None:
        words = without_stopwords(words, stopwords)
    if above_base == "vocab":
        words = materialize(words, "words")  # counted first, then filtered
        base = words.count()
    else:
        base = counts.count()
    return top_words(frequency_band(words, base, above, below), "occurrences", keep_n)


def top_words(words: DataFrame, weight: str, n: int = -1) -> DataFrame:
    """Number words by falling ``weight``, then by word, and keep the first ``n``.

    ``n = -1`` keeps all.  The ``n`` words are selected before anything is sorted; their order
    comes from a range-partitioned sort, so no task ever sees more than its range, however
    large ``n`` is.
    """
    kept = words if n < 0 else highest(materialize(words, "words"), weight, n)
    return dense_index(kept, F.desc(weight), F.asc("word"), name="id", kind="int")


def lowest_kept(words: DataFrame, weight: str, n: int) -> tuple[int, int] | None:
    """The weight of the ``n``-th word by falling weight, and how many weigh more.

    None if there are fewer words.  The weight is found digit by digit, from the highest, by
    counts of the words that share the digits so far; a digit has ``DIGIT`` bits, so that many
    counts at most come to the driver.  Weights must not be negative.
    """
    n_words, largest = words.agg(F.count(F.lit(1)), F.max(weight)).first()
    if n_words <= n:
        return None
    above, prefix = 0, 0
    for shift in range(largest.bit_length() // DIGIT * DIGIT, -1, -DIGIT):
        rest = F.col(weight).cast("long")
        same = words.where(F.shiftright(rest, shift + DIGIT) == prefix) if shift + DIGIT < 64 else words
        digit = F.shiftright(rest, shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
        counts = sorted(same.groupBy(digit.alias("digit")).count().collect(), reverse=True)
        for value, count in counts:
            if above + count >= n:
                prefix = (prefix << DIGIT) + value
                break
            above += count
    return prefix, above


def highest(words: DataFrame, weight: str, n: int) -> DataFrame:
    """The ``n`` words of the highest ``weight``, ties by word; only the ties are sorted."""
    if n == 0:
        return words.limit(0)
    found = lowest_kept(words, weight, n)
    if found is None:
        return words
    lowest, above = found
    ties = dense_index(words.where(F.col(weight) == lowest), F.asc("word"), name="__tie").where(F.col("__tie") < n - above)
    return words.where(F.col(weight) > lowest).unionByName(ties.drop("__tie"))


def vocabulary(
    counts: DataFrame, vocab_size: int = 10_000, stopwords: DataFrame | None = None
) -> DataFrame:
    """The ``vocab_size`` most used words: ``id INT, word, cnt``; -1 keeps all."""
    words = term_frequency(counts)
    if stopwords is not None:
        words = without_stopwords(words, stopwords)
    return top_words(words, "cnt", vocab_size)
