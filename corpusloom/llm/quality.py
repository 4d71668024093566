"""Quality rules: frequent lines of a host are removed, depleted documents rejected.

A line is compared in a normal form (lower case, white space collapsed, digits as 0).
For every host the distinct documents that hold a line are counted; exact copies of a
text count once.  A line that stands in ``min_docs`` documents of its host or more is a
candidate, however large the host is.  Near copies hold each other's lines, so a second
count takes only documents that keep ``min_left`` of their words without all candidates:
a line is frequent if ``min_docs`` of these hold it.  Texts that are alike as a whole thus
have no say, and a block of several common lines is found line by line.  Frequent lines
are removed, and a document that keeps less than ``min_left`` of its words is depleted.
Base rules on words come first.

Everything is DataFrame expressions.  Counting shuffles one number per (host, line,
text) after map-side aggregation; a line of every document costs one row per task.
Candidate and frequent lines are broadcast as one hash table per host if their size allows
it, and then texts are not shuffled; otherwise the lines of each text are found by a shuffle
of hashes, and joined to the rows by host and text hash.

Null texts have no words and fail the base rule; a null host is a host of its own;
repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import BROADCAST_BYTES, GAPS, WORD, let, materialize, words_of
from corpusloom.runtime import value_bytes

MIN_WORDS = 50
REPEAT_PERCENT = 50
MIN_DOCS = 20
MIN_LEFT = 0.3

SYMBOLS = "[#*$%&|<>]"


def line_hash(line: Column) -> Column:
    """64-bit hash of a line in its normal form."""
    spaced = F.regexp_replace(F.lower(line), GAPS, " ")
    return F.xxhash64(F.trim(F.regexp_replace(spaced, "[0-9]", "0")))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def repeat_words(words: Column) -> Column:
    """How many words lie in a 3-word window that the text holds twice or more."""

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        keyed = F.transform(
            starts, lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))
        )
        return let(F.sort_array(keyed), covered)

    def covered(s: Column) -> Column:
        def same(x: Column, j: Column) -> Column:
            return F.get(s, j)["h"].eqNullSafe(x["h"])

        twice = F.filter(s, lambda x, j: same(x, j + 1) | ((j > 0) & same(x, F.greatest(j - 1, F.lit(0)))))
        first = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            F.sort_array(F.transform(twice, lambda x: x["i"])),
            first,
            lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(windows(words))


def base_measures(text: Column) -> Column:
    """Struct of the base counts of a text that is not null."""

    def dup(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    def counted(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines_with_words(text), dup).cast("long").alias("n_dup_lines"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
        )

    return let(words_of(text), counted)


def _host(host: str) -> Column:
    return F.coalesce(F.col(host).cast("string"), F.lit(""))


def _held(docs: DataFrame, text: str, host: str) -> DataFrame:
    """``host, content, line``: the distinct lines of every text."""
    hashes = F.array_distinct(F.transform(lines_with_words(F.col(text)), line_hash))
    return docs.where(F.col(text).isNotNull()).select(
        _host(host).alias("host"), F.xxhash64(text).alias("content"), F.explode(hashes).alias("line")
    )


def _with_lines(docs: DataFrame, lines: DataFrame, text: str, host: str) -> DataFrame:
    """``docs`` and ``__lines``: a hash table of the host's ``lines``, null if it has none."""
    if value_bytes(lines) <= BROADCAST_BYTES:
        sizes = lines.groupBy("host").agg(F.count("*").cast("int").alias("n"))
        slots = sizes.select("host", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("slot"))
        placed = lines.join(sizes, "host").select("host", F.pmod("line", "n").cast("int").alias("slot"), "line")
        slots = placed.unionByName(slots, allowMissingColumns=True).groupBy("host", "slot").agg(F.collect_list("line").alias("l"))
        tables = slots.groupBy(F.col("host").alias("__host")).agg(F.sort_array(F.collect_list(F.struct("slot", "l"))).alias("s"))
        tables = F.broadcast(tables.select("__host", F.col("s.l").alias("__lines")))
        return docs.join(tables, _host(host) == F.col("__host"), "left").drop("__host")
    own = _held(docs, text, host).distinct().join(lines.select("host", "line"), ["host", "line"], "left_semi")
    own = own.groupBy(F.col("host").alias("__host"), F.col("content").alias("__content")).agg(
        F.array(F.collect_list("line")).alias("__lines")
    )
    same = (_host(host) == F.col("__host")) & (F.xxhash64(text) == F.col("__content"))
    return docs.join(own, same, "left").drop("__host", "__content")


def _listed(h: Column) -> Column:
    """Whether ``__lines`` holds the line hash ``h``."""
    slot = F.pmod(h, F.size("__lines").cast("long")).cast("int")
    return F.array_contains(F.get("__lines", slot), h)


def frequent_lines(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    min_docs: int = MIN_DOCS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """``host, line, n_docs`` of the frequent lines, stored in the scratch folder."""
    counts = _held(docs, text, host).groupBy("host", "line").agg(F.count_distinct("content").alias("n_docs"))
    usual = materialize(counts.where(F.col("n_docs") >= min_docs), "line-counts")
    joined = _with_lines(docs.where(F.col(text).isNotNull()), usual, text, host).where(F.col("__lines").isNotNull())

    def words(lines: Column) -> Column:
        return F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + x["n"])

    def voted(lines: Column) -> Column:
        own = F.filter(lines, lambda x: ~x["usual"])
        found = F.array_distinct(F.transform(F.filter(lines, lambda x: x["usual"]), lambda x: x["h"]))
        return F.when(words(own) >= min_left * words(lines), found)

    hashed = F.transform(
        lines_with_words(F.col(text)),
        lambda line: let(
            line_hash(line),
            lambda h: F.struct(h.alias("h"), _listed(h).alias("usual"), F.regexp_count(line, F.lit(WORD)).alias("n")),
        ),
    )
    votes = joined.select(
        _host(host).alias("host"), F.xxhash64(text).alias("content"), F.explode(let(hashed, voted)).alias("line")
    )
    counts = votes.groupBy("host", "line").agg(F.count_distinct("content").alias("n_docs"))
    return materialize(counts.where(F.col("n_docs") >= min_docs), "frequent-lines")


def add_quality(
    docs: DataFrame,
    into: str = "quality",
    text: str = "text",
    host: str = "source",
    min_docs: int = MIN_DOCS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``into``: base counts, ``base_failed, kept``,
    ``n_lines_removed, n_words_left`` and ``clean_text`` (the text without frequent lines)."""
    joined = _with_lines(docs, frequent_lines(docs, text, host, min_docs, min_left), text, host)
    whole = F.coalesce(F.col(text), F.lit(""))

    def removed(line: Column) -> Column:
        return line.rlike(WORD) & let(line_hash(line), _listed)

    def cleaned(lines: Column) -> Column:
        return let(
            F.filter(lines, lambda line: ~removed(line)),
            lambda left: F.struct(
                (F.size(lines) - F.size(left)).cast("long").alias("n_lines_removed"),
                F.array_join(left, "\n").alias("clean_text"),
            ),
        )

    uncut = F.struct(F.lit(0).cast("long").alias("n_lines_removed"), whole.alias("clean_text"))
    cut = F.when(F.col("__lines").isNull(), uncut).otherwise(let(F.split(whole, "\n"), cleaned))

    def judged(base: Column, cut: Column) -> Column:
        left = F.when(cut["n_lines_removed"] == 0, base["n_words"]).otherwise(
            F.regexp_count(cut["clean_text"], F.lit(WORD)).cast("long")
        )
        failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > REPEAT_PERCENT * base["n_words"])
        return F.struct(
            *(base[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
            failed.alias("base_failed"),
            (~failed & (left >= min_left * base["n_words"])).alias("kept"),
            cut["n_lines_removed"].alias("n_lines_removed"),
            left.alias("n_words_left"),
            F.when(F.col(text).isNotNull(), cut["clean_text"]).alias("clean_text"),
        )

    result = let(F.struct(base_measures(whole).alias("base"), cut.alias("cut")), lambda x: judged(x["base"], x["cut"]))
    return joined.withColumn(into, result).drop("__lines")
