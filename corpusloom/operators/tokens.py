"""From texts to tokens and to per-document word counts."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import value_counts
from corpusloom.functions.words import (
    ENGLISH_STOP_WORDS,
    KEPT_TAGS,
    PUNCTUATION_WORDS,
    mail_words,
    sentence_words,
    terms,
)
from corpusloom.operators.bagofwords import HOT_WORD_ROWS, join_split
from corpusloom.operators.lemmas import learn_rules, lemmas
from corpusloom.operators.rowlookup import (
    LOOKUP_BYTES,
    counted_words,
    lemmatize_words,
    single_words,
)
from corpusloom.operators.tagging import Tagger, tag_sentences
from corpusloom.runtime import fits_broadcast, materialize

#: Tag given to words the lexicon does not know.
UNKNOWN_TAG = "NN"

#: Between a word and its class where both are looked up as one.
_SEPARATOR = "\t"


def tokenize(
    df: DataFrame, text: str = "text", stopwords: Iterable[str] = (), id_column: str = "id"
) -> DataFrame:
    """Simple tokenizer: ``id, tokens`` of letters-only words of three letters or more."""
    return df.select(F.col(id_column).alias("id"), terms(F.col(text), stopwords).alias("tokens"))


def tokenize_mail(
    df: DataFrame,
    text: str = "contents",
    lexicon: DataFrame | None = None,
    stopwords: Iterable[str] | None = ENGLISH_STOP_WORDS,
    id_column: str = "id",
    lookup_limit: int = LOOKUP_BYTES,
    broadcast_limit: int | None = None,
    hot_rows: int = HOT_WORD_ROWS,
) -> DataFrame:
    """Mail tokenizer: ``id, tokens`` in text order, lemmatized and tag-filtered.

    ``lexicon(surface, lemma, tag)`` replaces each word by its lemma and keeps
    the words whose tag is in the keep set; words it does not hold stay as they
    are.  Without a lexicon all words stay.  Stop words are dropped last;
    ``stopwords=None`` drops punctuation only.
    """
    words = df.select(F.col(id_column).alias("id"), mail_words(F.col(text)).alias("tokens"))
    stop = sorted(set(PUNCTUATION_WORDS).union(stopwords or ()))
    if lexicon is None:
        return words.select("id", F.filter("tokens", lambda w: ~w.isin(stop)).alias("tokens"))
    return _replaced(words, _entries(lexicon), stop, lookup_limit, broadcast_limit, hot_rows)


def tag_mail_tokens(
    df: DataFrame,
    tagger: Tagger,
    lexicon: DataFrame | None = None,
    text: str = "contents",
    stopwords: Iterable[str] | None = ENGLISH_STOP_WORDS,
    id_column: str = "id",
    sentences: Callable[[Column], Column] = sentence_words,
    lookup_limit: int = LOOKUP_BYTES,
    broadcast_limit: int | None = None,
    hot_rows: int = HOT_WORD_ROWS,
) -> DataFrame:
    """Mail tokenizer with classes from context: ``id, tokens`` in text order.

    Every word of a sentence gets its class from the tagger, the words of a kept class become
    their lemmas - from ``lexicon(surface, lemma, tag)``, or by the rules that its endings
    show; without a lexicon words stay as they are - and stop words are dropped last.
    """
    split = df.select(F.col(id_column).alias("id"), sentences(F.col(text)).alias("sentences"))
    tagged = tag_sentences(split, tagger, lookup_limit=lookup_limit, hot_rows=hot_rows)
    pair = F.zip_with(F.flatten("sentences"), F.flatten("tags"), lambda w, t: F.concat(F.lower(w), F.lit(_SEPARATOR), t))
    words = materialize(tagged.select("id", pair.alias("tokens")), "tagged-words")
    pairs = words.select(F.explode("tokens").alias("surface")).distinct()
    parts = F.split("surface", _SEPARATOR, 2)
    pairs = pairs.select(parts[0].alias("word"), parts[1].alias("tag"))
    plain = pairs.withColumn("lemma", F.col("word"))
    found = plain if lexicon is None else lemmas(pairs, lexicon, learn_rules(lexicon))
    entries = found.select(
        F.concat("word", F.lit(_SEPARATOR), "tag").alias("surface"), "lemma", F.col("tag").isin(*KEPT_TAGS).alias("kept")
    )
    stop = sorted(set(PUNCTUATION_WORDS).union(stopwords or ()))
    return _replaced(words, materialize(entries, "tagged-lemmas"), stop, lookup_limit, broadcast_limit, hot_rows)


def _replaced(
    words: DataFrame, entries: DataFrame, stop: list[str], lookup_limit: int, broadcast_limit: int | None, hot_rows: int
) -> DataFrame:
    """``id, tokens`` with the lemmas of the kept words, in order, without stop words."""
    if fits_broadcast(entries, lookup_limit):
        found = lemmatize_words(single_words(words), entries)
        return found.select(
            "id", F.filter("words", lambda w: ~w.isin(stop)).alias("tokens")
        )
    placed = words.select("id", F.posexplode_outer("tokens").alias("pos", "surface"))
    # Words that are not kept become null, which collect_list leaves out, so a
    # document without a surviving word keeps its row.
    kept = F.when(_kept(stop), F.struct("pos", "lemma"))
    return (
        _join_lexicon(placed, entries, broadcast_limit, hot_rows)
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(kept)).alias("placed"))
        .select("id", F.col("placed.lemma").alias("tokens"))
    )


def word_counts(tokens: DataFrame) -> DataFrame:
    """``id, terms`` with ``terms ARRAY<STRUCT<word, cnt>>``, one row per document.

    This is the compact form all later steps start from: each word of a document
    appears once, counted inside its row.
    """
    return tokens.select("id", value_counts(F.col("tokens")).alias("terms"))


def apply_lexicon(
    counts: DataFrame,
    lexicon: DataFrame,
    stopwords: Iterable[str] | None = ENGLISH_STOP_WORDS,
    lookup_limit: int = LOOKUP_BYTES,
    broadcast_limit: int | None = None,
    hot_rows: int = HOT_WORD_ROWS,
) -> DataFrame:
    """Lemmatize and tag-filter ``id, terms`` rows; equal lemmas are added up.

    The order of words plays no role for a bag of words, so the lexicon meets the
    counted words of each document instead of every single token.
    """
    stop = sorted(set(PUNCTUATION_WORDS).union(stopwords or ()))
    entries = _entries(lexicon)
    if fits_broadcast(entries, lookup_limit):
        pairs = F.filter(F.arrays_zip("words", "counts"), lambda p: ~p["words"].isin(stop))
        lemmas = lemmatize_words(counted_words(counts), entries).select("id", pairs.alias("pairs"))
    else:
        words = counts.select("id", F.explode_outer("terms").alias("t"))
        joined = _join_lexicon(
            words.select("id", F.col("t.word").alias("surface"), "t.cnt"), entries, broadcast_limit, hot_rows
        )
        pair = F.struct(F.col("lemma").alias("words"), F.col("cnt").alias("counts"))
        lemmas = joined.groupBy("id").agg(F.collect_list(F.when(_kept(stop), pair)).alias("pairs"))
    repeated = F.transform("pairs", lambda p: F.array_repeat(p["words"], p["counts"]))
    return lemmas.select("id", value_counts(F.flatten(repeated)).alias("terms"))


def _entries(lexicon: DataFrame) -> DataFrame:
    """One ``surface, lemma, kept`` row per word of a lexicon, in lower case, stored."""
    entry = F.min(F.struct(F.lower("lemma").alias("lemma"), "tag")).alias("entry")
    unique = lexicon.groupBy(F.lower("surface").alias("surface")).agg(entry)
    kept = F.coalesce("entry.tag", F.lit(UNKNOWN_TAG)).isin(*KEPT_TAGS)
    return materialize(unique.select("surface", "entry.lemma", kept.alias("kept")), "lexicon")


def _kept(stop: list[str]) -> Column:
    return F.col("lemma").isNotNull() & F.coalesce("kept", F.lit(True)) & ~F.col("lemma").isin(stop)


def _join_lexicon(words: DataFrame, entries: DataFrame, limit: int | None, hot_rows: int) -> DataFrame:
    """Add ``lemma`` and ``kept`` to rows with a ``surface`` word, which may be null.

    A lexicon too large to broadcast is joined by a shuffle, except for the words
    with very many rows, in the lexicon or not.  The rows are stored first, as they are counted as well.
    """
    if fits_broadcast(entries, limit):
        joined = words.join(F.broadcast(entries), "surface", "left")
    else:
        words = materialize(words, "surfaces")
        uses = words.where(F.col("surface").isNotNull()).groupBy("surface").agg(F.count(F.lit(1)).alias("n"))
        hot = uses.where(F.col("n") >= hot_rows).join(entries, "surface", "left")
        joined = join_split(words, entries, "surface", hot, stored=True)
    return joined.withColumn("lemma", F.coalesce("lemma", "surface"))
