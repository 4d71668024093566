"""Mail job: raw messages to a metadata table, a dictionary and a corpus."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import value_counts
from corpusloom.functions.cleaning import clean_text
from corpusloom.functions.headers import header_fields, metadata_columns, split_message
from corpusloom.functions.mime import body_text, repair_multipart
from corpusloom.functions.words import ENGLISH_STOP_WORDS, PUNCTUATION_WORDS, mail_words
from corpusloom.operators.bagofwords import bag_of_words
from corpusloom.operators.dictionary import build_dictionary
from corpusloom.operators.numbering import dense_index
from corpusloom.operators.tagging import Tagger
from corpusloom.operators.tokens import apply_lexicon, tag_mail_tokens, tokenize_mail, word_counts
from corpusloom.runtime import materialize
from corpusloom.sinks import write_corpus, write_dictionary, write_metadata


def _messages(mails: DataFrame, *keep: str) -> DataFrame:
    return mails.select(*keep, split_message(F.col("document")).alias("message")).select(
        *keep,
        header_fields(F.col("message")[0]).alias("fields"),
        F.get("message", F.lit(1)).alias("body"),
    )


def extract_messages(documents: DataFrame) -> DataFrame:
    """``id, path, fields, body`` of raw ``id, path, document`` rows."""
    return _messages(documents, "id", "path")


def _contents(strict: bool) -> Column:
    """Repaired and cleaned text of a message with ``fields`` and ``body``."""
    return clean_text(repair_multipart(body_text(F.col("fields"), F.col("body"))), strict)


def mail_metadata(documents: DataFrame) -> DataFrame:
    """Metadata table: ids, path, date, subject and the addresses of each message."""
    columns = metadata_columns(F.col("fields"))
    return extract_messages(documents).select(
        "id", "path", *(column.alias(name) for name, column in columns.items())
    )


def mail_contents(documents: DataFrame, strict: bool = False) -> DataFrame:
    """``id, contents``: the text of each message, repaired and cleaned."""
    return (
        extract_messages(documents)
        .select("id", body_text(F.col("fields"), F.col("body")).alias("contents"))
        .select("id", repair_multipart(F.col("contents")).alias("contents"))
        .select("id", clean_text(F.col("contents"), strict).alias("contents"))
    )


def mail_tokens(
    documents: DataFrame,
    lexicon: DataFrame | None = None,
    stopwords: Iterable[str] | None = ENGLISH_STOP_WORDS,
    strict: bool = False,
    tagger: Tagger | None = None,
) -> DataFrame:
    """``id, tokens`` of each message in text order; with a tagger, context decides what is kept."""
    contents = mail_contents(documents, strict)
    if tagger is not None:
        return tag_mail_tokens(contents, tagger, lexicon, stopwords=stopwords)
    return tokenize_mail(contents, "contents", lexicon, stopwords)


@dataclass
class MailResult:
    metadata: DataFrame | None = None
    dictionary: DataFrame | None = None
    corpus: DataFrame | None = None


def mail_job(
    mails: DataFrame,
    metadata: str | None = None,
    dictionary: str | None = None,
    corpus: str | None = None,
    above: float = 0.5,
    below: int = 5,
    keep_n: int = 1_000_000,
    above_base: str = "docs",
    lexicon: DataFrame | None = None,
    stopwords: Iterable[str] | None = ENGLISH_STOP_WORDS,
    strict: bool = False,
    mode: str = "error",
    tagger: Tagger | None = None,
) -> MailResult:
    """Run the job on ``path, document`` rows and write the outputs that have a path.

    ``mails`` may bring its own unique ``id``; otherwise the documents are
    numbered.  Only what a requested output needs is computed, and every message is
    parsed once: what is stored, and numbered, is its metadata and its counted words, or
    with a ``tagger``, which needs whole sentences, its text.
    """
    result = MailResult()
    counted = dictionary is not None or corpus is not None
    if metadata is None and not counted:
        return result
    own = [c for c in ("id", "path") if c in mails.columns]
    columns = metadata_columns(F.col("fields")) if metadata is not None else {}
    dropped = PUNCTUATION_WORDS if lexicon is not None else [*PUNCTUATION_WORDS, *(stopwords or ())]
    terms = value_counts(F.filter(mail_words(_contents(strict)), lambda w: ~w.isin(sorted(set(dropped)))))
    parsed = _messages(mails, *own).select(
        *own,
        *(column.alias(name) for name, column in columns.items()),
        *([terms.alias("terms") if tagger is None else _contents(strict).alias("contents")] if counted else []),
    )
    parsed = materialize(parsed, "mails") if "id" in own else dense_index(parsed)
    if metadata is not None:
        write_metadata(parsed.select("id", "path", *columns), metadata, mode=mode)
        result.metadata = parsed.sparkSession.read.parquet(metadata)
    if not counted:
        return result
    if tagger is not None:
        found = tag_mail_tokens(parsed.select("id", "contents"), tagger, lexicon, stopwords=stopwords)
        counts = materialize(word_counts(found), "counts")
    else:
        counts = parsed.select("id", "terms")
    if lexicon is not None and tagger is None:
        counts = materialize(apply_lexicon(counts, lexicon, stopwords), "counts")
    words = build_dictionary(counts, above, below, keep_n, above_base)
    result.dictionary = words
    if dictionary is not None:
        write_dictionary(words, dictionary, mode=mode)
    if corpus is not None:
        result.corpus = materialize(bag_of_words(counts, words), "corpus")
        write_corpus(result.corpus, words.count(), corpus, mode=mode)
    return result
