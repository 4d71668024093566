"""Word expressions: breaking text into words and choosing the words that count."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
#: The common English stop list of 33 words.
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they",
    "this", "to", "was", "will", "with",
)

#: Punctuation that never counts as a word of a mail.
PUNCTUATION_WORDS = (
    "", ".", ",", "\u2019", "\u2018", "\u2013", "\u2022", "\u2014", "\uf02d", "\u20ac", "\u2026",
)

#: Word classes (Penn Treebank tags) a mail token may have.
KEPT_TAGS = (
    "FW", "JJ", "NN", "NNP", "NNPS", "NNS", "RB", "RP", "VB", "VBD", "VBG", "VBN", "VBP", "VBZ",
)

#: Shortest word, in UTF-16 units, that the simple tokenizer keeps.
MIN_WORD_LENGTH = 3
# --- end of fixed values ----------------------------------------------------

# A letter outside the basic plane takes two UTF-16 units, so two letters reach
# the minimum length when one of them is such a letter.  Spark's word breaks drop
# a word that begins with such a letter, so this holds for later letters only.
_TERM_SHAPE = r"^(?:\p{L}{3,}|(?=.*[\x{10000}-\x{10FFFF}])\p{L}{2})$"
SENTENCE_END = r"[.!?]+[ \t\n]|\n"
SENTENCE_WORD = r"[\p{L}\p{M}]+(?:'[\p{L}\p{M}]+)*|\p{N}+"
_NUMBER_SHAPE = r"^[\p{N}.,:%&]+$"


def broken_words(text: Column) -> Column:
    """All words of a text in order, lower-cased, by locale word breaks."""
    return F.flatten(F.sentences(F.lower(F.coalesce(text, F.lit(""))), F.lit("en"), F.lit("US")))


def is_term(word: Column) -> Column:
    """Letters only and at least three of them."""
    return word.rlike(_TERM_SHAPE)


def terms(text: Column, stopwords: Iterable[str] = ()) -> Column:
    """Words of a text that are letters only, long enough and not stop words."""
    stop = sorted(set(stopwords))

    def keep(word: Column) -> Column:
        return is_term(word) & ~word.isin(stop) if stop else is_term(word)

    return F.filter(broken_words(text), keep)


def mail_words(text: Column) -> Column:
    """Words of a cleaned mail body; plain numbers are cardinals and left out."""
    return F.filter(broken_words(text), lambda word: ~word.rlike(_NUMBER_SHAPE))


def sentence_words(text: Column) -> Column:
    """Sentences of a text, each an array of its words as written."""
    return F.sentences(text, F.lit("en"), F.lit("US"))


def marked_sentences(text: Column) -> Column:
    """Sentences as stops before white space and line ends mark them, each an array of its words.

    Words are runs of letters, with single apostrophes between them, or runs of digits.  Unlike
    locale breaks this is one plain pattern that other engines can follow exactly.
    """
    pieces = F.split(F.coalesce(text, F.lit("")), SENTENCE_END)
    return F.filter(F.transform(pieces, lambda p: F.regexp_extract_all(p, F.lit(SENTENCE_WORD), F.lit(0))), lambda s: F.size(s) > 0)
