"""Cleaning of mail bodies: quoted text, markup, symbols and sentence marks.

Each step is one regular-expression column; ``clean_text`` chains them in the
order they have to run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: what each step looks for ----------------------------------
# A run of equal marks is only tried from its start, or from the end of the match
# before (the look-behinds): a match that could start inside a run could start at
# its first character too, and a long run would be scanned once per character.
ORIGINAL_MARK = r"(?<!-)-+\s*[Oo]riginal\s*[Mm]essage|[Ff]orwarded\s+by\s+"
QUOTED_LINE = r"(?<![\r\n])[\r\n]+>[^\r\n]*[\r\n]+"
MARKUP = r"<[^<]+?>|=\d\d|http\S+|www\S+"
_MARKS = r"""\x01-\x1f"`=%><#_~+*/\\\[\]|{}"""
SYMBOLS = rf"\s[-{_MARKS}$]+|(?:(?<![-{_MARKS}])|\G)[-{_MARKS}]+\s|[{_MARKS}$]+"
BRACKETS = r"[();&]+"
EMBEDDED_COMMA = r"([^0-9,:])[,:]+([^0-9])"
SENTENCE_END = r"[?!]+"
EMBEDDED_STOP = r"(\S[^0-9.])\.+([^0-9 \t\n\r][^.])"
# --- end of fixed values -----------------------------------------------------

def cut_quoted_original(text: Column) -> Column:
    """Keep what stands before a quoted original or a forwarded message."""
    return F.get(F.split(text, ORIGINAL_MARK, 2), F.lit(0))


def drop_quoted_lines(text: Column, strict: bool = False) -> Column:
    """Replace lines that start with ``>`` by a line end.

    A match takes the line end after the quoted line with it, so of several
    quoted lines in a row every second one stays; ``strict`` removes all.
    """
    if strict:
        return F.regexp_replace(text, F.lit(r"(?<=[\r\n])>[^\r\n]*[\r\n]*"), F.lit(""))
    return F.regexp_replace(text, F.lit(QUOTED_LINE), F.lit("\n"))


def drop_markup(text: Column, strict: bool = False) -> Column:
    """Replace tags, ``=20``-like escapes and URLs by a space.

    Escapes with a hex letter, such as ``=D0``, go only when ``strict``.
    """
    pattern = MARKUP.replace(r"=\d\d", "=[0-9A-F]{2}") if strict else MARKUP
    return F.regexp_replace(text, F.lit(pattern), F.lit(" "))


def drop_symbols(text: Column) -> Column:
    """Replace runs of symbols and control characters by a space."""
    return F.regexp_replace(text, F.lit(SYMBOLS), F.lit(" "))


def brackets_to_commas(text: Column) -> Column:
    """Brackets, semicolons and ampersands separate phrases like a comma."""
    return F.regexp_replace(text, F.lit(BRACKETS), F.lit(", "))


def space_embedded_commas(text: Column) -> Column:
    """``some:thing`` and ``some,thing`` become two words; ``8:00`` stays."""
    return F.regexp_replace(text, F.lit(EMBEDDED_COMMA), F.lit("$1, $2"))


def end_sentences(text: Column) -> Column:
    """Question and exclamation marks end a sentence like a full stop."""
    return F.regexp_replace(text, F.lit(SENTENCE_END), F.lit(". "))


def space_embedded_stops(text: Column) -> Column:
    """``one.two`` becomes two sentences; ``0.1`` and ``p.m.`` stay."""
    return F.regexp_replace(text, F.lit(EMBEDDED_STOP), F.lit("$1. $2"))


def clean_text(text: Column, strict: bool = False) -> Column:
    """All cleaning steps in order."""
    text = cut_quoted_original(text)
    text = drop_quoted_lines(text, strict)
    text = drop_markup(text, strict)
    for step in (
        drop_symbols,
        brackets_to_commas,
        space_embedded_commas,
        end_sentences,
        space_embedded_stops,
    ):
        text = step(text)
    return text
