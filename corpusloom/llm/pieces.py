"""Pieces of a SentencePiece vocabulary, and how texts are cut into units.

A text is a space followed by its characters, spaces written as U+2581.  A segmentation's
score is the sum of the scores the file gives its pieces; a character that no piece covers
is spelt in bytes, at the lowest score less ten.  Of equal scores the segmentation of fewer
ids wins, then the one with the longer last piece.

No piece of the vocabulary runs from another character into a space, or holds a line feed
(checked when it is loaded), so the best segmentation of a text is that of its units: a run
of spaces with the word behind it, cut at line feeds.  A unit is named by its text without
the first space; the part behind a line feed is named with it.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"

#: Stands for U+2581 in a text itself, which is spelt in bytes; no valid text holds it.
LITERAL = "\ud800"

UNITS = re.compile(" +[^ ]*")


class Pieces:
    """``score`` and ``id`` by piece, ``byte_ids`` by byte, and ``data`` (bytes) by id."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.data: list[bytes] = [b""] * model.get_piece_size()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value], self.data[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                self.scores[piece] = int(model.get_score(i))
                self.data[i] = piece.replace(SPACE, " ").encode()
                if model.get_score(i) != int(model.get_score(i)):
                    raise ValueError(f"score of {piece!r} is not whole, sums would depend on their order")
                if "\n" in piece or SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"piece {piece!r} reaches across units")
        self.spelt = min(self.scores.values()) - 10


def unit_names(text: str) -> list[str]:
    """Names of the units of a text, in order; an empty text has none."""
    if not text:
        return []
    if text[0] == " " or "  " in text:
        return [u[1:] for u in UNITS.findall(" " + text)]
    return text.split(" ")


def unit_parts(name: str) -> tuple[str, list[str]]:
    """The part before the first line feed, with spaces written as in pieces, and the rest."""
    first, *rest = name.replace(SPACE, LITERAL).split("\n")
    return (SPACE + first).replace(" ", SPACE), rest


def single_spaced(texts: pa.Array) -> np.ndarray:
    """Which texts have units that are their words between single spaces; empty texts have none."""
    other = pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, "  "))
    found = pc.and_(pc.invert(other), pc.greater(pc.binary_length(texts), 0))
    return found.to_numpy(zero_copy_only=False)
