"""Mail body expressions: choosing the text part and repairing broken multiparts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let, without_trailing_empty
from corpusloom.functions.headers import (
    base64_text,
    header_fields,
    header_value,
    quoted_printable_text,
    split_message,
    unfold,
)

# --- fixed values: marks of a multipart that was left inside a body -----------
MULTIPART_BOUNDARY = r'Content-Type: (?i)(?:multipart)/.*;\s*boundary="(.*)"'
TEXT_PART = r"Content-Type: ((?i)(?:text)/)"
END_OF_HEADER = r"\n{2}|\r{2}|(\n\r){2}|(\r\n){2}"
# --- end of fixed values ------------------------------------------------------

_BOUNDARY_PARAMETER = r'(?i);\s*boundary\s*=\s*(?:"([^"]*)"|([^\s;"]+))'
_NESTED = r"(?im)^content-type:\s*multipart/"
_EPILOGUE = "\r\nContent-Type: epilogue/none\r\n\r\n"


def _quoted(literal: Column) -> Column:
    """Regex that matches the text of a column literally."""
    escaped = F.replace(literal, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit("\\Q"), escaped, F.lit("\\E"))


def _boundary(content_type: Column) -> Column:
    return F.concat(
        F.regexp_extract(content_type, _BOUNDARY_PARAMETER, 1),
        F.regexp_extract(content_type, _BOUNDARY_PARAMETER, 2),
    )


def _split_part(part: Column, boundary: Column) -> Column:
    """Split one part at the delimiter lines of a boundary.

    What follows the closing delimiter gets a content type nobody asks for, so
    it is never taken for a text part.
    """
    delimiter = F.concat(F.lit(r"(?:^|(?>\r\n|\n|\r))--"), _quoted(boundary))
    line_rest = F.lit(r"[ \t]*(?=[\r\n]|$)")
    closed = F.regexp_replace(
        part,
        F.concat(delimiter, F.lit("--"), line_rest),
        F.concat(F.lit("\n--"), _replacement(boundary), F.lit(_EPILOGUE)),
    )
    return F.split(closed, F.concat(delimiter, line_rest, F.lit(r"(?>\r\n|\n|\r|$)")))


def _replacement(literal: Column) -> Column:
    """Text of a column, safe as a regex replacement."""
    return F.replace(F.replace(literal, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))


def _part(text: Column, path: Column) -> Column:
    """``struct<path, kind, attached, boundary, content>`` of one part of a multipart body.

    A multipart's content stays as it is, as its parts are still to be taken out of it.
    """

    def described(pieces: Column) -> Column:
        body = F.coalesce(F.get(pieces, F.lit(1)), F.lit(""))
        return let(header_fields(F.get(pieces, F.lit(0))), lambda fields: _described(fields, body, path))

    return let(split_message(text), described)


def _described(fields: Column, body: Column, path: Column) -> Column:
    kind = media_type(fields)
    several = kind.startswith("multipart/")
    # Without a boundary parameter the first delimiter-like line tells it.
    boundary = F.coalesce(
        F.nullif(_boundary(unfold(header_value(fields, "content-type"))), F.lit("")),
        F.nullif(F.regexp_extract(body, r"(?m)^--([^\r\n]*\S)\s*$", 1), F.lit("")),
    )
    return F.struct(
        path.alias("path"),
        kind.alias("kind"),
        _attached(fields).alias("attached"),
        F.when(several, F.coalesce(boundary, F.lit(""))).alias("boundary"),
        F.when(several, body).otherwise(_transferred(fields, body)).alias("content"),
    )


def _attached(fields: Column) -> Column:
    disposition = F.lower(F.coalesce(header_value(fields, "content-disposition"), F.lit("")))
    return F.ltrim(disposition).startswith("attachment")


def _transferred(fields: Column, content: Column) -> Column:
    """Content as it was before its transfer; what cannot be decoded stays."""
    encoding = F.lower(F.trim(F.coalesce(header_value(fields, "content-transfer-encoding"), F.lit(""))))
    declared = F.coalesce(unfold(header_value(fields, "content-type")), F.lit(""))
    charset = F.nullif(F.regexp_extract(declared, r"(?i);\s*charset\s*=\s*\"?([^\s;\"]+)", 1), F.lit(""))
    charset = F.coalesce(charset, F.lit("us-ascii"))
    return (
        F.when(encoding == "base64", F.coalesce(base64_text(content, charset), content))
        .when(encoding == "quoted-printable", F.coalesce(quoted_printable_text(content, charset), content))
        .otherwise(content)
    )


def media_type(fields: Column) -> Column:
    """Lower-case media type of a message or part; plain text when none is given."""
    declared = F.lower(F.trim(F.substring_index(header_value(fields, "content-type"), ";", 1)))
    return F.coalesce(F.nullif(declared, F.lit("")), F.lit("text/plain"))


def _first_content(parts: Column, kind: str) -> Column:
    wanted = F.filter(parts, lambda p: (p["kind"] == kind) & ~p["attached"])
    return F.get(wanted, F.lit(0))["content"]


_PARTS = "array<struct<path:string,kind:string,attached:boolean,boundary:string,content:string>>"


def mail_parts(fields: Column, body: Column) -> Column:
    """All parts of a message that hold no parts themselves, in order, with their place in its tree.

    ``array<struct<path, kind, attached, boundary, content>>``; ``path`` is like ``1.2``: the
    second part of the first part of the message, which is ``""``.  Every multipart is split at
    the boundary that its own header declares, level by level, so a boundary counts for the part
    it belongs to only, and a forwarded message is one part.  Levels are not more than the
    content types of multiparts that the body holds.
    """

    def taken_out(part: Column) -> Column:
        pieces = F.slice(_split_part(part["content"], part["boundary"]), 2, 2_000_000_000)  # without the preamble
        prefix = F.when(part["path"] == "", "").otherwise(F.concat(part["path"], F.lit(".")))
        inner = F.transform(pieces, lambda p, i: _part(p, F.concat(prefix, (i + 1).cast("string"))))
        return F.when(F.coalesce(part["boundary"], F.lit("")) == "", F.array(part).cast(_PARTS)).otherwise(inner.cast(_PARTS))

    whole = F.array(_described(fields, F.coalesce(body, F.lit("")), F.lit(""))).cast(_PARTS)
    levels = F.sequence(F.lit(0), F.regexp_count(F.coalesce(body, F.lit("")), F.lit(_NESTED)))
    return F.aggregate(levels, whole, lambda parts, _: F.flatten(F.transform(parts, taken_out)).cast(_PARTS))


def body_text(fields: Column, body: Column) -> Column:
    """Text of a message: its first plain-text part, else its first HTML part, else ``""``."""
    body = F.coalesce(body, F.lit(""))
    kind = media_type(fields)
    in_parts = let(
        mail_parts(fields, body),
        lambda parts: F.coalesce(_first_content(parts, "text/plain"), _first_content(parts, "text/html"), F.lit("")),
    )
    return (
        F.when(_attached(fields), F.lit(""))
        .when(kind.isin("text/plain", "text/html"), _transferred(fields, body))
        .when(kind.startswith("multipart/"), in_parts)
        .otherwise(F.lit(""))
    )


def repair_multipart(text: Column) -> Column:
    """Take the text parts out of a multipart that its headers did not announce.

    The body is split at every boundary it declares itself.  If that yields one
    part the text stays; else the text parts, each from its first empty line on,
    are joined by a blank and all other parts are dropped.
    """

    def split_at(parts: Column, boundary: Column) -> Column:
        mark = F.concat(_quoted(F.concat(F.lit("--"), boundary)), F.lit(r"(--)?\s*"))
        return F.flatten(
            F.transform(parts, lambda part: without_trailing_empty(F.split(part, mark)))
        )

    def text_of(part: Column) -> Column:
        return F.when(
            part.rlike(TEXT_PART),
            F.coalesce(F.get(F.split(part, END_OF_HEADER, 2), F.lit(1)), F.lit("")),
        ).otherwise(F.lit(""))

    def repaired(parts: Column) -> Column:
        return F.when(F.size(parts) == 1, F.get(parts, F.lit(0))).otherwise(
            F.array_join(F.transform(parts, text_of), " ")
        )

    boundaries = F.regexp_extract_all(text, F.lit(MULTIPART_BOUNDARY), F.lit(1))
    split = F.aggregate(boundaries, F.array(text), split_at)
    # Nearly all bodies declare no boundary; those skip the array work.
    return F.when(text.rlike(MULTIPART_BOUNDARY), let(split, repaired)).otherwise(text)
