"""Mail header expressions.

A message is split once into its header block and its body.  The header block
becomes an array of ``struct<name, value>`` in which folded lines are kept
together, and every metadata field is read from that array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let

_LINE_END = r"(?>\r\n|\n|\r)"

# --- fixed values: the accepted date form and the names in it ----------------
#: Zone names: usual abbreviations, offsets written as GMT+1, and ids by region.
ZONE_NAMES = (
    "UTC", "GMT", "UT", "Z", "EST", "EDT", "CST", "CDT", "MST", "MDT", "PST", "PDT", "AKST", "AKDT",
    "HST", "AST", "ADT", "NST", "NDT", "BRT", "ART", "CLT", "COT", "PET", "WET", "WEST", "CET",
    "CEST", "EET", "EEST", "MSK", "BST", "IST", "SAST", "EAT", "CAT", "WAT", "PKT", "NPT", "ICT",
    "WIB", "HKT", "SGT", "PHT", "JST", "KST", "AWST", "ACST", "ACDT", "AEST", "AEDT", "NZST",
    "NZDT",
)
ZONE_REGIONS = (
    "Africa", "America", "Antarctica", "Arctic", "Asia", "Atlantic", "Australia", "Europe",
    "Indian", "Pacific", "Etc", "US", "Canada",
)
_ZONE = (
    rf"(?:{'|'.join(ZONE_NAMES)}|(?:UTC|GMT|UT)[+-]\d{{1,2}}(?::\d\d)?"
    rf"|(?:{'|'.join(ZONE_REGIONS)})(?:/[A-Za-z_+0-9-]+)+)"
)
# weekday, day month year hour:minute:second offset (zone)
DATE_PATTERN = (
    r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun), 0*(\d{1,2}) "
    r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) (\d{4}) "
    r"((?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d) "
    r"(Z|[+-](?:(?:0\d|1[0-7])(?:[0-5]\d)?|18(?:00)?)) "
    rf"\({_ZONE}\)$"
)
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
#: Charsets of one byte a character that mails are decoded from, beside ISO-8859-1.
SINGLE_BYTE_CHARSETS = (
    "windows-1250", "windows-1251", "windows-1252", "windows-1253", "windows-1254", "windows-1257", "iso-8859-2",
    "iso-8859-5", "iso-8859-7", "iso-8859-9", "iso-8859-15", "koi8-r", "koi8-u",
)
# --- end of fixed values -----------------------------------------------------


def split_message(document: Column) -> Column:
    """``[header block, body]``: the header block ends at the first empty line."""
    return F.split(document, rf"^{_LINE_END}|{_LINE_END}{{2}}", 2)


def header_fields(block: Column) -> Column:
    """Header block to ``array<struct<name, value>>``, names in lower case.

    Lines that begin with a blank continue the line before; they stay in the
    value, joined by CR LF, as they were sent.
    """
    lines = F.split(block, rf"{_LINE_END}(?![ \t])")
    return F.transform(
        F.filter(lines, lambda line: line.contains(":")),
        lambda line: F.struct(
            F.lower(F.trim(F.substring_index(line, ":", 1))).alias("name"),
            F.regexp_replace(
                F.regexp_replace(line, F.lit(r"^[^:]*:[ \t\r\n]*"), F.lit("")),
                F.lit(_LINE_END),
                F.lit("\r\n"),
            ).alias("value"),
        ),
    )


def header_values(fields: Column, name: str) -> Column:
    """All values of one header, in order of appearance."""
    return F.transform(
        F.filter(fields, lambda field: field["name"] == name), lambda field: field["value"]
    )


def header_value(fields: Column, name: str) -> Column:
    """First value of one header, or null."""
    return F.get(header_values(fields, name), F.lit(0))


def unfold(value: Column) -> Column:
    """Join the lines of a folded value by one blank."""
    return F.regexp_replace(value, F.lit(rf"{_LINE_END}[ \t]+"), F.lit(" "))


def _high_half(charset: str) -> str:
    """Characters of the bytes 80 to FF in a charset of single bytes; those it lacks stay as they are."""
    return "".join(bytes([i]).decode(charset, "ignore") or chr(i) for i in range(0x80, 0x100))


def known_charset(charset: Column) -> Column:
    return F.coalesce(_decoded(F.lit(b""), charset).isNotNull(), F.lit(False))


def _decoded(raw: Column, charset: Column) -> Column:
    """Bytes as text; null for a charset that is not one of the common ones."""
    name = F.regexp_replace(F.lower(charset), F.lit("[-_ ]"), F.lit(""))
    latin = "".join(map(chr, range(0x80, 0x100)))
    halves = {"iso88591": latin, "latin1": latin} | {c.replace("-", ""): _high_half(c) for c in SINGLE_BYTE_CHARSETS}
    half = F.try_element_at(F.create_map(*(F.lit(x) for pair in halves.items() for x in pair)), name)
    return F.when(name.isin("utf8", "usascii", "ascii"), F.make_valid_utf8(raw.cast("string"))).otherwise(
        F.call_function("translate", F.decode(raw, "ISO-8859-1"), F.lit(latin), half)
    )


def base64_text(encoded: Column, charset: Column) -> Column:
    """Text of a base64 value; null if it is none."""
    return _decoded(F.try_to_binary(F.regexp_replace(encoded, F.lit(r"\s+"), F.lit("")), F.lit("base64")), charset)


def _quoted_text(encoded: Column, charset: Column) -> Column:
    """Text of the quoted form of encoded words: ``_`` for a blank, ``=C3`` for a byte."""
    pieces = F.regexp_extract_all(
        F.replace(encoded, F.lit("_"), F.lit(" ")), F.lit("((?s)=[0-9A-Fa-f]{2}|.)"), F.lit(1)
    )
    raw = F.transform(
        pieces, lambda p: F.when(F.length(p) == 3, F.substring(p, 2, 2)).otherwise(F.hex(p.cast("binary")))
    )
    return _decoded(F.unhex(F.array_join(raw, "")), charset)


def quoted_printable_text(encoded: Column, charset: Column) -> Column:
    """Text of a quoted-printable body; null for an unknown charset.

    A line that ends with ``=`` goes on in the next one, blanks before a line's end do not count,
    and what is no escape stays.
    """
    soft = F.regexp_replace(encoded, F.lit(rf"[ \t]++(?={_LINE_END}|$)"), F.lit(""))
    whole = F.regexp_replace(soft, F.lit(rf"={_LINE_END}"), F.lit(""))
    pieces = F.regexp_extract_all(whole, F.lit("((?:=[0-9A-Fa-f]{2})++|[^=]++|=)"), F.lit(1))

    def text(piece: Column) -> Column:
        escaped = (F.length(piece) > 2) & piece.startswith("=")
        return F.when(escaped, _decoded(F.unhex(F.replace(piece, F.lit("="), F.lit(""))), charset)).otherwise(piece)

    return F.when(known_charset(charset), F.array_join(F.transform(pieces, text), ""))


def decode_words(value: Column) -> Column:
    """Replace encoded words ``=?charset?B or Q?...?=`` by their text; others stay.

    Blanks between two encoded words do not count.
    """
    word = r"=\?[^?\s]+\?[BbQq]\?[^?\s]*\?="
    closed = F.regexp_replace(value, F.lit(rf"({word})\s+(?={word})"), F.lit("$1"))

    def text(piece: Column) -> Column:
        def part(group: int) -> Column:
            return F.regexp_extract(piece, r"^=\?([^?]+)\?([BbQq])\?([^?]*)\?=$", group)

        found = F.when(F.lower(part(2)) == "b", base64_text(part(3), part(1))).otherwise(
            _quoted_text(part(3), part(1))
        )
        return F.when(piece.rlike(rf"^{word}$"), F.coalesce(found, piece)).otherwise(piece)

    pieces = F.split(F.regexp_replace(closed, F.lit(f"({word})"), F.lit("\x01$1\x01")), "\x01")
    return F.when(value.contains("=?"), F.array_join(F.transform(pieces, text), "")).otherwise(value)


def address_list(values: Column) -> Column:
    """Header values to an array of address strings.

    Commas inside quotes, comments or angle brackets do not separate.  A plain
    address stays as it is, a display name is kept in front of ``<address>`` and
    quoted only where it holds special characters.
    """
    joined = unfold(F.array_join(values, ","))
    items = F.regexp_extract_all(
        joined,
        F.lit(r'((?:"[^"\\]*(?:\\.[^"\\]*)*+"|\([^)]*\)|<[^>]*>|[^,"(<]++|["(<])++)'),
        F.lit(1),
    )
    trimmed = F.filter(F.transform(items, lambda a: F.trim(a)), lambda a: a != "")
    return F.transform(trimmed, _written_address)


def _written_address(address: Column) -> Column:
    rules = [
        # address (name) -> name <address>
        (r"^([^\s()<>]+)\s*\(([^)]*)\)$", "$2 <$1>"),
        # <address> -> address
        (r"^<([^>]*)>$", "$1"),
        # "plain name" <address> -> plain name <address>
        (r'^"([^"\\()<>@,;:.\[\]]*)"\s*<', "$1 <"),
        # name with a special character <address> -> "name" <address>
        (r'^([^"<]*[()@,;:.\[\]][^"<]*?)\s*<', '"$1" <'),
        # one blank before <address>
        (r"(\S)\s*(<[^>]*>)$", "$1 $2"),
    ]
    for pattern, replacement in rules:
        address = F.regexp_replace(address, F.lit(pattern), F.lit(replacement))
    return address


def bare_address(address: Column) -> Column:
    """The address inside ``name <address>``, or the whole string."""
    return F.regexp_replace(address, F.lit(r"^.*<([^>]*)>$"), F.lit("$1"))


def sender(fields: Column) -> Column:
    """First address of From, else of Sender, without its name; ``""`` if none."""
    return F.coalesce(
        bare_address(F.get(address_list(header_values(fields, "from")), F.lit(0))),
        bare_address(F.get(address_list(header_values(fields, "sender")), F.lit(0))),
        F.lit(""),
    )


def iso_date(value: Column) -> Column:
    """Rewrite ``Wed, 6 Feb 2002 16:12:51 -0800 (PST)`` as ISO 8601 with its offset.

    The result is a string, so no session time zone takes part.  Any other form,
    and a weekday that does not belong to the date, gives ``""``.
    """

    def part(group: int) -> Column:
        return F.regexp_extract(value, DATE_PATTERN, group)

    first = F.try_to_date(F.concat_ws("-", part(4), month_number(part(3)), F.lit("01")))
    # A 31st of a shorter month is read as its last day.
    wanted = part(2).try_cast("int")
    day = F.date_add(first, F.least(wanted, F.day(F.last_day(first))) - 1)
    offset = part(6)
    written_offset = F.when(
        offset.rlike(r"^(?:Z|[+-]00(?:00)?)$"), F.lit("Z")
    ).otherwise(
        F.concat(
            F.substring(offset, 1, 3),
            F.lit(":"),
            F.when(F.length(offset) == 5, F.substring(offset, 4, 2)).otherwise(F.lit("00")),
        )
    )
    weekday = F.get(F.array(*map(F.lit, WEEKDAYS)), F.dayofweek(day) - 1)
    valid = wanted.between(1, 31) & (weekday == part(1))
    return F.coalesce(
        F.when(valid, F.concat(day.cast("string"), F.lit("T"), part(5), written_offset)),
        F.lit(""),
    )


def month_number(name: Column) -> Column:
    """Two-digit number of an English month abbreviation, ``00`` if unknown."""
    return F.lpad(F.array_position(F.array(*map(F.lit, MONTHS)), name).cast("string"), 2, "0")


def metadata_columns(fields: Column) -> dict[str, Column]:
    """All metadata columns of a message, by name, in the order of the table."""
    return {
        "message_id": F.coalesce(header_value(fields, "message-id"), F.lit("")),
        "date": let(header_value(fields, "date"), iso_date),
        "from": sender(fields),
        "to": address_list(header_values(fields, "to")),
        "cc": address_list(header_values(fields, "cc")),
        "bcc": address_list(header_values(fields, "bcc")),
        "subject": F.coalesce(decode_words(unfold(header_value(fields, "subject"))), F.lit("")),
        "references": header_values(fields, "references"),
    }
