"""Queries of nested, quoted-printable and otherwise encoded mails, and of their Avro table.

Mails are composed from ``conversations`` by SQL that reads the same in Spark and in the
checking engine; the SQL of a query is the text that a reader should find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs
from catalog.oracle_queries import ORACLE as OTHERS
from catalog.spark_queries import Query, joined, message_metadata
from corpusloom import sinks, sources
from corpusloom.functions.mime import body_text, mail_parts
from corpusloom.plans import extract_messages
from corpusloom.runtime import scratch_path

NL, CRLF = inputs.NL, inputs.CRLF


def _lines(*lines: str) -> str:
    """SQL of lines, each an SQL expression, that end with CR LF."""
    return " || ".join(f"{line} || {CRLF}" for line in lines)


_HTML = "'<p>' || text || '</p>'"

# A forwarded message with parts of its own comes first, then related > alternative > two texts,
# the inner boundary being the beginning of the outer one; one in three mails has HTML only.
NESTED_MAIL = _lines(
    "'Subject: nested'", "'Content-Type: multipart/mixed; boundary=\"=_a\"'", "''", "'preamble'", "'--=_a'",
    "'Content-Type: message/rfc822'", "''", "'Subject: forwarded'", "'Content-Type: multipart/mixed; boundary=fwd'", "''",
    "'--fwd'", "''", "'text of the forwarded mail'", "'--fwd--'", "'--=_a'",
    "'Content-Type: multipart/related;'", "chr(9) || 'boundary=\"=_a.b\"'", "''", "'--=_a.b'",
    "'Content-Type: Multipart/Alternative; boundary==_'", "''", "'--=_'",
    "'Content-Type: text/html'", "''", _HTML, "'--=_'",
    "case when conv_id % 3 = 0 then 'Content-Type: image/png' else 'Content-Type: text/plain' end", "''", "text", "'--=_--'",
    "'between'", "'--=_a.b--'", "'--=_a'", "''", "'text after all others'", "'--=_a--'", "'epilogue'",
)
NESTED_TEXT = "case when conv_id % 3 = 0 then 'text after all others' else text end"

_OTHER = "chr(8220) || chr(8364) || chr(8221)"
#: By turn % 3: charset, the escapes of some letters and of what is added, what is added.
_CHARSETS = [
    ("UTF-8", {"é": "=C3=A9", "ä": "=C3=A4", "ñ": "=c3=b1"}, "=E2=80=9C=E2=82=AC=E2=80=9D", _OTHER),
    ("iso-8859-1", {"é": "=E9", "ä": "=E4", "ñ": "=F1"}, "=A7=B6", "chr(167) || chr(182)"),
    ("Windows-1252", {"é": "=E9", "ä": "=E4", "ñ": "=F1"}, "=93=80=94", _OTHER),
]


def _escaped(letters: dict[str, str]) -> str:
    sql = "replace(text, '=', '=3D')"
    for letter, escape in letters.items():
        sql = f"replace({sql}, '{letter}', '{escape}')"
    # a soft break in a line, and blanks before a hard one, which do not count
    return f"replace(replace({sql}, {NL}, ' ' || chr(9) || {CRLF}), ' of ', ' of =' || {CRLF})"


QUOTED_MAIL = (
    _lines("'Content-Type: text/plain; charset=' || case turn % 3 " + " ".join(f"when {i} then '{c[0]}'" for i, c in enumerate(_CHARSETS)) + " end",
           "'Content-Transfer-Encoding: Quoted-Printable'", "''")
    + " || case turn % 3 " + " ".join(f"when {i} then {_escaped(c[1])} || '{c[2]}'" for i, c in enumerate(_CHARSETS)) + f" end || {CRLF} || 'a=ZZ=' || {CRLF} || 'end'"
)
QUOTED_TEXT = (
    f"replace(text, {NL}, {CRLF}) || case turn % 3 " + " ".join(f"when {i} then {c[3]}" for i, c in enumerate(_CHARSETS))
    + f" end || {CRLF} || 'a=ZZend'"
)
def _messages(spark: SparkSession, sf_dir: str, mail: str) -> DataFrame:
    mails = inputs.turns(spark, sf_dir).select(
        F.expr(inputs.CONVERSATION_KEY).alias("id"), F.lit("inbox").alias("path"), F.expr(mail).alias("document")
    )
    return extract_messages(mails)


def bodies(mail: str) -> Query:
    return lambda spark, sf_dir: _messages(spark, sf_dir, mail).select("id", body_text(F.col("fields"), F.col("body")).alias("contents"))


def mail_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and kinds of all parts of the nested mails."""
    parts = mail_parts(F.col("fields"), F.col("body"))
    shown = F.transform(F.filter(parts, lambda p: p["kind"] != "epilogue/none"), lambda p: F.concat_ws(" ", p["path"], p["kind"]))
    return _messages(spark, sf_dir, NESTED_MAIL).select("id", joined(shown, "|").alias("parts"))


def metadata_avro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata table as Avro files, written and read."""
    path = scratch_path(spark, "metadata-avro")
    sinks.write_metadata(message_metadata(spark, sf_dir), path, "avro")
    stored = sources.read_avro(spark, path)
    lists = (joined(c, "|").alias(f"{c}_list") for c in ("to", "cc", "bcc", "references"))
    return stored.select("id", "path", "message_id", "date", F.col("from").alias("sender"), "subject", *lists)


QUERIES: dict[str, Query] = {
    "metadata_avro": metadata_avro,
    "email_body_nested": bodies(NESTED_MAIL),
    "email_body_quoted_printable": bodies(QUOTED_MAIL),
    "mail_tree": mail_tree,
}

_KEY = inputs.CONVERSATION_KEY
ORACLE: dict[str, str] = {
    "metadata_avro": OTHERS["metadata_table"],
    "email_body_nested": f"select {_KEY} as id, {NESTED_TEXT} as contents from conversations",
    "email_body_quoted_printable": f"select {_KEY} as id, {QUOTED_TEXT} as contents from conversations",
    "mail_tree": f"select {_KEY} as id, '1 message/rfc822|2.1.1 text/html|2.1.2 ' || case when conv_id % 3 = 0"
    " then 'image/png' else 'text/plain' end || '|3 text/plain' as parts from conversations",
}
