"""Inputs of the registered queries.

The mail queries need raw messages, which the tables do not hold.  They are
composed from ``conversations`` by SQL expressions that read the same in Spark
and in the checking engine, so both sides start from equal text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.runtime import spread

NL = "chr(10)"
CRLF = "chr(13) || chr(10)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return spread(texts, "id")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "conversations"), "conv_id", "turn")


# --- dirty text: what the cleaning steps look for, appended to real text -------

CONVERSATION_KEY = "conv_id * 100 + turn"

DIRTY_CONVERSATION = (
    "text || case turn % 4"
    f" when 0 then {NL} || ' -----Original Message-----' || {NL} || 'From ' || role"
    f" when 1 then {NL} || '> first ' || role || {NL} || '> second' || {NL} || '>third' || {NL} || 'after'"
    f" when 2 then {CRLF} || '> quoted' || {CRLF} || 'kept' || {NL} || 'Forwarded by ' || role || {NL} || 'end'"
    " else ' see http://site.example/' || conv_id || '?a=b <b>bold</b> =20soft=3D www.shop.example end'"
    " end || ' tail(' || role || ');&more at 8:00, 100,000 items:some,thing; really?! yes...No p.m. 0.1 one.two'"
    " || ' -- [x] {y} ~z_ $5 a|b c*d ' || chr(9) || 'tab#end-of-line' || chr(10)"
)

DIRTY_PAGE = "html || ' ' || url || ' ' || html"


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, text`` of all pages and conversation turns, with marks to clean."""
    page_text = pages(spark, sf_dir).select(
        F.expr("-1 - page_id").alias("id"), F.expr(DIRTY_PAGE).alias("text")
    )
    turn_text = turns(spark, sf_dir).select(
        F.expr(CONVERSATION_KEY).alias("id"), F.expr(DIRTY_CONVERSATION).alias("text")
    )
    return page_text.unionByName(turn_text)


DIRTY_SQL = (
    f"dirty as (select -1 - page_id as id, {DIRTY_PAGE} as text from pages"
    f" union all select {CONVERSATION_KEY} as id, {DIRTY_CONVERSATION} as text from conversations)"
)

# --- raw messages ---------------------------------------------------------------

_WRONG_WEEKDAY = "conv_id % 5 = 4"
_NO_ZONE = "turn % 5 = 3"
_OFFSET = "case conv_id % 4 when 0 then '-0800' when 1 then '+0000' when 2 then '+0530' else 'Z' end"
_CLOCK = (
    "lpad(cast(conv_id % 24 as varchar(9)), 2, '0') || ':' || lpad(cast(turn * 7 % 60 as varchar(9)), 2, '0')"
    " || ':' || lpad(cast((conv_id + turn) % 60 as varchar(9)), 2, '0')"
)
_DAY_SPARK = "date_add(date'1999-01-01', cast(conv_id * 3 + turn as int))"
_DAY_SQL = "(date '1999-01-01' + cast(conv_id * 3 + turn as integer))"

DATE_HEADER = (
    f"date_format(if({_WRONG_WEEKDAY}, date_add({_DAY_SPARK}, 1), {_DAY_SPARK}), 'E')"
    f" || ', ' || date_format({_DAY_SPARK}, 'd MMM yyyy') || ' ' || {_CLOCK} || ' ' || {_OFFSET}"
    f" || if({_NO_ZONE}, '', ' (PST)')"
)
DATE_SQL = (
    f"case when {_WRONG_WEEKDAY} or {_NO_ZONE} then '' else"
    f" strftime({_DAY_SQL}, '%Y-%m-%d') || 'T' || {_CLOCK} || case conv_id % 4"
    " when 0 then '-08:00' when 1 then 'Z' when 2 then '+05:30' else 'Z' end end"
)

# Bodies, by conv_id % 6: plain, plain without a type, HTML, alternative parts with
# preamble and epilogue, nested parts with an attachment, nothing readable.
_PLAIN = DIRTY_CONVERSATION
_HTML = "'<html><p>' || text || '</p></html>'"
_PART = f"{CRLF} || '--'"
MAIL_TYPE = (
    "case conv_id % 6"
    f" when 0 then 'Content-Type: text/plain; charset=us-ascii' || {CRLF}"
    " when 1 then ''"
    f" when 2 then 'content-type: TEXT/HTML' || {CRLF}"
    f" when 3 then 'Content-Type: multipart/alternative;' || {CRLF} || chr(9) || 'boundary=\"=_b.1?\"' || {CRLF}"
    f" when 4 then 'Content-Type: multipart/mixed; boundary=outer' || {CRLF}"
    f" else 'Content-Type: image/png' || {CRLF} end"
)
MAIL_BODY = (
    "case conv_id % 6"
    f" when 0 then {_PLAIN} when 1 then {_PLAIN} when 2 then {_HTML}"
    f" when 3 then 'preamble' || {_PART} || '=_b.1?' || {CRLF} || 'Content-Type: text/html' || {CRLF} || {CRLF}"
    f" || {_HTML} || {_PART} || '=_b.1?' || {CRLF} || {CRLF} || {_PLAIN} || {_PART} || '=_b.1?--' || {CRLF} || 'epilogue'"
    f" when 4 then '--outer' || {CRLF} || 'Content-Type: multipart/alternative; boundary=\"in\"' || {CRLF} || {CRLF}"
    f" || '--in' || {CRLF} || 'Content-Type: text/html; charset=utf-8' || {CRLF} || {CRLF} || {_HTML}"
    f" || {_PART} || 'in--' || {CRLF} || 'between' || {_PART} || 'outer' || {CRLF}"
    f" || 'Content-Type: text/plain' || {CRLF} || 'Content-Disposition: attachment; filename=a.txt' || {CRLF} || {CRLF}"
    f" || 'attached' || {_PART} || 'outer--' || {CRLF}"
    " else 'iVBORw0KGgo=' end"
)
#: The text a reader should find in each of these bodies.
BODY_TEXT_SQL = (
    f"case conv_id % 6 when 0 then {_PLAIN} when 1 then {_PLAIN} when 2 then {_HTML}"
    f" when 3 then {_PLAIN} when 4 then {_HTML} else '' end"
)

_ADDRESS = "role || '.' || conv_id || '@mail.example'"
RAW_MAIL = (
    f"'Message-ID: <' || conv_id || '.' || turn || '@mail.example>' || {CRLF}"
    f" || 'Date: ' || {DATE_HEADER} || {CRLF}"
    f" || case turn % 3 when 0 then 'From: ' || {_ADDRESS}"
    f" when 1 then 'FROM: \"Doe, ' || role || '\" <' || {_ADDRESS} || '>'"
    f" else 'Sender: ' || role || ' <' || {_ADDRESS} || '>' end || {CRLF}"
    f" || 'To: a' || turn || '@one.example, \"Smith, Jo\" <jo@two.example>, ' || {CRLF} || chr(9)"
    " || 'dock <-ropes@three.example>,\"Plain Name\"<p@four.example>,  <bare@five.example>'"
    f" || {CRLF}"
    f" || 'Subject: Turn ' || turn || case when turn % 2 = 1 then {CRLF} || '   of talk ' || conv_id else '' end || {CRLF}"
    f" || case when turn % 2 = 0 then 'Cc: cc' || conv_id || '@one.example' || {CRLF} || 'cc: b.c@two.example (Bo C)' || {CRLF} else '' end"
    f" || case when turn % 4 = 1 then 'Bcc: hidden' || conv_id || '@six.example' || {CRLF} else '' end"
    f" || case when turn > 1 then 'References: <' || conv_id || '.0@x> <' || conv_id || '.1@x>' || {CRLF}"
    f" || 'References: <last@x>' || {CRLF} else '' end"
    f" || 'Mime-Version: 1.0' || {CRLF} || {MAIL_TYPE} || {CRLF} || {MAIL_BODY}"
)


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, path, document``: one raw message per conversation turn."""
    return turns(spark, sf_dir).select(
        F.expr(CONVERSATION_KEY).alias("id"),
        F.expr("'inbox/' || conv_id || '/' || turn").alias("path"),
        F.expr(RAW_MAIL.replace("varchar(9)", "string")).alias("document"),
    )


# --- multiparts inside bodies ----------------------------------------------------

# By turn % 4: two text parts and an attachment; the same with single line feeds
# and a part without an empty line; a boundary that is declared but not used; none.
BROKEN_MULTIPART = (
    "case turn % 4"
    f" when 0 then 'X-Was: mail' || {NL} || 'Content-Type: multipart/mixed;' || {NL} || ' boundary=\"=_(1)+$\"' || {NL} || {NL}"
    f" || '--=_(1)+$' || {NL} || 'Content-Type: text/plain' || {NL} || {NL} || text || {NL}"
    f" || '--=_(1)+$' || {NL} || 'Content-Type: image/png' || {NL} || {NL} || 'iVBORw0KGgo=' || {NL}"
    f" || '--=_(1)+$' || {NL} || 'Content-Type: TEXT/html' || {NL} || {NL} || '<b>' || role || '</b>' || {NL} || '--=_(1)+$--' || {NL}"
    f" when 1 then 'Content-Type: MULTIPART/alternative; boundary=\"b2\"' || {CRLF} || '--b2' || {CRLF}"
    f" || 'Content-Type: text/plain' || {CRLF} || {CRLF} || text || '--b2' || {CRLF} || 'Content-Type: text/plain' || {CRLF} || 'no empty line'"
    f" when 2 then 'Content-Type: multipart/mixed; boundary=\"unused\"' || {NL} || text"
    " else text end"
)
REPAIRED_SQL = (
    "case turn % 4"
    f" when 0 then ' ' || text || {NL} || '  <b>' || role || '</b>' || {NL}"
    " when 1 then ' ' || text || ' '"
    f" when 2 then 'Content-Type: multipart/mixed; boundary=\"unused\"' || {NL} || text"
    " else text end"
)
