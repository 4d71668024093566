"""Nested parts, quoted-printable bodies and charsets, one explicit mail at a time."""

from __future__ import annotations

import quopri

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.headers import SINGLE_BYTE_CHARSETS, decode_words, quoted_printable_text
from corpusloom.functions.mime import body_text, mail_parts
from corpusloom.plans.mail import extract_messages


def read(spark, *mails: str):
    rows = [(i, "p", m.replace("\n", "\r\n") if i % 2 else m) for i, m in enumerate(mails)]
    found = extract_messages(spark.createDataFrame(rows, "id long, path string, document string")).select(
        "id", body_text(F.col("fields"), F.col("body")).alias("text"), mail_parts(F.col("fields"), F.col("body")).alias("parts")
    )
    return [(r["text"], [(p["path"], p["kind"]) for p in r["parts"] if p["kind"] != "epilogue/none"]) for r in found.orderBy("id").collect()]


def part(kind: str, content: str, *more: str) -> str:
    return "\n".join([f"Content-Type: {kind}", *more, "", content])


def several(kind: str, boundary: str, *parts: str) -> str:
    joined = "".join(f"--{boundary}\n{p}\n" for p in parts)
    return f'Content-Type: multipart/{kind}; boundary="{boundary}"\n\n{joined}--{boundary}--\n'


def test_trees(spark):
    plain, page = part("text/plain", "plain"), part("text/html", "<p>page")
    forwarded = part("message/rfc822", several("mixed", "f", part("text/plain", "forwarded")))
    attached = part("text/plain", "attached", "Content-Disposition: attachment; filename=a")
    mails = [
        several("mixed", "a", several("alternative", "b", page, plain), attached),
        several("mixed", "a", forwarded, attached, several("related", "ab", page)),
        several("mixed", "a", several("mixed", "b", several("mixed", "c", several("mixed", "d", plain)))),
        several("mixed", "a", several("mixed", "b", page).replace("--b--\n", "")) + "after",  # b is not closed
        several("mixed", "a", part("text/plain", "Content-Type: multipart/mixed; boundary=z\n\n--z\n\nquoted")),
        'Content-Type: multipart/mixed; boundary="none"\n\nno delimiter at all',
        plain,
    ]
    assert read(spark, *mails) == [
        ("plain", [("1.1", "text/html"), ("1.2", "text/plain"), ("2", "text/plain")]),
        ("<p>page", [("1", "message/rfc822"), ("2", "text/plain"), ("3.1", "text/html")]),
        ("plain", [("1.1.1.1", "text/plain")]),
        ("<p>page\r\n", [("1.1", "text/html")]),
        ("Content-Type: multipart/mixed; boundary=z\n\n--z\n\nquoted", [("1", "text/plain")]),
        ("", []),
        ("plain", [("", "text/plain")]),
    ]


@pytest.mark.parametrize(
    "charset, text",
    [
        ("utf-8", "Grüße – “quoted” 漢字 𐐀 = end"),
        ("ISO-8859-1", "Grüße = café §"),
        ("windows-1252", "“curly” – €5 … naïve"),
        ("windows-1251", "Привет, мир"),
        ("koi8-r", "Привет, мир"),
        ("iso-8859-15", "5 € œuvre"),
        ("iso_8859-7", "Καλημέρα"),
        ("windows-1250", "Zażółć gęślą jaźń"),
    ],
)
def test_quoted_printable_bodies(spark, charset, text):
    body = text + "\n" + text * 4 + "\nlast line"
    raw = quopri.encodestring(body.encode(charset.replace("_", "-"))).decode("ascii")
    mail = f"Content-Type: text/plain; charset={charset}\nContent-Transfer-Encoding: quoted-printable\n\n{raw}"
    assert [t for t, _ in read(spark, mail)] == [body]


def test_odd_quoted_printable(spark):
    rows = [("a =\nb", "utf-8"), ("a=3D=3d  \nx\t", "utf-8"), ("=", "utf-8"), ("=zz=4", "utf-8"), ("", "utf-8"), ("=E9", "big5"), (None, "utf-8"), ("=C3", "utf-8")]
    frame = spark.createDataFrame(rows, "t string, c string")
    got = [r[0] for r in frame.select(quoted_printable_text(F.col("t"), F.col("c"))).collect()]
    assert got == ["a b", "a==\nx", "=", "=zz=4", "", None, None, "�"]


def test_subjects_in_other_charsets(spark):
    words = ["=?windows-1252?Q?=93curly=94_=80?=", "=?koi8-r?B?8NLJ18XU?=", "=?windows-1252?B?gA==?=", "=?x-unknown?Q?a?="]
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").orderBy("i")
    assert [r[0] for r in frame.select(decode_words(F.col("w"))).collect()] == ["“curly” €", "Привет", "€", "=?x-unknown?Q?a?="]


def test_every_charset_is_one(spark):
    for charset in SINGLE_BYTE_CHARSETS:
        assert len(b"a".decode(charset)) == 1
