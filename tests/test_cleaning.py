from __future__ import annotations

import random

import pytest
import regex as re
from pyspark.sql import functions as F

from corpusloom.functions import cleaning


def run(spark, step, text):
    return spark.createDataFrame([(text,)], "t string").select(step(F.col("t")).alias("r")).first().r


@pytest.mark.parametrize(
    "step, text, want",
    [
        (cleaning.cut_quoted_original, "hi -----Original Message----- x", "hi "),
        (cleaning.cut_quoted_original, "a forwarded  by b", "a "),
        (cleaning.cut_quoted_original, "Forwarded by b", ""),
        (cleaning.cut_quoted_original, "well-known original", "well-known original"),
        (cleaning.drop_quoted_lines, "x\n>a\n>b\n>c\ny", "x\n>b\ny"),
        (cleaning.drop_quoted_lines, "x\r\n> a\r\n\r\ny", "x\ny"),
        (cleaning.drop_markup, "a<b c>d =20e =D0 http://x.y/z www.q r", "a d  e =D0     r"),
        (cleaning.drop_symbols, "a\tb #c -- d-e f$ $g [x]", "a b c  d-e f  g x "),
        (cleaning.brackets_to_commas, "a(b);&c", "a, b, c"),
        (cleaning.space_embedded_commas, "a:b 8:00 100,000 c,d", "a, b 8:00 100,000 c, d"),
        (cleaning.end_sentences, "what?! yes", "what.  yes"),
        (cleaning.space_embedded_stops, "one.two 0.1 p.m. ab...cd", "one. two 0.1 p.m. ab. cd"),
    ],
)
def test_step(spark, step, text, want):
    assert run(spark, step, text) == want


def test_strict_variants(spark):
    assert run(spark, lambda t: cleaning.drop_quoted_lines(t, True), "x\n>a\n>b\n>c\ny") == "x\ny"
    assert run(spark, lambda t: cleaning.drop_markup(t, True), "a=D0b=20c") == "a b c"


def test_chain(spark):
    text = "Hello,world\n> quoted\n<b>Price</b>: $5?!\nsee www.a.b now\n---- Original Message x"
    assert run(spark, cleaning.clean_text, text) == "Hello, world Price ,  5.  see   now "


def test_look_behinds_change_no_result():
    """Trying a run of marks only from its start finds the same matches."""
    rng = random.Random(5)
    pairs = [
        (cleaning.ORIGINAL_MARK, cleaning.ORIGINAL_MARK.replace("(?<!-)", "")),
        (cleaning.QUOTED_LINE, cleaning.QUOTED_LINE.replace(r"(?<![\r\n])", "")),
        (cleaning.SYMBOLS, re.sub(r"\(\?:\(\?<!.*?\)\|\\G\)", "", cleaning.SYMBOLS)),
    ]
    assert all("(?<" in a and "(?<" not in b and "G" not in b for a, b in pairs)
    for _ in range(20_000):
        text = "".join(rng.choice(["-", "-", "\n", "\r", ">", " ", "$", "#", "a", "\t", "original message"]) for _ in range(14))
        for with_it, without in pairs:
            assert re.sub(with_it, "|", text) == re.sub(without, "|", text), text


def test_long_runs_of_marks_take_linear_time(spark):
    run_of = "x" + "-" * 300_000 + "y" + "\n" * 300_000 + "z" + "#" * 300_000 + "." * 300_000
    assert len(run(spark, cleaning.clean_text, run_of)) > 300_000
