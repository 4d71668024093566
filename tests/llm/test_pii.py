"""Personal data against a plain search of the same patterns."""

from __future__ import annotations

import hashlib
import re

import pytest

from corpusloom.llm import pii
from corpusloom.llm.catalog import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    spans = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                spans.append((m.start(), k, m.end()))
    return sorted(spans)


def digest(spans) -> str:
    said = ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in spans)
    return hashlib.sha256(said.encode()).hexdigest()


TEXTS = [
    None,
    "",
    "plain words only",
    "x@y.z a@b.c_d@e.f a@b.c-x@d.e a..b@x.y.",
    "é.a@mail.example.com. 𐐀 user%x+y@a-b.co.uk..more a@b a@.b @c.d a@b..c",
    "\x01a@b.c\x02 \x03 4111 1111\x031111 1111",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1..2.3.4 99.999.1.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111  1111 1111 1111 4111111111111112",
    "79927398713 1234567812345670 0 0 0 0 0 0 0 0 0 0 0 0 0 - 0",
    "+1 (243) 555-5526 +12 34 +1-2-3-4-5-6-7-8-9 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +49 (0) 30 123456.",
    "call (487) 555-7209 or write to jane.doe (at) example (dot) com",
    "9" * 30000 + " " + "1 " * 20000 + "a" * 30000 + "." * 20000 + "@" * 10,
    "a@b" + ".c" * 20000 + " " + "+1(" + "(" * 20000,
    "11.22.33.44 " * 3000,
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[3], "clash", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, start int")
    return docs, pii.find_personal_data(docs).collect()


def test_base_spans_equal_a_plain_search(found):
    docs, rows = found
    assert len(rows) == len(TEXTS) + 1
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append([(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["base"]])
    for i, text in enumerate(TEXTS):
        assert base_spans(text) in by_id[i], text and text[:80]


def test_query_equals_a_plain_search(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op1_personal_data"](spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        spans = base_spans(text)
        assert got[i]["base_sha256"] == digest(spans)
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(s[1] == j for s in spans) for j in range(4)]
        named = {f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in spans}
        assert named <= set(filter(None, got[i]["spans"].split(",")))


def test_reliable_votes_win(spark):
    rows = [(i, f"my visa card is 4111 1111 1111 111{d}") for i, d in enumerate("1" * 60)]
    rows += [(100 + i, f"order id 9{i:02d}3 0000 0000 0001") for i in range(60)]
    rows += [(200 + i, f"please phone me: ({300 + i}) 555-01{i:02d}") for i in range(60)]
    rows += [(300 + i, f"mobile +1 ({300 + i}) 555-01{i:02d}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs).collect()}
    assert all(len(got[i]) == 1 for i in range(60))
    assert all(not [s for s in got[100 + i] if not s["base"]] for i in range(60))
    assert all(got[300 + i] for i in range(60))
    assert sum(bool(got[200 + i]) for i in range(60)) == 60  # no country code, but a telling context


def test_masking(spark):
    rows = [(0, "a x@y.z b 1.2.3.4, +1 (243) 555-5526!", "k"), (1, None, "k"), (2, "clean", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    got = {r["doc_id"]: r["text"] for r in pii.mask_documents(docs).collect()}
    assert got == {0: "a [EMAIL] b [IP], [PHONE]!", 1: None, 2: "clean"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_personal_data(docs).count() == 0
    assert pii.mask_documents(docs).count() == 0
