r"""Personal data: base patterns, and weakly supervised labelers that add spans.

Base spans are the leftmost, non-overlapping matches of four kinds (email, ip, card,
phone) that pass their check; they always stay.  The method looks at more candidates:
matches that failed their check, phone numbers without a country code, and addresses
spelt with ``(at)`` and ``(dot)``.  Four labelers vote +1, 0 or -1 on every candidate:

* regex: does the base pattern with its check hold;
* gazetteer: known top-level domains, card issuer ranges, public address ranges, area codes;
* context: telling words shortly before the span;
* shape: lengths and separators that are usual for the kind.

Expectation-maximisation estimates from the votes alone how reliable every labeler is
and how likely each vote pattern marks personal data; a logistic classifier over votes,
kind and shape is trained on these probabilities and decides on the candidates.

Everything that touches texts is DataFrame expressions.  The driver gets one row per
vote pattern - at most 4 kinds x 3^4 votes x 2 shapes = 648, whatever the input - and
fits on them.  Patterns are linear in the text: single-character runs are rewritten first,
so that no pattern nests repetitions.  Positions count code points, ends are exclusive.

Null texts count as empty and hold no spans; repeated rows are searched one by one; an
empty table leaves the labelers untrained, and only base spans stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import let, materialize

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("regex", "gazetteer", "context", "shape")

EM_ROUNDS = 50
FIT_ROUNDS = 300
THRESHOLD = 0.9
CONTEXT_CHARS = 32

#: How labelers are taken to vote on personal data (and, mirrored, on other spans) before the
#: data speak.  This weighs as much as all data do, so labelers that agree with each other on
#: the usual look of a span cannot outvote a check digit.
PRIOR_VOTES = {
    "regex": {1: 0.93, 0: 0.02, -1: 0.05},
    "gazetteer": {1: 0.5, 0: 0.25, -1: 0.25},
    "context": {1: 0.5, 0: 0.45, -1: 0.05},
    "shape": {1: 0.5, 0: 0.25, -1: 0.25},
}

# What the gazetteer and the context labeler know.
TOP_LEVEL_DOMAINS = (
    "com", "org", "net", "edu", "gov", "int", "info", "biz", "io", "dev", "app", "eu", "uk", "us",
    "de", "fr", "es", "it", "nl", "be", "ch", "at", "se", "no", "dk", "fi", "pl", "pt", "ie", "ca",
    "au", "nz", "jp", "cn", "in", "br", "mx", "ar", "za", "ru",
)
CONTEXT_WORDS = {
    "email": "e-?mail|mailto|contact|write to|reach me|correo|courriel|kontakt",
    "ip": r"\bip\b|address|server|host|client|adresse|direcci[oó]n",
    "card": "card|visa|master|amex|credit|debit|karte|carte|tarjeta",
    "phone": r"phone|\btel\b|\btel\.|call|mobile|fax|telefon|t[ée]l[ée]phone|tel[ée]fono",
}
DENYING_WORDS = r"isbn|issn|order|invoice|version|serial|token|hash|\bid\b"

# Marks stand for characters inside prepared copies of a text, one for one.
_SPLIT, _DOT, _GAP, _OTHER = "\x01", "\x02", "\x03", "\x04"
_BLOCK = 256

_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+\x02-]))[A-Za-z0-9._%+\x02-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
_SPELT = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++ ?[(\[]dot[)\]] ?[A-Za-z]{2,}+"
)
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9][0-9\x03]++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_LOCAL = r"(?<![0-9+.)-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"


def _starts(lengths: Column) -> Column:
    """Sums of the lengths before every element; blocks keep long arrays cheap."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, n: a + n)

    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: total(F.slice(lengths, b * _BLOCK + 1, _BLOCK)))
    bases = F.aggregate(
        sums, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n))
    )

    def placed(bases: Column) -> Column:
        return F.transform(
            lengths,
            lambda _, j: F.get(bases, F.floor(j / _BLOCK).cast("int"))
            + total(F.slice(lengths, F.floor(j / _BLOCK).cast("int") * _BLOCK + 1, j % _BLOCK)),
        )

    return let(bases, placed)


def _matches(prepared: Column, pattern: str, text: Column) -> Column:
    """``start, end, value, before`` of every match; prepared has the length of the text."""
    parts = F.split(F.regexp_replace(prepared, f"({pattern})", f"{_SPLIT}$1{_SPLIT}"), _SPLIT)

    def spans(parts: Column) -> Column:
        return let(_starts(F.transform(parts, F.length)), lambda starts: odd(parts, starts))

    def odd(parts: Column, starts: Column) -> Column:
        placed = F.transform(
            parts,
            lambda p, j: F.struct(F.get(starts, j).alias("start"), F.length(p).alias("n"), (j % 2).alias("odd")),
        )
        return F.transform(
            F.filter(placed, lambda x: x["odd"] == 1),
            lambda x: F.struct(
                x["start"].alias("start"),
                (x["start"] + x["n"]).alias("end"),
                F.substring(text, x["start"] + 1, x["n"]).alias("value"),
                F.lower(
                    F.substring(
                        text,
                        F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0)) + 1,
                        F.least(x["start"], F.lit(CONTEXT_CHARS)),
                    )
                ).alias("before"),
            ),
        )

    return let(parts, spans)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def added(i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(i % 2 == 0, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + added(i))
    return total % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    """Whether a match of the base pattern passes the check of its kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    return let(
        _digits(value),
        lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False)
        if kind == "card"
        else F.length(d).between(9, 15),
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(kind: str, x: Column, base: Column) -> list[Column]:
    value, before = x["value"], x["before"]
    n = F.length(_digits(value))
    separated = value.rlike("[ ()-]")
    if kind == "email":
        tld = F.lower(F.regexp_extract(value, "([A-Za-z]+)$", 1))
        known = tld.isin(*TOP_LEVEL_DOMAINS)
        shape = value.rlike("^[A-Za-z0-9]") & (F.length(value) <= 254)
    elif kind == "ip":
        first = F.regexp_extract(value, "^0*([0-9]{1,3})", 1)
        known = base & ~first.isin("", "0", "127") & (F.length(value) >= 7)
        shape = ~value.rlike(r"(?:^|\.)0[0-9]") & base
    elif kind == "card":
        known = _digits(value).rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)")
        shape = n.isin(15, 16)
    else:
        known = _digits(value).rlike("^(?:1[2-9]|[2-9])") | value.rlike(r"^\(?[2-9]")
        shape = n.between(10, 13) & separated
    return [
        _vote(base, ~base).alias("regex"),
        _vote(known, ~known).alias("gazetteer"),
        _vote(before.rlike(CONTEXT_WORDS[kind]), before.rlike(DENYING_WORDS)).alias("context"),
        _vote(shape, ~shape).alias("shape"),
    ]


def _struct(kind: str, x: Column, base: Column) -> Column:
    return F.struct(
        x["start"].alias("start"),
        F.lit(KINDS.index(kind)).alias("kind"),
        x["end"].alias("end"),
        base.alias("base"),
        *_votes(kind, x, base),
        x["value"].rlike("[ ()\\[-]").cast("int").alias("separated"),
    )


def candidates(text: Column) -> Column:
    """Array of all candidate spans of a text, with votes, ordered by start and kind."""

    def found(raw: Column) -> Column:
        return let(F.translate(raw, _SPLIT + _DOT + _GAP, _OTHER * 3), lambda t: listed(raw, t))

    def of(kind: str, matches: Column, guard: Column, base: bool = True) -> Column:
        def judged(x: Column) -> Column:
            if not base:
                return _struct(kind, x, F.lit(False))
            return let(_passes(kind, x["value"]), lambda ok: _struct(kind, x, ok))

        none = F.lit([]).cast(_SPANS)
        spans = F.transform(matches, judged).cast(_SPANS)
        return F.when(guard, spans).otherwise(none)

    def listed(raw: Column, t: Column) -> Column:
        dotted = F.regexp_replace(t, r"\.(?:(?<![A-Za-z0-9-]\.)|(?![A-Za-z0-9-]))", _DOT)
        joined = F.regexp_replace(t, r"[ -](?<=[0-9].)(?=[0-9])", _GAP)
        digits = t.rlike("[0-9]{2}")
        cards = F.filter(
            _matches(joined, _CARD, raw), lambda x: F.length(_digits(x["value"])).between(12, 19)
        )
        found = F.concat(
            of("email", _matches(dotted, _EMAIL, raw), F.contains(t, F.lit("@"))),
            of("ip", _matches(t, _IP, raw), t.rlike("[0-9][.][0-9]")),
            of("card", cards, digits),
            of("phone", _matches(t, _PHONE, raw), F.contains(t, F.lit("+"))),
            of("email", _matches(t, _SPELT, raw), t.rlike(r"at[)\]]"), base=False),
            of("phone", _matches(t, _LOCAL, raw), digits, base=False),
        )
        return let(F.sort_array(found), beside_base)

    def beside_base(spans: Column) -> Column:
        """Without the candidates that overlap a base span, which stays anyway."""

        def clear(base: Column) -> Column:
            apart = lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
            return F.filter(spans, lambda x: x["base"] | apart(x))

        return let(F.filter(spans, lambda x: x["base"]), clear)

    return let(F.coalesce(text, F.lit("")), found)


_SPANS = "array<struct<start:int,kind:int,end:int,base:boolean,{},separated:int>>".format(
    ",".join(f"{x}:int" for x in LABELERS)
)


def _patterns(found: DataFrame, column: str) -> list[tuple[tuple[int, ...], int]]:
    """Counts of (kind, votes, separated): at most 648 rows."""
    key = ["kind", *LABELERS, "separated"]
    spans = found.select(F.explode(column).alias("x")).select(*(F.col(f"x.{k}").alias(k) for k in key))
    rows = spans.groupBy(*key).count().collect()
    return sorted((tuple(r[k] for k in key), r["count"]) for r in rows)


def _expectations(patterns: list[tuple[tuple[int, ...], int]]) -> list[float]:
    """Probability of personal data for every vote pattern, by expectation-maximisation."""
    share = [min(0.95, max(0.05, 0.5 + 0.15 * sum(key[1 : 1 + len(LABELERS)]))) for key, _ in patterns]
    total = sum(n for _, n in patterns)
    for _ in range(EM_ROUNDS):
        prior = [total / 2, total / 2]
        table = [
            [{v: total / 2 * PRIOR_VOTES[x][v if c else -v] for v in (-1, 0, 1)} for x in LABELERS] for c in (0, 1)
        ]
        for (key, count), p in zip(patterns, share):
            for c, weight in ((0, count * (1 - p)), (1, count * p)):
                prior[c] += weight
                for j in range(len(LABELERS)):
                    table[c][j][key[1 + j]] += weight
        logs = [
            [{v: math.log(n / sum(t.values())) for v, n in t.items()} for t in table[c]] for c in (0, 1)
        ]
        base = math.log(prior[1] / prior[0])
        share = [
            1 / (1 + math.exp(-max(-30, min(30, base + sum(
                logs[1][j][key[1 + j]] - logs[0][j][key[1 + j]] for j in range(len(LABELERS))
            )))))
            for key, _ in patterns
        ]
    return share


def _features(key: tuple[int, ...]) -> list[tuple[str, int]]:
    return [("kind", key[0]), *zip(LABELERS, key[1:-1]), ("separated", key[-1])]


def fit(found: DataFrame, column: str = "candidates") -> dict[tuple[str, int], float]:
    """Weights of the span classifier, trained on all candidates of ``found``."""
    patterns = _patterns(found, column)
    if not patterns:
        return {}
    share = _expectations(patterns)
    total = sum(n for _, n in patterns)
    weights = {f: 0.0 for key, _ in patterns for f in _features(key)}
    for _ in range(FIT_ROUNDS):
        slope = {f: 1e-3 * w for f, w in weights.items()}
        for (key, count), p in zip(patterns, share):
            own = _features(key)
            guess = 1 / (1 + math.exp(-max(-30, min(30, sum(weights[f] for f in own)))))
            for f in own:
                slope[f] += count / total * (guess - p)
        for f in weights:
            weights[f] -= 2.0 * slope[f]
    return weights


def accepted(spans: Column, weights: dict[tuple[str, int], float], threshold: float = THRESHOLD) -> Column:
    """Base spans and the candidates that the classifier adds beside them, in order."""
    names = ("kind", *LABELERS, "separated")

    def score(x: Column) -> Column:
        total = F.lit(0.0)
        for name in names:
            for (own, value), weight in sorted(weights.items()):
                if own == name:
                    total = total + F.when(x[name] == value, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    if not weights:
        return F.filter(spans, lambda x: x["base"])
    return F.filter(spans, lambda x: x["base"] | (score(x) >= threshold))


def listing(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"], x["end"])), ","
    )


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans`` of every row; spans hold ``start, kind, end, base`` and the votes."""
    found = materialize(docs.select(F.col(key), candidates(F.col(text)).alias("candidates")), "pii-candidates")
    return found.select(key, accepted(F.col("candidates"), fit(found)).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its kind in brackets."""
    name = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def joined(a: Column, x: Column) -> Column:
        last = F.element_at(a, -1)
        grown = F.struct(last["start"], F.greatest(last["end"], x["end"]).alias("end"), last["kind"])
        own = F.struct(x["start"], x["end"], x["kind"])
        return F.when(x["start"] < last["end"], F.concat(F.slice(a, 1, F.size(a) - 1), F.array(grown))).otherwise(
            F.concat(a, F.array(own))
        )

    first = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("kind")))
    runs = F.aggregate(spans.cast(_SPANS), first, joined)

    def pieces(runs: Column) -> Column:
        def piece(x: Column, j: Column) -> Column:
            after = F.coalesce(F.get(runs, j + 1)["start"], F.length(text))
            gap = F.substring(text, x["end"] + 1, after - x["end"])
            return F.concat(F.when(j > 0, F.get(name, x["kind"])).otherwise(F.lit("")), gap)

        return F.array_join(F.transform(runs, piece), "")

    return F.when(F.size(spans) == 0, text).otherwise(let(runs, pieces))


def mask_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text`` masked; null texts stay null."""
    found = materialize(docs.select(candidates(F.col(text)).alias("candidates")), "pii-candidates")
    weights = fit(found)
    spans = accepted(candidates(F.col(text)), weights)
    return docs.withColumn(text, F.when(F.col(text).isNotNull(), let(spans, lambda s: masked(F.col(text), s))))
