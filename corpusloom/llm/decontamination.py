r"""Benchmark decontamination by templates.

Texts become templates: numbers, names (capitalised words inside a sentence) and units
(unit words behind a number) are replaced by typed placeholders, everything else is lower
case.  Windows of ``WINDOW`` template tokens are hashed; those of the benchmark are joined
to those of the documents.  A document is a candidate for an item if it holds ``COVERAGE``
of the item's windows or more, in this template or in a second one without names, which
does not depend on capitals.  Its slots are then checked: wherever windows match, a value
of the item must stand for the same value of the document (for ``CONSISTENT`` of its uses),
so that a question with other numbers is caught, and a form that many texts share is not.
Where the whole document does not suffice, every occurrence of the item is judged by itself,
so variants of an item beside it do not hide it.

Everything is DataFrame expressions.  Windows of the benchmark are broadcast if their size
allows it - then documents are not shuffled at all - and joined by a shuffle of hashes
otherwise; windows with fewer than ``LITERALS`` words of their own do not count.  Only
candidates are read a second time, for their slots.

Null texts count as empty.  Items of fewer than ``WINDOW`` tokens, or of placeholders only,
have no windows and match nothing.  Rows of one id count as one document, items of one id as
one item, which every text of it stands for.  Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import broadcast_if_small, let, materialize

WINDOW = 6
LITERALS = 3
COVERAGE = 0.4
CONSISTENT = 0.6

#: Numbers, words (which may hold digits), and the marks that end a sentence.
TOKEN = r"[0-9][0-9.,]*+|\p{L}[\p{L}\p{M}\p{N}'’]*+|[.!?\n]"
NUMBER, NAME, UNIT = -1, -2, -3

# Words that are units behind a number.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles",
    "meter", "meters", "metre", "metres", "g", "kg", "mg", "gram", "grams", "ounce", "ounces",
    "pound", "pounds", "ton", "tons", "ml", "l", "liter", "liters", "litre", "litres", "gallon",
    "gallons", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours",
    "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "degrees",
    "dollar", "dollars", "cent", "cents", "euro", "euros", "mph", "kmh", "hz", "khz", "mhz",
    "w", "kw", "v", "a", "j", "kb", "mb", "gb",
)


def _number(t: Column) -> Column:
    return (t >= "0") & (t < ":")


def _template(raw: Column, values: bool, folded: bool) -> Column:
    """Template hashes of tokens - or structs with the slot values beside them - without marks."""

    def one(t: Column, i: Column) -> Column:
        before, low = F.get(raw, i - 1), F.lower(t)
        opens = before.isNull() | before.isin("!", "?", "\n") | F.endswith(before, F.lit("."))
        kind = (
            F.when(t.isin(".", "!", "?", "\n"), None)
            .when(_number(t), F.lit(NUMBER).cast("long"))
            .when(_number(before) & low.isin(*UNITS), F.lit(UNIT).cast("long"))
            .when(F.lit(not folded) & ~opens & (low != t), F.lit(NAME).cast("long"))
            .otherwise(F.xxhash64(low))
        )
        if not values:
            return kind
        return F.struct(kind.alias("h"), F.regexp_replace(low, "[.,]+$", "").alias("v"))

    return F.filter(F.transform(raw, one), lambda x: (x["h"] if values else x).isNotNull())


def template(text: Column, values: bool = False, folded: bool = False) -> Column:
    """Tokens of a text; the ``folded`` template has no names, and is the same in any case."""
    raw = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return let(raw, lambda r: _template(r, values, folded))


def _window(tokens: Column, i: Column, folded: bool, field: str | None = None) -> Column:
    parts = (F.get(tokens, i + k) for k in range(WINDOW))
    return F.xxhash64(F.lit(folded), *(p if field is None else p[field] for p in parts))


def _starts(tokens: Column) -> Column:
    none = F.lit([]).cast("array<int>")
    return F.when(F.size(tokens) < WINDOW, none).otherwise(F.sequence(F.lit(0), F.size(tokens) - WINDOW))


def passages(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item, passage, text``: the texts of all items, several of one item among them."""
    texts = items.select(F.col(key).alias("item"), F.col(text).alias("text")).distinct()
    return texts.select("item", F.xxhash64(F.col("item").cast("string"), "text").alias("passage"), "text")


def benchmark_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item, passage, folded, n_windows, n_tokens, pos, window, slots`` of all items in both
    templates, stored in the scratch folder.

    ``slots`` lists offset, kind and value of the window's placeholders.
    """

    def slots(tokens: Column, i: Column) -> Column:
        own = F.transform(
            F.sequence(F.lit(0), F.lit(WINDOW - 1)),
            lambda k: F.struct(k.alias("k"), F.get(tokens, i + k)["h"].alias("h"), F.get(tokens, i + k)["v"].alias("v")),
        )
        return F.filter(own, lambda x: x["h"].between(UNIT, NUMBER))

    def windows(tokens: Column, folded: bool) -> Column:
        own = F.transform(
            _starts(tokens),
            lambda i: F.struct(
                i.alias("pos"), _window(tokens, i, folded, "h").alias("window"), slots(tokens, i).alias("slots")
            ),
        )
        counted = F.filter(own, lambda x: F.size(x["slots"]) <= WINDOW - LITERALS)
        return F.struct(F.lit(folded).alias("folded"), F.size(tokens).alias("n_tokens"), counted.alias("w"))

    def listing(folded: bool) -> Column:
        return let(template(F.col("text"), True, folded), lambda t: windows(t, folded))

    both = F.array(listing(False), listing(True))
    listed = passages(items, key, text).select("item", "passage", F.explode(both).alias("t"))
    rows = listed.select("item", "passage", "t.folded", "t.n_tokens", F.size("t.w").alias("n_windows"), F.explode("t.w").alias("x"))
    rows = rows.select("item", "passage", "folded", "n_windows", "n_tokens", "x.pos", "x.window", "x.slots")
    return materialize(rows, "benchmark-windows")


def candidates(docs: DataFrame, windows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, passage, folded`` of documents that hold enough of a passage's windows."""

    def hashed(folded: bool) -> Column:
        # a text's equal windows are one
        tokens = template(F.col(text), folded=folded)
        return F.array_distinct(let(tokens, lambda t: F.transform(_starts(t), lambda i: _window(t, i, folded))))

    held = docs.select(F.col(key).alias("doc"), F.explode(F.concat(hashed(False), hashed(True))).alias("window"))
    keys = windows.select("window", "passage", "folded", "n_windows", "pos")
    hits = held.join(broadcast_if_small(keys), "window")
    pairs = hits.groupBy("doc", "passage", "folded").agg(
        F.count_distinct("pos").alias("n_hits"), F.first("n_windows").alias("n_windows")
    )
    return pairs.where(F.col("n_hits") >= COVERAGE * F.col("n_windows")).select("doc", "passage", "folded")


def window_hits(
    docs: DataFrame, windows: DataFrame, pairs: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every place of a candidate where a window of its passage stands, with ``slots`` of kind,
    ``own`` value of the item and value ``here``; stored in the scratch folder."""
    ids = materialize(pairs.select("doc").distinct(), "candidate-documents")
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    chosen = texts.join(broadcast_if_small(ids), texts["doc"].eqNullSafe(ids["doc"]), "left_semi")

    def placed(folded: bool) -> Column:
        def one(tokens: Column, i: Column) -> Column:
            values = F.transform(F.slice(tokens, i + 1, WINDOW), lambda x: x["v"])
            return F.struct(i.alias("dpos"), _window(tokens, i, folded, "h").alias("window"), values.alias("values"))

        return let(template(F.col("text"), True, folded), lambda t: F.transform(_starts(t), lambda i: one(t, i)))

    held = chosen.select("doc", F.xxhash64("text").alias("copy"), F.explode(F.concat(placed(False), placed(True))).alias("x"))
    held = held.select("doc", "copy", "x.dpos", "x.window", "x.values")
    hits = held.join(broadcast_if_small(windows, windows.drop("slots")), "window")
    same = F.col("h.doc").eqNullSafe(F.col("p.doc"))
    for c in ("passage", "folded"):
        same &= F.col(f"h.{c}") == F.col(f"p.{c}")
    wanted = hits.alias("h").join(broadcast_if_small(pairs).alias("p"), same, "left_semi")
    slots = F.transform(
        "slots", lambda s: F.struct(s["h"].alias("kind"), s["v"].alias("own"), F.get("values", s["k"]).alias("here"))
    )
    return materialize(wanted.withColumn("slots", slots).drop("values", "window"), "benchmark-hits")


PAIR = ["doc", "item", "passage", "folded"]


def judged(hits: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n_windows, n_hits, first, last, agreement, changed`` of groups of hits: how
    consistently slots are filled, and whether a value differs from the item's."""
    groups = hits.groupBy(*keys).agg(
        F.first("n_windows").alias("n_windows"),
        F.count_distinct("pos").alias("n_hits"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
    )
    uses = hits.select(*keys, F.explode("slots").alias("s")).select(*keys, "s.kind", "s.own", "s.here")
    filled = uses.groupBy(*keys, "kind", "own", "here").count()
    best = filled.groupBy(*keys, "kind", "own").agg(
        F.max("count").alias("most"), F.sum("count").alias("uses"), F.max(F.col("own") != F.col("here")).alias("changed")
    )
    slots = best.groupBy(*keys).agg(
        (F.sum("most") / F.sum("uses")).alias("agreement"), F.max("changed").alias("changed")
    )
    same = F.lit(True)
    for c in keys:
        same &= F.col(f"g.{c}").eqNullSafe(F.col(f"s.{c}"))
    return groups.alias("g").join(slots.alias("s"), same, "left").select(
        "g.*", F.coalesce("agreement", F.lit(1.0)).alias("agreement"), F.coalesce("changed", F.lit(False)).alias("changed")
    )


def covered(groups: DataFrame) -> DataFrame:
    enough = (F.col("n_hits") >= COVERAGE * F.col("n_windows")) & (F.col("agreement") >= CONSISTENT)
    return groups.where(enough).select(*PAIR, "n_hits", "n_windows", "changed")


def occurrences(hits: DataFrame) -> DataFrame:
    """``hits`` once for each of two grids that tell the places of a passage in a text apart.

    A place is where the passage would begin.  Copies lie a passage's length apart or more, so
    no cell holds two of them; one that words were put into lies whole in a cell of one grid.
    """
    begins = (F.col("dpos") - F.col("pos")) / F.col("n_tokens")
    grids = hits.withColumn("grid", F.explode(F.array(F.lit(0.0), F.lit(0.5))))
    return grids.withColumn("cell", F.floor(begins + F.col("grid")))


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text"
) -> DataFrame:
    """One row per document that holds benchmark items: ``key, item_ids, n_items, n_windows,
    coverage, reparameterised``; other documents have none.  The figures of an item are those of
    the whole document in the typed template if these suffice, and of its best match otherwise."""
    windows = benchmark_windows(items, item_key, text)
    pairs = materialize(candidates(docs, windows, key, text), "benchmark-candidates")
    hits = window_hits(docs, windows, pairs, key, text)
    whole = covered(judged(hits, PAIR)).withColumn("usual", ~F.col("folded"))
    whole = materialize(whole, "whole-documents")
    settled = whole.select(F.col("doc").alias("__doc"), F.col("passage").alias("__passage")).distinct()
    known = F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("passage") == F.col("__passage"))
    rest = hits.join(broadcast_if_small(settled), known, "left_anti")
    placed = covered(judged(occurrences(rest), [*PAIR, "copy", "grid", "cell"]))
    found = whole.unionByName(placed.withColumn("usual", F.lit(False)))
    share = (F.col("n_hits") / F.col("n_windows")).alias("coverage")
    caught = found.groupBy("doc", "item").agg(
        F.max(F.struct("usual", share, "n_hits", "n_windows", "changed")).alias("x")
    )
    return caught.groupBy(F.col("doc").alias(key)).agg(
        F.array_join(F.sort_array(F.collect_set(F.col("item").cast("string"))), ",").alias("item_ids"),
        F.count("*").alias("n_items"),
        F.sum("x.n_hits").alias("n_windows"),
        F.max("x.coverage").alias("coverage"),
        F.max("x.changed").alias("reparameterised"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold benchmark items."""
    gone = materialize(contaminated(docs, items, key, text=text).select(F.col(key).alias("__gone")), "contaminated")
    return docs.join(broadcast_if_small(gone), docs[key].eqNullSafe(gone["__gone"]), "left_anti")
