"""Registered queries of this folder, and their checking SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import langid, pii, records
from corpusloom.llm.common import table
from corpusloom.llm.decontamination import UNITS, contaminated
from corpusloom.llm.encoding import encode_documents
from corpusloom.llm.maintext import extract_main_text
from corpusloom.llm.neardup import near_duplicates
from corpusloom.llm.prefixtrie import prefix_trie
from corpusloom.llm.quality import add_quality
from corpusloom.llm.ranking import ranked_documents
from corpusloom.llm.repeats import remove_repeats
from corpusloom.llm.tokencounts import count_tokens
from corpusloom.llm.toxicity import toxicity

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def fold(key: Column, n: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``n``."""
    return F.crc32(key.cast("string").cast("binary")) % n


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    kinds = F.transform(base, lambda x: x["kind"])
    counts = (
        F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)
    )
    digest = F.sha2(pii.listing(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.listing(F.col("spans")).alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.fit(docs, usable=lambda key: fold(key, 4) != 2)
    held_out = (fold(F.col("doc_id"), 4) == 2).alias("held_out")
    return langid.predict(docs, net).select("doc_id", held_out, "lang_pred", "score", "position_share")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = add_quality(table(spark, sf_dir, "documents"))
    columns = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_lines_removed n_words_left"
    return judged.select("doc_id", *(F.col(f"quality.{c}") for c in columns.split()))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), "doc_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op9_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = records.tokens_by_document(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))
    return index.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity(docs, labels, usable=lambda key: fold(key, 5) != 0)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_personal_data": op1_personal_data,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_token_counts": op7_token_counts,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_binary_records": op9_binary_records,
    "op10_toxicity": op10_toxicity,
    "op11_main_text": op11_main_text,
    "op12_ranked_search": op12_ranked_search,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}

_UNIT_LIST = ", ".join(f"'{u}'" for u in UNITS)

ORACLE: dict[str, str] = {
    "op3_decontamination": rf"""
with texts as (
    select 'd' as side, doc_id as k, text from documents
    union all select 'b', item_id, max(text) from benchmark group by item_id),
raw as (
    select side, k, regexp_extract_all(coalesce(text, ''), '[0-9][0-9.,]*|\p{{L}}[\p{{L}}\p{{M}}\p{{N}}''’]*|[.!?\n]') as t
    from texts),
tokens as (
    select side, k, list_filter(list_transform(range(1, len(t) + 1), lambda i: {{
        'h': case
            when t[i] in ('.', '!', '?', chr(10)) then null
            when t[i] >= '0' and t[i] < ':' then '#number'
            when i > 1 and t[i - 1] >= '0' and t[i - 1] < ':' and lower(t[i]) in ({_UNIT_LIST}) then '#unit'
            when i > 1 and t[i - 1] not in ('!', '?', chr(10)) and not ends_with(t[i - 1], '.')
                and lower(t[i]) <> t[i] then '#name'
            else lower(t[i]) end,
        'v': regexp_replace(lower(t[i]), '[.,]+$', '')}}), lambda x: x.h is not null) as t
    from raw),
split as (
    select side, k, unnest(range(1, len(t) - 4)) as pos,
        unnest(list_transform(range(1, len(t) - 4), lambda i: t[i:i + 5])) as w
    from tokens),
windows as (
    select side, k, pos, list_transform(w, lambda x: x.h) as h, list_transform(w, lambda x: x.v) as v,
        len(list_filter(w, lambda x: x.h[1] = '#')) as n_slots from split),
bench as (
    select *, count(*) over (partition by k) as n_windows from windows where side = 'b' and n_slots <= 3),
hits as (
    select d.k as doc_id, b.k as item, b.pos, b.n_windows, b.h, b.v as own, d.v as here
    from windows d join bench b on d.h = b.h where d.side = 'd'),
pairs as (
    select doc_id, item, count(distinct pos) as n_hits, max(n_windows) as n_windows from hits
    group by doc_id, item having count(distinct pos) >= 0.4 * max(n_windows)),
uses as (
    select doc_id, item, h[o] as kind, own[o] as own, here[o] as here
    from hits semi join pairs using (doc_id, item), (select unnest(range(1, 7)) as o) where h[o][1] = '#'),
filled as (select doc_id, item, kind, own, here, count(*) as n from uses group by all),
best as (
    select doc_id, item, kind, own, max(n) as most, sum(n) as n, bool_or(own <> here) as changed
    from filled group by all),
slots as (
    select doc_id, item, sum(most) / sum(n) as agreement, bool_or(changed) as changed from best group by all)
select doc_id, string_agg(cast(item as varchar), ',' order by cast(item as varchar)) as item_ids, count(*) as n_items,
    cast(sum(n_hits) as bigint) as n_windows, max(n_hits / n_windows) as coverage,
    bool_or(coalesce(changed, false)) as reparameterised
from pairs left join slots using (doc_id, item) where coalesce(agreement, 1.0) >= 0.6
group by doc_id
""",
    "op4_quality_rules": r"""
with docs as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text, text is not null as held,
        coalesce(source, '') as host
    from documents),
split as (
    select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w, string_split(text, chr(10)) as lines from docs),
windows as (
    select r, unnest(range(1, len(w) - 1)) as i,
        unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as win
    from split),
twice as (select r, i from (select *, count(*) over (partition by r, win) as n from windows) where n > 1),
positions as (select distinct r, i + d as p from twice, (select unnest([0, 1, 2]) as d)),
repeats as (select r, count(*) as n_repeat_words from positions group by r),
lines as (
    select r, host, text, line, lower(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) as spaced
    from (select r, host, text, held, unnest(lines) as line from split)
    where held and regexp_matches(line, '[^\x20\x09-\x0D]')),
normal as (select r, host, text, line, trim(regexp_replace(spaced, '[0-9]', '0', 'g')) as norm from lines),
dups as (select r, count(*) - count(distinct line) as n_dup_lines from normal group by r),
usual as (select host, norm from normal group by host, norm having count(distinct text) >= 20),
marked as (
    select n.*, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as line_words, u.norm is not null as is_usual
    from normal n left join usual u using (host, norm)),
voters as (
    select r from marked group by r
    having coalesce(sum(line_words) filter (where not is_usual), 0) >= 0.3 * sum(line_words)),
above as (
    select host, norm from marked semi join voters using (r) where is_usual
    group by host, norm having count(distinct text) >= 20),
gone as (
    select r, count(*) as n_lines_removed, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) as n_words_gone
    from normal semi join above using (host, norm) group by r),
counts as (
    select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
        coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
        coalesce(n_lines_removed, 0) as n_lines_removed, len(w) - coalesce(n_words_gone, 0) as n_words_left
    from split left join repeats using (r) left join dups using (r) left join gone using (r)),
failed as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
    cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
    cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
    not base_failed and n_words_left >= 0.3 * n_words as kept,
    cast(n_lines_removed as bigint) as n_lines_removed, cast(n_words_left as bigint) as n_words_left
from failed
""",
    "op12_ranked_search": r"""
with docs as (
    select row_number() over () as r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
    from documents),
totals as (select count(*) as docs, sum(len(t)) as terms from docs where len(t) > 0),
items as (
    select item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select distinct item_id, text from benchmark)),
uses as (select item_id, term, count(*) as uses from items group by all),
counts as (select r, term, count(*) as tf from (select r, unnest(t) as term from docs) group by all),
held as (select * from counts semi join uses using (term)),
weights as (
    select term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as w
    from held, totals group by term),
norms as (select r, doc_id, 75 + (25 * len(t) * docs) // cast(terms as bigint) as m from docs, totals where len(t) > 0),
scores as (
    select item_id, doc_id, r,
        cast(sum(uses * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
    from uses join held using (term) join weights using (term) join norms using (r)
    group by item_id, doc_id, r),
ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as place
    from scores where score > 0)
select item_id, cast(place as integer) as rank, doc_id, score from ranked where place <= 20
""",
    "op13_prefix_trie": r"""
with own as (
    select conv_id, list({'r': r, 't': t} order by turn nulls first, r, sha256(concat(length(r), ':', r, t))) as own
    from (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t from conversations where conv_id is not null)
    group by conv_id),
coded as (
    select *, list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint)) as codes from own),
crcs as (
    select conv_id, own, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), codes), lambda a, b:
        list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i:
            case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end))) as crc
    from coded),
rebuilt as (
    select c.conv_id, list_concat(coalesce(b.own[1:cast(c.crc % 4 as bigint)], []), c.own[cast(c.crc % 4 as bigint) + 1:]) as p
    from crcs c left join own b on b.conv_id = c.conv_id - c.conv_id % 20),
members as (select conv_id, p[1:d] as node, d, len(p) = d as is_end from (select *, unnest(range(len(p) + 1)) as d from rebuilt)),
nodes as (
    select node, d, min(conv_id) as conv_id, count(*) as n_convs, case when d = 0 then 0 else
            len(regexp_extract_all(node[d].t, '[^\x20\x09-\x0D]+')) end as words,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where is_end), '')) as ends
    from members group by node, d),
children as (select node[1:d - 1] as node, count(*) as n_children from nodes where d > 0 group by all),
whole as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children using (node)),
above as (select node[1:k] as node, n_children, n_convs, words from (select *, unnest(range(d + 1)) as k from whole)),
sums as (
    select node, count(*) filter (where n_children = 0) as n_leaves, cast(sum((n_convs - 1) * words) as bigint) as saved_tokens
    from above group by node)
select w.conv_id, w.d as depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens,
    w.ends as ends_sha256
from whole w join sums using (node) left join nodes p on w.d > 0 and p.node = w.node[1:w.d - 1]
""",
}
