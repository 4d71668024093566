"""Queries of the tagger and the lemma rules, and the SQL they are checked against.

The tables bear no word classes, so a rule that looks at a word's form and the word before it
tags all documents; the tagger learns from them and tags all conversation turns.  The rule is
one SQL expression for both engines, as are the lexicon's classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs
from catalog.oracle_queries import STOP
from catalog.spark_queries import Query, benchmark_lexicon, joined
from corpusloom.functions.arrays import explode_values
from corpusloom.functions.words import KEPT_TAGS, PUNCTUATION_WORDS, SENTENCE_END, SENTENCE_WORD, broken_words, marked_sentences
from corpusloom.operators import tokens
from corpusloom.operators.lemmas import ANY_TAG, learn_rules, lemmas
from corpusloom.operators.tagging import LONGEST_ENDING, RARE_USES, Tagger, load_tagger, save_tagger, tag_sentences, train_tagger
from corpusloom.runtime import materialize, scratch_path

DETERMINERS = "'the', 'a', 'an', 'this', 'that', 'der', 'die', 'das', 'le', 'la', 'les', 'el', 'los'"
PREPOSITIONS = "'of', 'in', 'on', 'at', 'to', 'for', 'with', 'by', 'from', 'de', 'du', 'en', 'von'"
COPULAS = "'is', 'are', 'was', 'be', 'est', 'ist'"


def rule_tag(word: str, before: str) -> str:
    """The class of a word by its form and the word before it, null at the start of a sentence."""
    return (
        f"case when {word} >= '0' and {word} < ':' then 'CD'"
        f" when lower({word}) in ({DETERMINERS}) then 'DT' when lower({word}) in ({PREPOSITIONS}) then 'IN'"
        f" when lower({word}) in ({COPULAS}) then 'VBZ'"
        f" when {word} like '%ing' then case when lower({before}) in ({COPULAS}) then 'VBG' else 'NN' end"
        f" when {word} like '%ed' then case when lower({before}) in ({COPULAS}) then 'VBN' else 'VBD' end"
        f" when {word} like '%ly' then 'RB'"
        f" when {word} <> lower({word}) and {before} is not null then 'NNP'"
        f" when lower({before}) in ({DETERMINERS}) then 'NN' when lower({before}) in ({PREPOSITIONS}) then 'NNS'"
        " else 'JJ' end"
    )


#: A word of every form that the rule tells apart; the rule takes all words of a form alike.
FORMS = ["0", "the", "of", "is", "ing", "ed", "ly", "X", "x"]


def word_form(word: str, lower: str) -> str:
    """The place in FORMS of the first form that a word has."""
    return (
        f"case when {word} >= '0' and {word} < ':' then 0"
        f" when {lower} in ({DETERMINERS}) then 1 when {lower} in ({PREPOSITIONS}) then 2 when {lower} in ({COPULAS}) then 3"
        f" when {word} like '%ing' then 4 when {word} like '%ed' then 5 when {word} like '%ly' then 6"
        f" when {word} <> {lower} then 7 else 8 end"
    )


def rule_tags(words: str) -> str:
    """``rule_tag`` of all words of an array: each word is looked at once, then pairs of forms are looked up."""
    quoted = [f"'{w}'" for w in FORMS]
    table = ", ".join(rule_tag(w, b) for w in quoted for b in [*quoted, "null"])
    forms = f"zip_with({words}, transform({words}, w -> lower(w)), (w, l) -> {word_form('w', 'l')})"
    n = len(FORMS)
    looked_up = f"transform(f, (k, i) -> get(array({table}), k * {n + 1} + coalesce(get(f, i - 1), {n})))"
    return f"element_at(transform(array({forms}), f -> {looked_up}), 1)"


def form_tag(word: str) -> str:
    """The class that the lexicon of the benchmark gives a word of this form."""
    return (
        f"case when {word} like '%ing' then 'VBG' when {word} like '%ed' then 'VBD'"
        f" when {word} like '%th' then 'DT' else 'NN' end"
    )


def ruled_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, words, tags`` of the sentences of all documents, tagged by the rule."""
    docs = inputs.documents(spark, sf_dir)
    rows = explode_values(docs, marked_sentences(F.col("text")), "words", "id")
    return rows.withColumn("tags", F.expr(rule_tags("words")))


def trained_tagger(spark: SparkSession, sf_dir: str) -> Tagger:
    return train_tagger(ruled_sentences(spark, sf_dir))


def turn_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.turns(spark, sf_dir).select(F.expr(inputs.CONVERSATION_KEY).alias("id"), "text")


def mail_tags(**limits: int) -> Query:
    """Classes of all words of all turns, by a model that was saved and loaded."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "tagger")
        save_tagger(trained_tagger(spark, sf_dir), path)
        split = turn_texts(spark, sf_dir).select("id", marked_sentences(F.col("text")).alias("sentences"))
        found = tag_sentences(split, load_tagger(spark, path), **limits)
        return found.select(
            "id",
            F.size("sentences").cast("long").alias("n_sentences"),
            joined(F.flatten("sentences")).alias("words"),
            joined(F.flatten("tags")).alias("tags"),
        )

    return run


def lemma_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lemmas of all distinct words of all documents, with a lexicon of the benchmark's words."""
    lexicon = materialize(benchmark_lexicon(spark, sf_dir), "lexicon-rows")
    found = explode_values(inputs.documents(spark, sf_dir), broken_words(F.col("text")), "word").distinct()
    words = found.withColumn("tag", F.expr(form_tag("word")))
    return lemmas(words, lexicon, learn_rules(lexicon))


def tagged_mail_tokens(**limits: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = tokens.tag_mail_tokens(
            turn_texts(spark, sf_dir), trained_tagger(spark, sf_dir), materialize(benchmark_lexicon(spark, sf_dir), "lexicon-rows"),
            "text", sentences=marked_sentences, **limits,
        )
        return found.select("id", F.size("tokens").cast("long").alias("n_tokens"), joined("tokens").alias("tokens"))

    return run


SHUFFLED = {"lookup_limit": 0, "hot_rows": 100}

QUERIES: dict[str, Query] = {
    "mail_tags": mail_tags(),
    "mail_tags_shuffled": mail_tags(**SHUFFLED),
    "lemma_rules": lemma_rules,
    "tagged_mail_tokens": tagged_mail_tokens(),
    "tagged_mail_tokens_shuffled": tagged_mail_tokens(**SHUFFLED, broadcast_limit=0),
}

# --- SQL -------------------------------------------------------------------------------

_SENTENCE_WORD = SENTENCE_WORD.replace("'", "''")


def _sentences(text: str) -> str:
    pieces = f"string_split_regex(coalesce({text}, ''), '{SENTENCE_END}')"
    split = f"list_transform({pieces}, lambda p: regexp_extract_all(p, '{_SENTENCE_WORD}'))"
    return f"list_filter({split}, lambda s: len(s) > 0)"


def _weight(share: str) -> str:
    return f"cast(round(1000 * ln({share})) as bigint)"


def _ending(word: str) -> str:
    return f"case when {word} <> lower({word}) then '^' else '' end || right(lower({word}), n)"


#: Training counts, then the best path by trying all of them word by word.
TAGGED = rf"""
train as (
    select s, list_transform(s, lambda w, i: {rule_tag('w', 's[i - 1]')}) as tags
    from (select unnest({_sentences('text')}) as s from documents)),
uses as (select word, tag, count(*) as n from (select unnest(s) as word, unnest(tags) as tag from train) group by all),
totals as (select tag, sum(n) as total from uses group by tag),
pairs as (select coalesce(tags[i], '') as a, coalesce(tags[i + 1], '') as b
    from (select tags, unnest(range(len(tags) + 1)) as i from train)),
follows as (select a, b, count(*) as n from pairs group by all),
states as (select tag from totals union all select ''),
moves as (
    select x.tag as a, y.tag as b, {_weight('(coalesce(n, 0) + 1) / (sum(coalesce(n, 0) + 1) over (partition by x.tag))')} as w
    from states x cross join states y left join follows f on f.a = x.tag and f.b = y.tag),
lowered as (select lower(word) as word, tag, sum(n) as n from uses group by all),
known as (select word, tag, {_weight('n / total')} as w from lowered join totals using (tag)),
rare as (select word from lowered group by word having sum(n) <= {RARE_USES}),
ends as (
    select {_ending('word')} as ending, tag, sum(uses) as n
    from (select word, tag, n as uses, unnest(range(1, least(length(word), {LONGEST_ENDING}) + 1)) as n
        from uses where lower(word) in (select word from rare)) group by all),
endings as (
    select ending, tag, {_weight('n / sum(n) over (partition by ending) / (total / (select sum(total) from totals))')} as w
    from ends join totals using (tag)),
turns as (select conv_id * 100 + turn as id, {_sentences('text')} as sentences from conversations),
placed as (select id, unnest(sentences) as s, unnest(range(len(sentences))) as sid from turns),
words as (select distinct unnest(s) as word from placed),
tried as (
    select word, n, {_ending('word')} as ending
    from (select word, unnest(range(1, least(length(word), {LONGEST_ENDING}) + 1)) as n from words
        where lower(word) not in (select word from known))),
longest as (select word, arg_max(ending, n) as ending from tried where ending in (select ending from endings) group by word),
entries as (
    select w.word, k.tag, k.w from words w join known k on k.word = lower(w.word)
    union all select word, tag, w from longest join endings using (ending)
    union all select word, tag, 0 from words, totals
        where lower(word) not in (select word from known) and word not in (select word from longest)),
numbers as (select tag, row_number() over (order by tag) as k from totals),
cells as (select id, sid, pos, tag, w from (select id, sid, unnest(s) as word, unnest(range(1, len(s) + 1)) as pos from placed)
    join entries using (word)),
best(id, sid, pos, tag, score, path) as (
    select id, sid, pos, c.tag, m.w + c.w, [c.tag] from cells c join moves m on m.a = '' and m.b = c.tag where pos = 1
    union all
    select c.id, c.sid, c.pos, c.tag, max(b.score + m.w) + any_value(c.w),
        arg_max(list_append(b.path, c.tag), (b.score + m.w) * 1000 - k)
    from best b join cells c on c.id = b.id and c.sid = b.sid and c.pos = b.pos + 1
        join moves m on m.a = b.tag and m.b = c.tag join numbers on numbers.tag = b.tag
    group by c.id, c.sid, c.pos, c.tag),
tagged as (
    select id, sid, any_value(s) as s, arg_max(path, (score + m.w) * 1000 - k) as tags
    from best join placed using (id, sid) join moves m on m.a = best.tag and m.b = '' join numbers on numbers.tag = best.tag
    where pos = len(s) group by id, sid)"""

_LEXICON = rf"""
lexicon as (
    select distinct surface as word, regexp_replace(surface, '(ing|ed)$', '') as lemma, {form_tag('surface')} as tag
    from (select unnest(BREAKS) as surface from benchmark) where regexp_replace(surface, '(ing|ed)$', '') <> ''),
rules as (
    select distinct unnest([tag, '{ANY_TAG}']) as tag, word, lemma,
        len(list_filter(range(1, least(length(word), length(lemma)) + 1), lambda n: word[1:n] = lemma[1:n])) as kept from lexicon),
nodes as (
    select tag, right(word, n) as ending, length(word) - kept as cut, substr(lemma, kept + 1) as added, count(*) as times
    from (select *, unnest(range(length(word) - kept, length(word) + 1)) as n from rules) group by all),
node as (
    select tag, ending, arg_min({{'c': cut, 'a': added}}, {{'n': -times, 'c': cut, 'a': added}}) as rule
    from nodes group by tag, ending),
listed as (
    select w.word, w.tag, coalesce(min(l.lemma) filter (where l.tag = w.tag), min(l.lemma)) as lemma
    from wanted w join lexicon l using (word) group by w.word, w.tag),
candidates as (
    select word, w.tag, node.tag <> '' as own, n, left(word, length(word) - rule.c) || rule.a as lemma
    from (select *, unnest(range(length(word) + 1)) as n from wanted anti join listed using (word, tag)) w
        join node on node.ending = right(word, n) and node.tag in (w.tag, '')),
ruled as (select word, tag, arg_max(lemma, 2 * n + case when own then 1000000 else 0 end) as lemma
    from candidates where lemma <> '' group by word, tag),
lemmas as (
    select word, tag, coalesce(l.lemma, r.lemma, word) as lemma
    from wanted left join listed l using (word, tag) left join ruled r using (word, tag))"""


def _oracle() -> dict[str, str]:
    from catalog.oracle_queries import breaks

    lexicon = _LEXICON.replace("BREAKS", breaks("lower(text)"))
    tags = f"""with recursive {TAGGED}
select t.id, cast(len(sentences) as bigint) as n_sentences, array_to_string(flatten(sentences), ' ') as words,
    coalesce(string_agg(array_to_string(tags, ' '), ' ' order by sid), '') as tags
from turns t left join tagged g using (id) group by t.id, sentences"""
    rules = f"""with wanted as (
    select word, {form_tag('word')} as tag from (select distinct unnest({breaks('lower(text)')}) as word from documents)), {lexicon}
select word, tag, lemma from lemmas"""
    stop = ", ".join([STOP, *(f"'{w}'" for w in PUNCTUATION_WORDS)])
    kept = ", ".join(f"'{t}'" for t in KEPT_TAGS)
    mails = f"""with recursive {TAGGED},
pieces as (select id, sid, lower(unnest(s)) as word, unnest(tags) as tag, unnest(range(len(s))) as pos from tagged),
wanted as (select distinct word, tag from pieces), {lexicon},
kept as (select id, sid, pos, lemma from pieces join lemmas using (word, tag) where tag in ({kept}) and lemma not in ({stop}))
select id, count(lemma) as n_tokens, coalesce(string_agg(lemma, ' ' order by sid, pos), '') as tokens
from turns left join kept using (id) group by id"""
    return {
        "mail_tags": tags,
        "mail_tags_shuffled": tags,
        "lemma_rules": rules,
        "tagged_mail_tokens": mails,
        "tagged_mail_tokens_shuffled": mails,
    }


ORACLE = _oracle()
