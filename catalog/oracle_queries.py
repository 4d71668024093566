"""SQL for the checking engine: the expected result of each registered query.

Its regular expressions have no look-arounds and their ``\\s`` leaves out the
vertical tab, so patterns are spelled accordingly.  Word breaks are written out as
one pattern: runs of letters joined by single marks inside a word, and runs of
digits joined by marks inside a number.
"""

from __future__ import annotations

from catalog import inputs
from catalog.spark_queries import KEEP_N, SAMPLE, TOPICS, VOCABULARY
from corpusloom.functions.words import ENGLISH_STOP_WORDS

_LETTERS = r"[\p{L}\p{M}]+"
_WORD = rf"{_LETTERS}(?:[\p{{Pd}}\p{{Pc}}''\".\x{{ad}}\x{{2027}}]{_LETTERS})*"
_NUMBER = r"\p{N}+(?:[''\",.]\p{N}+)*"
_MIXED = rf"(?:{_WORD}|{_NUMBER})"
# A sign before a number belongs to its token, as does a percent or and-sign after one.
BREAKS = rf"[$#.\p{{Sc}}]{_NUMBER}{_MIXED}*[%&]?|{_MIXED}*{_NUMBER}[%&]|{_MIXED}+"

STOP = ", ".join(f"'{word}'" for word in ENGLISH_STOP_WORDS)


def breaks(text: str) -> str:
    """List of the words of a text that start with a letter or digit."""
    return f"list_filter(regexp_extract_all({text}, '{BREAKS}'), lambda x: regexp_matches(x, '^[\\p{{L}}\\p{{N}}]'))"


def simple(text: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({text}), '{BREAKS}'),"
        " lambda x: regexp_full_match(x, '\\p{L}{3,}'))"
    )


DOCS = f"docs as (select doc_id as id, {simple('text')} as tokens from documents)"
COUNTS = (
    f"{DOCS}, counts as (select id, word, count(*) as cnt from"
    " (select id, unnest(tokens) as word from docs) group by id, word)"
)


def dictionary_cte(
    highest: str = "floor(0.5 * (select count(*) from documents))", below: int = 5, keep: int | None = None
) -> str:
    limit = "" if keep is None else f" where rn <= {keep}"
    return (
        "freq as (select word, count(*) as occurrences from counts group by word),"
        " ranked as (select word, occurrences, row_number() over (order by occurrences desc, word) as rn"
        f" from freq where occurrences >= {below} and occurrences <= {highest}),"
        f" dict as (select cast(rn - 1 as integer) as id, word, occurrences from ranked{limit})"
    )


def vocabulary_cte(n: int | None) -> str:
    limit = "" if n is None else f" where rn <= {n}"
    return (
        "uses as (select word, cast(sum(cnt) as bigint) as cnt from counts group by word),"
        " ranked as (select word, cnt, row_number() over (order by cnt desc, word) as rn from uses),"
        f" vocab as (select cast(rn - 1 as integer) as id, word, cnt from ranked{limit})"
    )


def entries_cte(words: str) -> str:
    return (
        f"entries as (select c.id, w.id as word_id, c.cnt from counts c join {words} w using (word))"
    )


DICTIONARY = f"with {COUNTS}, {dictionary_cte()}"
ENTRIES = f"{DICTIONARY}, {entries_cte('dict')}"
ARRAYS = (
    "string_agg(cast(word_id as varchar), ',' order by word_id) as words,"
    " string_agg(cast(cnt as varchar), ',' order by word_id) as counts"
)
KEEP_EMPTY = (
    f"with {COUNTS}, {vocabulary_cte(VOCABULARY)}, {entries_cte('vocab')}"
    " select d.id, coalesce(e.words, '') as words, coalesce(e.counts, '') as counts from docs d"
    f" left join (select id, {ARRAYS} from entries group by id) e using (id)"
)
CORPUS_SIZE = "(select count(*) from dict) || ' ' || (select count(distinct id) from entries)"
CORPUS_LINES = (
    " select '# comment' as line union all"
    f" select {CORPUS_SIZE} union all"
    " select id || ';' || words || ';' || counts from"
    f" (select id, {ARRAYS} from entries group by id)"
)

# --- cleaning --------------------------------------------------------------------

_S = r"[\t-\r ]"
_NOT_S = r"[^\t-\r ]"
_MARKS = r"\x01-\x1f\"`=%><#_~+*/\\\[\]|{}"
_ORIGINAL = rf"-+{_S}*[Oo]riginal{_S}*[Mm]essage|[Ff]orwarded{_S}+by{_S}+"


def clean_steps(strict: bool = False) -> dict[str, tuple[str, str, str]]:
    escape = "=[0-9A-F]{2}" if strict else r"=\d\d"
    return {
        "clean_quoted_original": (rf"(?s)(?:{_ORIGINAL}).*$", "''", ""),
        "clean_quoted_lines": (r"[\r\n]+>[^\r\n]*[\r\n]+", "chr(10)", "g"),
        "clean_markup": (rf"<[^<]+?>|{escape}|http{_NOT_S}+|www{_NOT_S}+", "' '", "g"),
        "clean_symbols": (rf"{_S}[-{_MARKS}$]+|[-{_MARKS}]+{_S}|[{_MARKS}$]+", "' '", "g"),
        "clean_brackets": (r"[();&]+", "', '", "g"),
        "clean_embedded_commas": (r"([^0-9,:])[,:]+([^0-9])", r"'\1, \2'", "g"),
        "clean_sentence_ends": (r"[?!]+", "'. '", "g"),
        "clean_embedded_stops": (rf"({_NOT_S}[^0-9.])\.+([^0-9 \t\n\r][^.])", r"'\1. \2'", "g"),
    }


def replaced(text: str, name: str, strict: bool = False) -> str:
    pattern, replacement, options = clean_steps(strict)[name]
    options = f", '{options}'" if options else ""
    return f"regexp_replace({text}, '{pattern}', {replacement}{options})"


def cleaned(text: str) -> str:
    for name in clean_steps():
        text = replaced(text, name)
    return text


def clean_query(expression: str) -> str:
    return f"with {inputs.DIRTY_SQL} select id, {expression} as text from dirty"


# --- mails -----------------------------------------------------------------------

KEY = inputs.CONVERSATION_KEY
_ADDRESS = "role || '.' || conv_id || '@mail.example'"
MAIL_TEXT = f"mail as (select {KEY} as id, {cleaned(inputs.BODY_TEXT_SQL)} as text from conversations)"
MAIL_TOKENS = (
    f"{MAIL_TEXT}, docs as (select id, list_filter({breaks('lower(text)')},"
    f" lambda x: not regexp_full_match(x, '[\\p{{N}}.,:%&]+') and x not in ({STOP})) as tokens from mail)"
)
MAIL_COUNTS = (
    f"with {MAIL_TOKENS}, counts as (select id, word, count(*) as cnt from"
    " (select id, unnest(tokens) as word from docs) group by id, word), "
    + dictionary_cte("floor(0.5 * (select count(*) from conversations))", 2)
)
TO_LIST = (
    "'a' || turn || '@one.example|\"Smith, Jo\" <jo@two.example>|dock <-ropes@three.example>"
    "|Plain Name <p@four.example>|bare@five.example'"
)
SENDER = _ADDRESS
MESSAGE_ID = "'<' || conv_id || '.' || turn || '@mail.example>'"
SUBJECT = "'Turn ' || turn || case when turn % 2 = 1 then ' of talk ' || conv_id else '' end"
CC_LIST = "case when turn % 2 = 0 then 'cc' || conv_id || '@one.example|Bo C <b.c@two.example>' else '' end"
BCC_LIST = "case when turn % 4 = 1 then 'hidden' || conv_id || '@six.example' else '' end"
REFERENCES = "case when turn > 1 then '<' || conv_id || '.0@x> <' || conv_id || '.1@x>|<last@x>' else '' end"

# --- lexicon ---------------------------------------------------------------------

LEXICON = (
    "lexicon as (select distinct surface, regexp_replace(surface, '(ing|ed)$', '') as lemma,"
    " case when surface like '%ing' then 'VBG' when surface like '%ed' then 'VBD'"
    " when surface like '%th' then 'DT' else 'NN' end as tag"
    f" from (select unnest({breaks('lower(text)')}) as surface from benchmark)"
    " where regexp_replace(surface, '(ing|ed)$', '') <> '')"
)
LEMMAS = (
    f"{LEXICON}, words as (select doc_id as id, list_filter({breaks('lower(text)')},"
    " lambda x: not regexp_full_match(x, '[\\p{N}.,:%&]+')) as tokens from documents),"
    " placed as (select id, unnest(tokens) as surface, generate_subscripts(tokens, 1) as pos from words),"
    " lemmas as (select p.id, p.pos, coalesce(l.lemma, p.surface) as word from placed p"
    " left join lexicon l using (surface)"
    f" where coalesce(l.tag, 'NN') <> 'DT' and coalesce(l.lemma, p.surface) not in ({STOP}))"
)

VOCABULARY_SQL = f"with {COUNTS}, {vocabulary_cte(VOCABULARY)}"
VOCABULARY_DOCS = (
    f"{VOCABULARY_SQL}, kept as (select distinct c.id from counts c join vocab v using (word))"
)
PROPORTIONS = f"cast({TOPICS} as bigint) as n_topics, true as same, cast(1 as double) as total"
MATRIX_USES = (
    f"{VOCABULARY_SQL} select id as word_id, cast({TOPICS} as bigint) as n_topics, cast(cnt as double) as uses from vocab"
)
_MD5_NUMBER = "cast('0x' || substr(md5(cast({} as varchar)), 1, 8) as bigint)"
SAMPLE_TEST = f"{_MD5_NUMBER} < {int(SAMPLE * 2**32)}"


def _text_job_vectors() -> str:
    docs = f"docs as (select doc_id as id, list_filter({simple('text')}, lambda x: x not in ({STOP})) as tokens"
    return (
        f"with {docs} from documents),"
        " counts as (select id, word, count(*) as cnt from (select id, unnest(tokens) as word from docs) group by id, word),"
        f" {vocabulary_cte(VOCABULARY)}, {entries_cte('vocab')}"
        " select d.id, cast(d.id as varchar) as path, coalesce(e.words, '') as words, coalesce(e.counts, '') as counts"
        f" from docs d left join (select id, {ARRAYS} from entries group by id) e using (id)"
    )


ORACLE: dict[str, str] = {
    "simple_tokens": f"with {DOCS} select id, len(tokens) as n_tokens, array_to_string(tokens, ' ') as tokens from docs",
    "distinct_tokens": f"with {DOCS}, sets as (select id, list_sort(list_distinct(tokens)) as words from docs)"
    " select id, len(words) as n_words, array_to_string(words, ' ') as words from sets",
    "word_breaks": f"select page_id, array_to_string({breaks('''lower(html || ' ' || url)''')}, ' ') as words from pages",
    "letter_words": f"select word, count(*) as cnt from (select unnest({simple('html')}) as word from pages) group by word",
    "sentence_split": f"select doc_id as id, len({breaks('text')}) as n_words, array_to_string({breaks('text')}, ' ') as words,"
    " true as none_empty from documents",
    "random_sample": "select true as in_table, true as unchanged, true as distinct_rows, true as fair_size",
    "sentence_words": f"select doc_id as id, array_to_string({breaks('text')}, ' ') as words from documents",
    "stopword_filter": f"with {COUNTS} select word, cast(sum(cnt) as bigint) as cnt from counts"
    f" where word not in ({STOP}) group by word",
    "stopword_tokens": f"with {DOCS}, kept as (select id, list_filter(tokens, lambda x: x not in ({STOP})) as tokens from docs)"
    " select id, len(tokens) as n_tokens, array_to_string(tokens, ' ') as tokens from kept",
    "lexicon_tokens": f"with {LEMMAS} select w.id, count(l.word) as n_tokens,"
    " coalesce(string_agg(l.word, ' ' order by l.pos), '') as tokens"
    " from words w left join lemmas l using (id) group by w.id",
    "lexicon_counts": f"with {LEMMAS} select id, word, count(*) as cnt from lemmas group by id, word",
    "lexicon_counts_shuffled": f"with {LEMMAS} select id, word, count(*) as cnt from lemmas group by id, word",
    "doc_frequency": f"with {COUNTS} select word, count(*) as occurrences from counts group by word",
    "term_count": f"with {COUNTS} select word, cast(sum(cnt) as bigint) as cnt from counts group by word",
    "dictionary_docs_base": f"{DICTIONARY} select id, word, occurrences from dict",
    "dictionary_vocab_base": f"with {COUNTS}, {dictionary_cte('floor(cast(0.001 as double) * (select count(*) from freq))')}"
    " select id, word, occurrences from dict",
    "dictionary_keep_n": f"with {COUNTS}, {dictionary_cte(keep=KEEP_N)} select id, word, occurrences from dict",
    "vocab_top_n": f"{VOCABULARY_SQL} select id, word, cnt from vocab",
    "vocab_all": f"with {COUNTS}, {vocabulary_cte(None)} select id, word, cnt from vocab",
    "vocabulary_stats": f"{VOCABULARY_SQL} select count(*) as n_words, cast(sum(cnt) as bigint) as n_tokens from vocab",
    "document_numbers": "select row_number() over (order by source, doc_id) - 1 as number, source, doc_id from documents",
    "storage_numbers": "select count(*) as n, cast(0 as bigint) as lowest, count(*) - 1 as highest,"
    " count(*) as n_distinct from pages",
    "bow_long": f"{ENTRIES} select id, word_id, cnt from entries",
    "bow_long_shuffled": f"{ENTRIES} select id, word_id, cnt from entries",
    "bow_arrays": f"{ENTRIES} select id, {ARRAYS} from entries group by id",
    "sparse_vectors": f"{ENTRIES} select id, {ARRAYS} from entries group by id",
    "bow_keep_empty": KEEP_EMPTY,
    "lookup_vectors": KEEP_EMPTY,
    "corpus_stats": f"{ENTRIES} select (select count(*) from dict) as n_words, count(distinct id) as n_docs,"
    " count(*) as n_entries, cast(sum(cnt) as bigint) as n_tokens from entries",
    "corpus_lines": f"{ENTRIES} {CORPUS_LINES}",
    "corpus_lines_any_id": f"{ENTRIES} select cast(0 as bigint) as line_number, '# comment' as line union all"
    f" select cast(1 as bigint), {CORPUS_SIZE} union all"
    " select row_number() over (order by id) + 1, (id - 1000000) || ';' || words || ';' || counts from"
    f" (select id, {ARRAYS} from entries group by id)",
    "corpus_foreign": f"{ENTRIES} select id, {ARRAYS} from entries group by id",
    "corpus_roundtrip": f"{ENTRIES} select id, {ARRAYS} from entries group by id",
    "matrix_market_roundtrip": f"{ENTRIES} select id, {ARRAYS} from entries group by id",
    "dictionary_tsv": f"{DICTIONARY} select id, word, occurrences from dict",
    "metadata_table": f"select {KEY} as id, 'inbox/' || conv_id || '/' || turn as path, {MESSAGE_ID} as message_id,"
    f" {inputs.DATE_SQL} as date, {SENDER} as sender, {SUBJECT} as subject, {TO_LIST} as to_list,"
    f" {CC_LIST} as cc_list, {BCC_LIST} as bcc_list, {REFERENCES} as references_list from conversations",
    "seqfile_roundtrip": "select cast(doc_id as varchar) as path, text as document from documents",
    "mail_directory": "select 'conv_id=' || conv_id || '/turn=' || turn as path, text || chr(10) as document"
    " from conversations",
    "hash_sample": f"select doc_id, n_chars from documents where {SAMPLE_TEST.format('doc_id')}",
    **{name: clean_query(replaced("text", name)) for name in clean_steps()},
    "clean_text": clean_query(cleaned("text")),
    "clean_quoted_lines_strict": clean_query(
        r"regexp_replace(text, '([\r\n])(?:>[^\r\n]*[\r\n]*)+', '\1', 'g')"
    ),
    "clean_markup_strict": clean_query(replaced("text", "clean_markup", strict=True)),
    "email_metadata": f"select {KEY} as id, 'inbox/' || conv_id || '/' || turn as path,"
    f" '<' || conv_id || '.' || turn || '@mail.example>' as message_id, {SENDER} as sender,"
    " 'Turn ' || turn || case when turn % 2 = 1 then ' of talk ' || conv_id else '' end as subject"
    " from conversations",
    "email_dates": f"select {KEY} as id, {inputs.DATE_SQL} as date from conversations",
    "email_recipients": f"select {KEY} as id, {TO_LIST} as to_list,"
    f" {CC_LIST} as cc_list, {BCC_LIST} as bcc_list from conversations",
    "email_references": f"select {KEY} as id, cast(case when turn > 1 then 2 else 0 end as bigint) as n,"
    " case when turn > 1 then '<' || conv_id || '.0@x> <' || conv_id || '.1@x>|<last@x>' else '' end as values"
    " from conversations",
    "email_body": f"select {KEY} as id, {inputs.BODY_TEXT_SQL} as contents from conversations",
    "mime_repair": f"select {KEY} as id, {inputs.REPAIRED_SQL} as contents from conversations",
    "email_contents": f"with {MAIL_TEXT} select id, text as contents from mail",
    "email_tokens": f"with {MAIL_TOKENS} select id, array_to_string(tokens, ' ') as tokens from docs",
    "email_job": f"{MAIL_COUNTS}, {entries_cte('dict')} {CORPUS_LINES}",
    "email_job_numbered": f"{MAIL_COUNTS}, {entries_cte('dict')} select 'inbox/' || conv_id || '/' || turn as path, words, counts"
    f" from (select id, {ARRAYS} from entries group by id) e join conversations on {KEY} = e.id",
    "email_job_dictionary": f"{MAIL_COUNTS} select id, word, occurrences from dict",
    "lda_em_topics": f"{VOCABULARY_SQL} select id as word_id, word, cast({TOPICS} as bigint) as n_topics,"
    " cast(cnt as double) as uses from vocab",
    "lda_online_topics": f"{VOCABULARY_SQL} select cast(topic as integer) as topic, (select count(*) from vocab) as n_words,"
    f" true as same_weight, true as same_share from range({TOPICS}) t(topic)",
    "lda_doc_topics": f"{VOCABULARY_DOCS} select id, {PROPORTIONS} from kept",
    "model_roundtrip": f"{VOCABULARY_DOCS} select id, {PROPORTIONS} from kept",
    "topic_matrix_words": MATRIX_USES,
    "topic_matrix_topics": MATRIX_USES,
    "train_job_totals": f"{ENTRIES} select (select count(*) from dict) as n_words,"
    " cast(sum(cnt) as double) as n_tokens from entries",
    "apply_job_lines": f"{ENTRIES} select id, {PROPORTIONS} from entries group by id",
    "text_job_vectors": _text_job_vectors(),
    "text_job_matrix": MATRIX_USES,
}
