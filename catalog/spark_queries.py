"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog import inputs
from corpusloom import sinks, sources
from corpusloom.functions import cleaning
from corpusloom.functions.arrays import explode_values
from corpusloom.functions.mime import body_text, repair_multipart
from corpusloom.functions.words import ENGLISH_STOP_WORDS, broken_words, is_term, sentence_words
from corpusloom.operators import bagofwords, dictionary, tokens, topics, vectors
from corpusloom.operators.numbering import dense_index
from corpusloom.plans import apply_job, extract_messages, mail_job, mail_metadata, text_job, train_job
from corpusloom.plans.mail import mail_contents
from corpusloom.plans.topics import preprocess
from corpusloom.runtime import drop_path, materialize, scratch_path, store

Query = Callable[[SparkSession, str], DataFrame]

KEEP_N = 1000
VOCABULARY = 10_000
TOPICS = 20
ITERATIONS = 10
SAMPLE = 0.25

#: For files of one text each: no check file beside every one, as two files and their modes cost far more
#: than a short text.  Only folders of one machine have such files, so this says nothing to other stores.
SMALL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def joined(column: str | Column, separator: str = " ") -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.array_join(column.cast("array<string>"), separator)


# --- shared steps -----------------------------------------------------------------


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenize(inputs.documents(spark, sf_dir), "text")


def doc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted words of every document, stored as they are read more than once."""
    return materialize(tokens.word_counts(doc_tokens(spark, sf_dir)), "counts")


def lazy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted words of every document for queries that read them once."""
    return tokens.word_counts(doc_tokens(spark, sf_dir))


def doc_corpus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counts = doc_counts(spark, sf_dir)
    words = dictionary.build_dictionary(counts)
    return bagofwords.bag_of_words(counts, words), words


def arrays_as_text(corpus: DataFrame) -> DataFrame:
    return corpus.select(
        "id",
        joined("words", ",").alias("words"),
        joined(F.transform("counts", lambda c: c.cast("int")), ",").alias("counts"),
    )


# --- tokens and words ---------------------------------------------------------------


def distinct_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    distinct = dictionary.distinct_tokens(doc_tokens(spark, sf_dir))
    return distinct.select(
        "id",
        F.size("tokens").cast("long").alias("n_words"),
        joined(F.array_sort("tokens")).alias("words"),
    )


def simple_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = doc_tokens(spark, sf_dir)
    return found.select("id", F.size("tokens").cast("long").alias("n_tokens"), joined("tokens").alias("tokens"))


def word_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(" ", "html", "url")
    return inputs.pages(spark, sf_dir).select("page_id", joined(broken_words(text)).alias("words"))


def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = inputs.documents(spark, sf_dir).select("id", sentence_words(F.col("text")).alias("sentences"))
    filled = F.filter("sentences", lambda s: F.size(s) > 0)
    return pieces.select(
        "id",
        F.size(F.flatten("sentences")).cast("long").alias("n_words"),
        joined(F.flatten(filled)).alias("words"),
        (F.size(filled) <= F.size(F.flatten("sentences"))).alias("none_empty"),
    )


def sentence_words_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = inputs.documents(spark, sf_dir)
    return texts.select("id", joined(F.flatten(sentence_words(F.col("text")))).alias("words"))


def letter_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        explode_values(inputs.pages(spark, sf_dir), broken_words(F.col("html")), "word")
        .where(is_term(F.col("word")))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def stopword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stopwords")
    spark.range(1).select(F.lit(" ".join(ENGLISH_STOP_WORDS)).alias("value")).write.text(path)
    stopwords = sources.read_stopwords(spark, path)
    return dictionary.without_stopwords(dictionary.term_frequency(lazy_counts(spark, sf_dir)), stopwords)


def stopword_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.tokenize(inputs.documents(spark, sf_dir), "text", ENGLISH_STOP_WORDS)
    return found.select("id", F.size("tokens").cast("long").alias("n_tokens"), joined("tokens").alias("tokens"))


def benchmark_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexicon of the benchmark's words: -ing and -ed forms to stems, -th to determiners."""
    benchmark = inputs.table(spark, sf_dir, "benchmark")
    words = explode_values(benchmark, broken_words(F.col("text")), "surface")
    return words.distinct().select(
        "surface",
        F.regexp_replace("surface", "(ing|ed)$", "").alias("lemma"),
        F.when(F.col("surface").endswith("ing"), "VBG")
        .when(F.col("surface").endswith("ed"), "VBD")
        .when(F.col("surface").endswith("th"), "DT")
        .otherwise("NN")
        .alias("tag"),
    ).where("lemma <> ''")


def lexicon_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.tokenize_mail(
        inputs.documents(spark, sf_dir), "text", benchmark_lexicon(spark, sf_dir)
    )
    return found.select("id", F.size("tokens").cast("long").alias("n_tokens"), joined("tokens").alias("tokens"))


def lexicon_counts(**limits: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        plain = tokens.tokenize_mail(inputs.documents(spark, sf_dir), "text", stopwords=None)
        counts = tokens.apply_lexicon(tokens.word_counts(plain), benchmark_lexicon(spark, sf_dir), **limits)
        return explode_values(counts, "terms", "t", "id").select(
            "id", "t.word", F.col("t.cnt").cast("long").alias("cnt")
        )

    return run


# --- dictionary ------------------------------------------------------------------


def dictionary_query(**options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dictionary.build_dictionary(doc_counts(spark, sf_dir), **options)

    return run


def vocabulary_query(n: int) -> Query:
    return lambda spark, sf_dir: dictionary.vocabulary(lazy_counts(spark, sf_dir), n)


def document_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = inputs.table(spark, sf_dir, "documents").select("source", "doc_id")
    return dense_index(keys, "source", "doc_id", name="number")


def storage_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in storage order are 0 .. n-1, each once."""
    numbered = dense_index(inputs.table(spark, sf_dir, "pages").select("url"), name="number")
    return numbered.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("number").alias("lowest"),
        F.max("number").alias("highest"),
        F.count_distinct("number").alias("n_distinct"),
    )


# --- bags of words ----------------------------------------------------------------


def bow_long(broadcast_limit: int | None = None, hot_rows: int | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        counts = doc_counts(spark, sf_dir)
        words = dictionary.build_dictionary(counts)
        entries = explode_values(counts, "terms", "t", "id").select("id", "t.word", "t.cnt")
        rows = bagofwords.join_words(
            entries, words, broadcast_limit, hot_rows or bagofwords.HOT_WORD_ROWS
        )
        return rows.select("id", "word_id", F.col("cnt").cast("long").alias("cnt"))

    return run


def bow_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays_as_text(doc_corpus(spark, sf_dir)[0])


def bow_keep_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = doc_counts(spark, sf_dir)
    words = dictionary.vocabulary(counts, VOCABULARY)
    return arrays_as_text(bagofwords.bag_of_words(counts, words, keep_empty=True))


def lookup_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = doc_counts(spark, sf_dir)
    words = dictionary.vocabulary(counts, VOCABULARY)
    return arrays_as_text(vectors.from_vectors(vectors.lookup_vectors(counts, words)))


def sparse_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus, words = doc_corpus(spark, sf_dir)
    stored = vectors.to_vectors(corpus, words.count())
    return arrays_as_text(vectors.from_vectors(stored))


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagofwords.corpus_stats(*doc_corpus(spark, sf_dir))


def vocabulary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = dictionary.vocabulary(lazy_counts(spark, sf_dir), VOCABULARY)
    return words.agg(F.count(F.lit(1)).alias("n_words"), F.sum("cnt").alias("n_tokens"))


# --- corpus and dictionary files ----------------------------------------------------


def corpus_file(spark: SparkSession, sf_dir: str) -> str:
    """The corpus as text; what it is made from goes as soon as nothing reads it again."""
    counts, counts_path = store(tokens.word_counts(doc_tokens(spark, sf_dir)), "counts")
    words = dictionary.build_dictionary(counts)
    corpus, corpus_path = store(bagofwords.bag_of_words(counts, words), "corpus")
    drop_path(spark, counts_path)
    path = scratch_path(spark, "corpus-text")
    sinks.write_corpus(corpus, words.count(), path)
    drop_path(spark, corpus_path)
    return path


def corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.text(corpus_file(spark, sf_dir)).withColumnRenamed("value", "line")


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_number, line`` of a text in part files, from 0 on."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    order = lines.withColumn("at", F.monotonically_increasing_id())
    within = Window.partitionBy("file").orderBy("at")
    placed = order.select("file", "value", F.row_number().over(within).alias("n"))
    before = placed.groupBy("file").agg(F.max("n").alias("size"))
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per part file
    starts = before.select("file", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("start"))
    return placed.join(starts, "file").select(
        (F.col("start") + F.col("n") - 1).cast("long").alias("line_number"), F.col("value").alias("line")
    )


def corpus_lines_any_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their numbers; ids are negative, and the header still comes first."""
    corpus, words = doc_corpus(spark, sf_dir)
    moved = materialize(corpus.withColumn("id", F.col("id") - 1_000_000), "corpus")
    path = scratch_path(spark, "corpus-text")
    sinks.write_corpus(moved, words.count(), path)
    return placed_lines(spark, path)


def corpus_foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of another writer: free text in the first line, words of a row in falling order."""
    path = scratch_path(spark, "corpus-foreign")
    back = lambda c: joined(F.reverse(c), ",")
    corpus, words = doc_corpus(spark, sf_dir)
    line = F.concat_ws(";", F.col("id").cast("string"), back("words"), back("counts"))
    rows = materialize(corpus.select(F.col("id").alias("at"), line.alias("value")), "foreign")
    head = [(0, -1, "made by hand; see 1;2;3"), (1, -1, f"{words.count()} {rows.count()}")]
    head = spark.createDataFrame(head, "rank int, at long, value string")
    # sorted ranges, the two lines at the beginning of the first one
    whole = rows.select(F.lit(2).alias("rank"), F.col("at"), "value").unionByName(head)
    whole.orderBy("rank", "at").select("value").write.text(path)
    return arrays_as_text(sources.read_corpus(spark, path))


def corpus_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays_as_text(sources.read_corpus(spark, corpus_file(spark, sf_dir)))


def matrix_market_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus, words = doc_corpus(spark, sf_dir)
    path = scratch_path(spark, "matrix-market")
    sinks.write_matrix_market(materialize(corpus, "corpus"), words.count(), path)
    return arrays_as_text(sources.read_matrix_market(spark, path))


def dictionary_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dictionary-tsv")
    sinks.write_dictionary(dictionary.build_dictionary(doc_counts(spark, sf_dir)), path)
    return sources.read_dictionary(spark, path)


# --- documents as files ---------------------------------------------------------------


def seqfile_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sequence")
    pairs = inputs.documents(spark, sf_dir).select(F.col("id").cast("string"), "text")
    pairs.rdd.map(tuple).saveAsSequenceFile(path)
    return sources.read_sequence_file(spark, path)


def mail_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mail-files")
    mails = inputs.turns(spark, sf_dir).select("conv_id", "turn", "text")
    mails.write.partitionBy("conv_id", "turn").options(**SMALL_FILES).text(path)
    found = sources.read_mail_directory(spark, path)
    return found.select(
        F.regexp_extract("path", r"(conv_id=\d+/turn=\d+)/", 1).alias("path"), "document"
    )


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents")
    return sources.sample_by_hash(docs, F.col("doc_id"), SAMPLE).select("doc_id", "n_chars")


def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample holds rows of the table, each once, and about its share of them."""
    docs = inputs.table(spark, sf_dir, "documents")
    taken = sources.sample_documents(docs, SAMPLE, seed=7).select("doc_id", "n_chars")
    known = docs.select("doc_id", F.col("n_chars").alias("own"))
    n = docs.count()
    spread = 6 * (n * SAMPLE * (1 - SAMPLE)) ** 0.5
    return taken.join(known, "doc_id", "left").agg(
        (F.count("own") == F.count(F.lit(1))).alias("in_table"),
        F.coalesce(F.min(F.col("n_chars") == F.col("own")), F.lit(True)).alias("unchanged"),
        (F.count_distinct("doc_id") == F.count(F.lit(1))).alias("distinct_rows"),
        (F.abs(F.count(F.lit(1)) - n * SAMPLE) <= spread).alias("fair_size"),
    )


# --- cleaning -----------------------------------------------------------------------

CLEANING_STEPS: dict[str, Callable[[Column], Column]] = {
    "clean_quoted_original": cleaning.cut_quoted_original,
    "clean_quoted_lines": cleaning.drop_quoted_lines,
    "clean_markup": cleaning.drop_markup,
    "clean_symbols": cleaning.drop_symbols,
    "clean_brackets": cleaning.brackets_to_commas,
    "clean_embedded_commas": cleaning.space_embedded_commas,
    "clean_sentence_ends": cleaning.end_sentences,
    "clean_embedded_stops": cleaning.space_embedded_stops,
    "clean_text": cleaning.clean_text,
    "clean_quoted_lines_strict": lambda text: cleaning.drop_quoted_lines(text, strict=True),
    "clean_markup_strict": lambda text: cleaning.drop_markup(text, strict=True),
}


def cleaning_query(step: Callable[[Column], Column]) -> Query:
    return lambda spark, sf_dir: inputs.dirty_text(spark, sf_dir).select(
        "id", step(F.col("text")).alias("text")
    )


# --- mails --------------------------------------------------------------------------


def message_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail_metadata(inputs.mails(spark, sf_dir))


def email_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_metadata(spark, sf_dir).select(
        "id", "path", "message_id", F.col("from").alias("sender"), "subject"
    )


def email_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_metadata(spark, sf_dir).select("id", "date")


def email_recipients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_metadata(spark, sf_dir).select(
        "id",
        joined("to", "|").alias("to_list"),
        joined("cc", "|").alias("cc_list"),
        joined("bcc", "|").alias("bcc_list"),
    )


def email_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_metadata(spark, sf_dir).select(
        "id", F.size("references").cast("long").alias("n"), joined("references", "|").alias("values")
    )


def email_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = extract_messages(inputs.mails(spark, sf_dir))
    return messages.select("id", body_text(F.col("fields"), F.col("body")).alias("contents"))


def mime_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.turns(spark, sf_dir).select(
        F.expr(inputs.CONVERSATION_KEY).alias("id"),
        repair_multipart(F.expr(inputs.BROKEN_MULTIPART)).alias("contents"),
    )


def metadata_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metadata")
    sinks.write_metadata(message_metadata(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    lists = (joined(c, "|").alias(f"{c}_list") for c in ("to", "cc", "bcc", "references"))
    return stored.select("id", "path", "message_id", "date", F.col("from").alias("sender"), "subject", *lists)


def email_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail_contents(inputs.mails(spark, sf_dir))


def email_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.tokenize_mail(mail_contents(inputs.mails(spark, sf_dir)))
    return found.select("id", joined("tokens").alias("tokens"))


def mail_outputs(spark: SparkSession, sf_dir: str, numbered: bool = True, **wanted: str):
    mails = inputs.mails(spark, sf_dir)
    return mail_job(mails if numbered else mails.drop("id"), below=2, **wanted)


def email_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mail-corpus")
    mail_outputs(
        spark,
        sf_dir,
        metadata=scratch_path(spark, "mail-metadata"),
        dictionary=scratch_path(spark, "mail-dictionary"),
        corpus=path,
    )
    return spark.read.text(path).withColumnRenamed("value", "line")


def email_job_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails without ids: the corpus with the paths of the metadata in place of the numbers."""
    corpus, metadata = scratch_path(spark, "mail-corpus"), scratch_path(spark, "mail-metadata")
    mail_outputs(spark, sf_dir, numbered=False, metadata=metadata, corpus=corpus)
    paths = spark.read.parquet(metadata).select("id", "path")
    return arrays_as_text(sources.read_corpus(spark, corpus)).join(paths, "id").select("path", "words", "counts")


def email_job_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mail-dictionary")
    mail_outputs(spark, sf_dir, dictionary=path)
    return sources.read_dictionary(spark, path)


# --- topics ---------------------------------------------------------------------------


def doc_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int]:
    counts = doc_counts(spark, sf_dir)
    words = dictionary.vocabulary(counts, VOCABULARY)
    n_words = words.count()
    return vectors.to_vectors(bagofwords.bag_of_words(counts, words), n_words), words, n_words


def saved_model(spark: SparkSession, sf_dir: str, algorithm: str):
    stored, words, n_words = doc_vectors(spark, sf_dir)
    model = topics.train(
        stored, n_words, k=TOPICS, max_iterations=ITERATIONS, algorithm=algorithm
    )
    path = scratch_path(spark, "model")
    topics.save_model(model, path)
    return path, stored, words


def lda_em_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all topics, the weights of a word add up to its number of uses."""
    path, _, words = saved_model(spark, sf_dir, "em")
    table = topics.topic_words(spark, path, words)
    return table.groupBy("word_id", "word").agg(
        F.count(F.lit(1)).alias("n_topics"), F.round(F.sum("weight"), 3).alias("uses")
    )


def lda_online_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows read from the saved model are the cells of the matrix of the model itself."""
    stored, words, n_words = doc_vectors(spark, sf_dir)
    model = topics.train(stored, n_words, k=TOPICS, max_iterations=ITERATIONS, algorithm="online")
    path = scratch_path(spark, "model")
    topics.save_model(model, path)
    cells = model.topicsMatrix().toArray()
    own = spark.createDataFrame(
        [(w, [float(x) for x in row]) for w, row in enumerate(cells)], "word_id int, weights array<double>"
    ).select("word_id", F.posexplode("weights").alias("topic", "own"))
    both = topics.topic_words(spark, path, words).join(own, ["word_id", "topic"])
    totals = own.groupBy("topic").agg(F.sum("own").alias("total"))
    return both.join(totals, "topic").groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_words"),
        F.min(F.abs(F.col("weight") - F.col("own")) <= 1e-9 * F.col("own")).alias("same_weight"),
        F.min(F.abs(F.col("share") - F.col("own") / F.col("total")) <= 1e-9).alias("same_share"),
    )


def same_proportions(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per document: how many proportions there are, whether two results agree in all, their sum."""
    both = topics.exploded_topics(left).join(
        topics.exploded_topics(right).withColumnRenamed("proportion", "other"), ["id", "topic"], "full"
    )
    close = F.coalesce(F.abs(F.col("proportion") - F.col("other")) < 1e-6, F.lit(False))
    return both.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_topics"), F.min(close).alias("same"), F.round(F.sum("proportion"), 6).alias("total")
    )


def lda_doc_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved and loaded EM model gives the proportions of the model in memory."""
    stored, _, n_words = doc_vectors(spark, sf_dir)
    model = topics.train(stored, n_words, k=TOPICS, max_iterations=ITERATIONS, algorithm="em")
    path = scratch_path(spark, "model")
    topics.save_model(model, path)
    loaded = topics.document_topics(topics.load_model(spark, path), stored)
    return same_proportions(topics.document_topics(model, stored), loaded)


def topic_matrix(orient: str) -> Query:
    """Uses of every word, added up over the topics of the written matrix."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, _, _ = saved_model(spark, sf_dir, "em")
        out = scratch_path(spark, "matrix")
        sinks.write_topic_matrix(topics.topic_words(spark, path), out, orient)
        return matrix_uses(spark, out, orient)

    return run


def matrix_uses(spark: SparkSession, path: str, orient: str) -> DataFrame:
    """``word_id, n_topics, uses`` of a matrix file."""
    row, column = ("word_id", "topic") if orient == "words" else ("topic", "word_id")
    cells = placed_lines(spark, path).select(
        F.col("line_number").alias(row), F.posexplode(F.split("line", ",").cast("array<double>")).alias(column, "weight")
    )
    return cells.groupBy(F.col("word_id").cast("int").alias("word_id")).agg(
        F.count_distinct("topic").alias("n_topics"), F.round(F.sum("weight"), 3).alias("uses")
    )


def train_job_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus file to matrix file; the word rows of an EM matrix add up to all tokens."""
    out = scratch_path(spark, "trained")
    train_job(spark, corpus_file(spark, sf_dir), out, k=TOPICS, max_iterations=ITERATIONS)
    weights = F.split("value", ",").cast("array<double>")
    return spark.read.text(out).select(weights.alias("w")).agg(
        F.count(F.lit(1)).alias("n_words"),
        F.round(F.sum(F.aggregate("w", F.lit(0.0), lambda a, b: a + b)), 0).alias("n_tokens"),
    )


def apply_job_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written lines of topic proportions are those of the model, in every document."""
    corpus = corpus_file(spark, sf_dir)
    out, proportions = scratch_path(spark, "trained"), scratch_path(spark, "proportions")
    model = train_job(spark, corpus, out, k=TOPICS, max_iterations=ITERATIONS, algorithm="online")
    apply_job(spark, f"{out}.model", corpus, proportions)
    values = F.split(F.regexp_extract("value", r"\[(.*)\]", 1), ",").cast("array<double>")
    written = spark.read.text(proportions).select(
        F.regexp_extract("value", r"^\((\d+),", 1).cast("long").alias("id"), values.alias("topic_distribution")
    )
    stored = vectors.to_vectors(sources.read_corpus(spark, corpus), model.vocabSize())
    return same_proportions(written, topics.document_topics(model, stored))


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.documents(spark, sf_dir).select(
        "id", F.col("id").cast("string").alias("path"), F.col("text").alias("document")
    )


def text_job_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text job up to training, with stop words from a file: vectors and paths of all documents."""
    path = scratch_path(spark, "stopwords")
    spark.range(1).select(F.lit(" ".join(ENGLISH_STOP_WORDS)).alias("value")).write.text(path)
    ready = preprocess(
        text_documents(spark, sf_dir), fraction=1.0, vocab_size=VOCABULARY, stopwords=sources.read_stopwords(spark, path)
    )
    return arrays_as_text(vectors.from_vectors(ready.vectors)).join(ready.lookup, "id")


def text_job_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text job; uses of every word, from its topics x words matrix."""
    out = scratch_path(spark, "text-job")
    text_job(text_documents(spark, sf_dir), out, fraction=1.0, k=TOPICS, max_iterations=ITERATIONS)
    return matrix_uses(spark, out, "topics")


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loaded online model gives the proportions of the model that was saved."""
    stored, _, n_words = doc_vectors(spark, sf_dir)
    model = topics.train(stored, n_words, k=TOPICS, max_iterations=ITERATIONS, algorithm="online")
    path = scratch_path(spark, "model")
    topics.save_model(model, path)
    loaded = topics.document_topics(topics.load_model(spark, path), stored)
    return same_proportions(topics.document_topics(model, stored), loaded)


QUERIES: dict[str, Query] = {
    # words
    "simple_tokens": simple_tokens,
    "distinct_tokens": distinct_tokens,
    "word_breaks": word_breaks,
    "letter_words": letter_words,
    "sentence_split": sentence_split,
    "sentence_words": sentence_words_in_order,
    "stopword_filter": stopword_filter,
    "stopword_tokens": stopword_tokens,
    "lexicon_tokens": lexicon_tokens,
    "lexicon_counts": lexicon_counts(),
    "lexicon_counts_shuffled": lexicon_counts(lookup_limit=0, broadcast_limit=0, hot_rows=100),
    # dictionary
    "doc_frequency": lambda s, d: dictionary.document_frequency(lazy_counts(s, d)),
    "term_count": lambda s, d: dictionary.term_frequency(lazy_counts(s, d)),
    "dictionary_docs_base": dictionary_query(),
    "dictionary_vocab_base": dictionary_query(above=0.001, above_base="vocab"),
    "dictionary_keep_n": dictionary_query(keep_n=KEEP_N),
    "vocab_top_n": vocabulary_query(VOCABULARY),
    "vocab_all": vocabulary_query(-1),
    "vocabulary_stats": vocabulary_stats,
    "document_numbers": document_numbers,
    "storage_numbers": storage_numbers,
    # bags of words
    "bow_long": bow_long(),
    "bow_long_shuffled": bow_long(broadcast_limit=0, hot_rows=100),
    "bow_arrays": bow_arrays,
    "bow_keep_empty": bow_keep_empty,
    "lookup_vectors": lookup_vectors,
    "sparse_vectors": sparse_vectors,
    "corpus_stats": corpus_stats,
    # files
    "corpus_lines": corpus_lines,
    "corpus_lines_any_id": corpus_lines_any_id,
    "corpus_foreign": corpus_foreign,
    "corpus_roundtrip": corpus_roundtrip,
    "matrix_market_roundtrip": matrix_market_roundtrip,
    "dictionary_tsv": dictionary_tsv,
    "metadata_table": metadata_table,
    "seqfile_roundtrip": seqfile_roundtrip,
    "mail_directory": mail_directory,
    "hash_sample": hash_sample,
    "random_sample": random_sample,
    # cleaning
    **{name: cleaning_query(step) for name, step in CLEANING_STEPS.items()},
    # mails
    "email_metadata": email_metadata,
    "email_dates": email_dates,
    "email_recipients": email_recipients,
    "email_references": email_references,
    "email_body": email_body,
    "mime_repair": mime_repair,
    "email_contents": email_contents,
    "email_tokens": email_tokens,
    "email_job": email_job,
    "email_job_numbered": email_job_numbered,
    "email_job_dictionary": email_job_dictionary,
    # topics
    "lda_em_topics": lda_em_topics,
    "lda_online_topics": lda_online_topics,
    "lda_doc_topics": lda_doc_topics,
    "topic_matrix_words": topic_matrix("words"),
    "topic_matrix_topics": topic_matrix("topics"),
    "model_roundtrip": model_roundtrip,
    "train_job_totals": train_job_totals,
    "apply_job_lines": apply_job_lines,
    "text_job_vectors": text_job_vectors,
    "text_job_matrix": text_job_matrix,
}
