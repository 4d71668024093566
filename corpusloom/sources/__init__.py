"""Readers: mails and texts, corpus files, stop words."""

from corpusloom.sources.avro import read_avro
from corpusloom.sources.corpus import (
    read_corpus,
    read_corpus_header,
    read_matrix_market,
    read_matrix_market_header,
)
from corpusloom.sources.mail import (
    read_mail_directory,
    read_sequence_file,
    sample_by_hash,
    sample_documents,
)
from corpusloom.sources.words import read_dictionary, read_stopwords

__all__ = [
    "read_avro",
    "read_corpus",
    "read_corpus_header",
    "read_dictionary",
    "read_mail_directory",
    "read_matrix_market",
    "read_matrix_market_header",
    "read_sequence_file",
    "read_stopwords",
    "sample_by_hash",
    "sample_documents",
]
