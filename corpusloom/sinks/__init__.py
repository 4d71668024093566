"""Writers: metadata, dictionaries, corpora, topic matrices and topic proportions."""

from corpusloom.sinks.avro import write_avro
from corpusloom.sinks.corpus import write_corpus, write_matrix_market
from corpusloom.sinks.tables import write_dictionary, write_metadata
from corpusloom.sinks.topics import write_document_topics, write_topic_matrix

__all__ = [
    "write_avro",
    "write_corpus",
    "write_dictionary",
    "write_document_topics",
    "write_matrix_market",
    "write_metadata",
    "write_topic_matrix",
]
