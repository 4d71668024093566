"""The corpus pipeline: documents become token ids, stage by stage.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept, and is
stored as Parquet before the next one reads it, so a lost executor costs the running stage's
tasks only.  All but the last return the columns of ``documents``.

* quality: rejected documents go, frequent lines of a host are cut from the others;
* near_dedup: of every class of near duplicates the document of the lowest id stays;
* decontamination: documents that hold benchmark items go;
* pii: personal data are replaced by their kind in brackets;
* encoding: the ids of every text.

Null texts fail the quality rules.  ``n_chars``, where it is there, follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, table
from corpusloom.llm.decontamination import without_contaminated
from corpusloom.llm.encoding import encode_documents
from corpusloom.llm.neardup import without_duplicates
from corpusloom.llm.pii import mask_documents
from corpusloom.llm.quality import add_quality

_QUALITY = "__quality"


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = add_quality(docs, _QUALITY).where(F.col(f"{_QUALITY}.kept"))
    return _counted(kept.withColumn("text", F.col(f"{_QUALITY}.clean_text")).drop(_QUALITY))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mask_documents(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), "doc_id")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("encoding", encoding),
]

#: BagMinHash bands and the fitted span classifier are beyond SQL; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
