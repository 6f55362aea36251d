"""The corpus pipeline: language, near-duplicates, secrets, mix, packed sequences.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of `documents`.

Defined cases: null and letterless texts are rejected by the first stage, so they reach none of the
others; rows with a null id and repeated rows are documents like any other, and rows that repeat an
id stay or go together; other columns are carried along unread; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import language, mixing, packing, secrets, simhash
from tidemart.llm.common import table
from tidemart.session import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; lang takes the predicted value."""
    model = language.fit(docs.where(~language.held_out("doc_id")))
    labelled = language.identify(docs, model).where(F.col("lang_pred") != language.UNKNOWN)
    return labelled.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more over five-word shingles."""
    return simhash.deduplicate(docs, shingle=5, similarity=0.8)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of secrets give way to their kind; every document stays."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: No SQL: similarity groups, language models and tokenizers; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
