"""The corpus pipeline: documents to token ids in five stages.

Each stage takes the documents that the one before has left, whole and with all their columns. Documents in no known
language go, then exact copies, then all but one of each group of near copies; the rest is mixed to the target
weights of the sources, which repeats some documents and leaves others out, in training order; at last every
document of the mix is encoded. Null and empty tables pass through all stages.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import exact, jaccard, language, mixing, pieces
from lakestrata.llm.frames import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns the languages from three quarters of the documents and keeps what is in one of them."""
    return language.keep_known_languages(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the longest document of each group of equal texts."""
    return exact.drop_copies(docs)


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix asks for them, in training order."""
    return mixing.mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, ids, n_tokens`` of each document of the mix."""
    encoded = pieces.encode(docs.select("doc_id", "source", "text"), pieces.Vocabulary.load())
    return encoded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_dedup),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]
#: SQL can express neither the language model nor the encoding; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
