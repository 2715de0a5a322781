"""A training corpus from the documents: known languages, no copies, mixed sources, token ids.

Every stage works on all that the one before kept, which is written as Parquet in between. The
stages but the last return the columns of documents; sources that mixing repeats have their documents
as often as it says. The last returns doc_id, n_tokens and digests of ids and decoded text.

Null and empty texts have no language and go in the first stage; null sources are a source of their
own. Where an id repeats or is missing, rows are told apart by their text: of equal texts one row stays,
and near copies are judged text by text. Texts are taken whole whatever their length. Other columns of
documents are carried along with their values up to the last stage, whatever their names. An empty
table gives an empty result, and so do documents without any label, as no language is learned.
"""

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import bpe, exact_dedup, language_id, minhash, mixing
from tillroll.llm.base import stored, table


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; gibberish and others go."""
    return language_id.in_known_languages(docs)


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.without_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return minhash.without_near_copies(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out for the sources' target weights."""
    return mixing.mixed(docs, epoch="__epoch", place="__place").drop("__epoch", "__place")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests."""
    return bpe.encoding_digests(docs)


STAGES = [
    ("language_id", known_languages),
    ("exact_dedup", no_exact_copies),
    ("near_dedup", no_near_copies),
    ("mix_sources", mixed_sources),
    ("bpe", encoded),
]

# The first, third and last stage are not expressible in SQL; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
