"""The dealt operators as registered queries over whole tables."""

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    ann,
    bpe,
    exact_dedup,
    fill_in_middle,
    language_id,
    merkle,
    minhash,
    mixing,
    packing,
    secrets,
    token_files,
    url_filter,
    warc,
)
from tillroll.llm.base import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged(pages).select("page_id", "host", "path", "rule", "verdict")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"))


def op5_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "epoch", "place")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.form_digests(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digests(table(spark, sf_dir, "documents"), merkle.tampered_leaf())


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_secrets": op2_secrets,
    "op3_url_rules": op3_url_rules,
    "op4_token_files": op4_token_files,
    "op5_bpe_automaton": op5_bpe_automaton,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_mix_sources": op8_mix_sources,
    "op9_nearest": op9_nearest,
    "op10_warc": op10_warc,
    "op11_best_two_fit": op11_best_two_fit,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_merkle": op13_merkle,
}
