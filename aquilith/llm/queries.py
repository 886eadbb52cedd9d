"""The operators as queries over whole tables, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import fertility, fingerprints, language, mixing, oracles, packing, pages, partenum, pieces, retrieval, secrets, spans, templates, tries


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality(_docs(spark, sf_dir))


def op2_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup_spans(_docs(spark, sf_dir))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_docs(_docs(spark, sf_dir))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(_docs(spark, sf_dir), shingle=3, threshold=90)


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_docs(_docs(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_docs(spark, sf_dir))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.dedup_lines(_docs(spark, sf_dir))


def op8_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_docs(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return language.identify(docs, language.train(docs))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_docs(_docs(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.search(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_tokeniser_fertility,
        op2_sentence_spans,
        op3_sentencepiece,
        op4_ngram_jaccard,
        op5_spotsigs,
        op6_mixing,
        op7_line_templates,
        op8_secret_ownership,
        op9_language,
        op10_packing,
        op11_lexical_search,
        op12_prefix_trie,
        op13_host_paths,
        pipeline,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op11_lexical_search": oracles.LEXICAL_SEARCH,
    "op12_prefix_trie": oracles.PREFIX_TRIE,
    "op2_sentence_spans": oracles.SENTENCE_SPANS,
    "op4_ngram_jaccard": oracles.NGRAM_JACCARD,
    "op6_mixing": oracles.MIXING,
    "op7_line_templates": oracles.LINE_TEMPLATES,
    "op8_secret_ownership": oracles.SECRETS,
}
