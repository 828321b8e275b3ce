"""One query per operator, over whole tables with the operators' own parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowferry.llm import co_training, language_id, toxicity
from rowferry.llm.conversation_repair import repair_damaged
from rowferry.llm.embedding_graph import near_copies
from rowferry.llm.embedding_whitening import whiten
from rowferry.llm.html_text import extract_text
from rowferry.llm.lm_score import score_texts
from rowferry.llm.oracles import ORACLES
from rowferry.llm.quality_rules import quality_rules
from rowferry.llm.sentencepiece_codec import Vocabulary, piece_digests
from rowferry.llm.simhash import simhash_groups
from rowferry.llm.source_mix import mix_sources
from rowferry.llm.suffix_dedup import remove_repeats

__all__ = ["ORACLES", "QUERIES", "VOCABULARY"]

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), Vocabulary.from_model(VOCABULARY))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return co_training.score_quality(docs, co_training.train(docs, table(spark, sf_dir, "labels")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "embeddings"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_suffix_dedup,
        op2_sentencepiece,
        op3_lm_score,
        op4_source_mix,
        op5_co_training,
        op6_simhash,
        op7_quality_rules,
        op8_embedding_graph,
        op9_html_text,
        op10_toxicity,
        op11_conversation_repair,
        op12_embedding_whitening,
        op13_language_id,
    )
}
