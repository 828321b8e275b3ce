"""The corpus pipeline: quality rules, near copies, repeated passages, source mix, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm.common import numbered, store
from rowferry.llm.near_text import SHINGLE, similar_groups
from rowferry.llm.quality_rules import quality_rules
from rowferry.llm.queries import VOCABULARY, table
from rowferry.llm.sentencepiece_codec import Vocabulary, encode
from rowferry.llm.simhash import simhash_groups
from rowferry.llm.source_mix import mix_sources
from rowferry.llm.suffix_dedup import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    judged = quality_rules(docs, table(spark, sf_dir, "labels"), carry=COLUMNS)
    return judged.filter("kept").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id; rows without an id come last.

    Near copies share 0.8 or more of their five-word shingles. SimHash, op6's operator with five words, gives candidates:
    each row of a component with the first one. As two bits of 64 leave out most pairs of that similarity, bands of
    MinHashes give the others, and the exact similarity decides on both. Rows are numbered, so that repeated rows and
    repeated ids are told apart.
    """
    rows = numbered(docs, *COLUMNS)
    texts = rows.select(F.col("row").alias("doc_id"), "text")
    prints = store(simhash_groups(texts, SHINGLE).select("doc_id", "component_id"), "simhash")
    pairs = prints.filter("doc_id != component_id").select(F.col("component_id").alias("a"), F.col("doc_id").alias("b"))
    groups = similar_groups(texts, pairs)
    ids = rows.select("row", F.col("doc_id").isNull().alias("last"), "doc_id")
    placed = groups.select(F.col("doc_id").alias("row"), "component_id").join(ids, "row")
    first = placed.groupBy("component_id").agg(F.min(F.struct("last", "doc_id", "row")).alias("first"))
    return rows.join(first.select("first.row"), "row", "left_semi").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without repeated strings; an emptied document stays, and n_chars follows the text."""
    cut = remove_repeats(docs, carry=COLUMNS, texts=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumns({"text": text, "n_chars": n_chars}).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mix_sources(docs, carry=COLUMNS)
    copies = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies")))
    return mixed.withColumn("copy", F.explode(copies)).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their pieces."""
    return encode(docs.select(*COLUMNS), Vocabulary.from_model(VOCABULARY))


STAGES = [
    ("quality rules", quality),
    ("near copies", near_copies),
    ("repeats", repeats),
    ("source mix", source_mix),
    ("pieces", pieces),
]
# a text hash with a seed, an automaton and a suffix sort are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
