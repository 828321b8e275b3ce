"""Documents without a common schema, as JSON text and parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import files, query, stage, table
from rowferry import scratch_dir, transform
from rowferry.sources import parse_documents, read_json_documents, stage_documents, to_json_documents


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as JSON texts of two shapes."""
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey _id", "c_name name", "c_mktsegment segment")
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "-1 - s_suppkey _id", "s_name name", "struct(s_acctbal balance, s_nationkey nation) account"
    )
    return to_json_documents(customers).union(to_json_documents(suppliers))


MIXED = """
    SELECT c_custkey AS _id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT -1 - s_suppkey, s_name, NULL, s_acctbal FROM supplier"""


@query(MIXED)
def doc_json_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = stage(spark, _mixed(spark, sf_dir).withColumnRenamed("jsonfield", "value"), "text")
    documents = stage_documents(read_json_documents(spark, lines), scratch_dir(spark, "documents"))
    return documents.select(
        F.get_json_object("jsonfield", "$._id").cast("bigint").alias("_id"),
        F.get_json_object("jsonfield", "$.name").alias("name"),
        F.get_json_object("jsonfield", "$.segment").alias("segment"),
        F.get_json_object("jsonfield", "$.account.balance").cast("double").alias("balance"),
    )


@query(MIXED)
def doc_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "_id bigint, name string, segment string, account struct<balance: double, nation: int>"
    parsed = parse_documents(_mixed(spark, sf_dir), schema)
    return parsed.select("_id", "name", "segment", "account.balance")


@query(MIXED)
def doc_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_documents(_mixed(spark, sf_dir))
    return parsed.select("_id", "name", "segment", "account.balance")


CLASHING = """
    SELECT c_custkey AS _id, CAST(c_nationkey AS VARCHAR) AS v, NULL AS note, NULL::BIGINT AS n FROM customer
    UNION ALL SELECT -1 - s_suppkey, s_name, 'x' || s_suppkey, s_nationkey FROM supplier"""


def _clashing(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """A job over JSON files in which `v` is a number here and a text there, and two fields only come with suppliers."""
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey _id", "c_nationkey v")
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "-1 - s_suppkey _id", "s_name v", "struct(concat('x', s_suppkey) note, array(s_nationkey) n) more"
    )
    both = to_json_documents(customers).union(to_json_documents(suppliers))
    lines = stage(spark, both.withColumnRenamed("jsonfield", "value"), "text")
    return transform(spark, {"source": files(lines, "json", mixedtypes=True, **options)})


@query(CLASHING)
def doc_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _clashing(spark, sf_dir)
    v = F.col("v").cast("string").alias("v")
    return parsed.where("_rescued IS NULL").select("_id", v, "more.note", F.col("more.n")[0].alias("n"))


@query(CLASHING)
def doc_sampled_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema of a few documents: what does not fit it is found among the rescued fields."""
    parsed = _clashing(spark, sf_dir, samplesize=20)
    whole = F.to_json(F.struct(*[c for c in parsed.columns if c != "_rescued"]))
    get = lambda path: F.coalesce(F.get_json_object(whole, path), F.get_json_object(F.to_json("_rescued"), path))
    n = get("$.more.n[0]").cast("bigint").alias("n")
    return parsed.select(get("$._id").cast("bigint").alias("_id"), get("$.v").alias("v"), get("$.more.note").alias("note"), n)
