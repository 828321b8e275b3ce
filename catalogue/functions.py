"""Scalar functions: built-in ones that jobs rely on, and the UUID functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query, stage, table
from catalogue.relational import run_sql
from rowferry.functions import array_to_text, compact_date, epoch_to_timestamp, time_uuid


@query("""
    SELECT event_id, STRFTIME(ts, '%Y%m%d%H') AS part_sql, STRFTIME(ts, '%Y%m%d%H') AS part
    FROM events""")
def fn_partition_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        "SELECT event_id, date_format(ts, \"y-MM-dd'T'HH:mm:ss\") AS at, "
        "translate(substring_index(date_format(ts, 'y-MM-dd HH:mm:ss'), ':', 1), '- ', '') AS part_sql FROM events"
    )
    return run_sql(spark, sf_dir, text, "events").select("event_id", "part_sql", compact_date("at").alias("part"))


@query("SELECT event_id, STRFTIME(ts, '%Y-%m-%d %H:%M:%S.%g') AS at FROM events")
def fn_date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT event_id, date_format(ts, 'y-MM-dd HH:mm:ss.SSS') AS at FROM events"
    return run_sql(spark, sf_dir, text, "events")


@query("""
    SELECT vec_id, list_sum(parts) AS total, '[' || array_to_string(parts, ',') || ']' AS text,
           '[' || array_to_string(parts, ',') || ']' AS text_sql
    FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(FLOOR(x * 1024) AS BIGINT)) AS parts FROM embeddings)""")
def fn_array_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        "SELECT vec_id, parts, concat('[', concat_ws(',', cast(parts AS array<string>)), ']') AS text_sql "
        "FROM (SELECT vec_id, transform(embedding, x -> floor(x * 1024)) AS parts FROM embeddings)"
    )
    total = F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total")
    return run_sql(spark, sf_dir, text, "embeddings").select("vec_id", total, array_to_text("parts").alias("text"), "text_sql")


@query("""
    SELECT p_partkey,
           '[{"size":' || p_size || ',"brand":"' || p_brand || '"},{"size":0,"brand":"' || p_type || '"}]' AS body
    FROM part""")
def fn_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        "SELECT p_partkey, to_json(array(named_struct('size', p_size, 'brand', p_brand), "
        "named_struct('size', 0, 'brand', p_type))) AS body FROM part"
    )
    return run_sql(spark, sf_dir, text, "part")


@query("SELECT event_id, CAST(JSON_EXTRACT_STRING(props, '$.k') AS BIGINT) AS k FROM events")
def fn_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, "SELECT event_id, from_json(props, 'k bigint').k AS k FROM events", "events")


@query("""
    SELECT event_id, STRFTIME(ts, '%Y-%m-%d %H:%M:%S') AS at, STRFTIME(ts, '%Y-%m-%d %H:%M:%S') AS at_sql
    FROM events""")
def fn_epoch_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        "SELECT event_id, unix_seconds(cast(ts AS timestamp)) AS seconds, "
        "date_format(to_timestamp(from_unixtime(unix_seconds(cast(ts AS timestamp)))), 'y-MM-dd HH:mm:ss') AS at_sql "
        "FROM events"
    )
    at = F.date_format(epoch_to_timestamp("seconds"), "y-MM-dd HH:mm:ss")
    return run_sql(spark, sf_dir, text, "events").select("event_id", at.alias("at"), "at_sql")


@query("SELECT event_id, COALESCE(NULLIF(event_type, 'click'), 'none') AS kind FROM events")
def fn_ifnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT event_id, ifnull(nullif(event_type, 'click'), 'none') AS kind FROM events"
    return run_sql(spark, sf_dir, text, "events")


# UUID texts derived from the customers: canonical, upper case, without dashes, all-zero and null by segment.
UUID_TEXT = """concat_ws('-', substr(md5(c_name), 1, 8), substr(md5(c_name), 9, 4), substr(md5(c_name), 13, 4),
    substr(md5(c_name), 17, 4), substr(md5(c_name), 21, 12))"""
VARIANTS = """CASE c_mktsegment WHEN 'BUILDING' THEN upper({uuid}) WHEN 'MACHINERY' THEN md5(c_name)
    WHEN 'FURNITURE' THEN '00000000-0000-0000-0000-000000000000' WHEN 'HOUSEHOLD' THEN NULL ELSE {uuid} END""".format(
    uuid=UUID_TEXT
)


@query(f"""
    SELECT c_custkey, COALESCE(
        REGEXP_FULL_MATCH({VARIANTS}, '[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}')
        AND c_mktsegment <> 'FURNITURE', FALSE) AS valid
    FROM customer""")
def fn_validate_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, f"SELECT c_custkey, validateUUID({VARIANTS}) AS valid FROM customer", "customer")


@query("SELECT c_custkey, UPPER(MD5(c_name)) AS bytes FROM customer")
def fn_uuid_to_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"SELECT c_custkey, hex(uuidToBinary(upper({UUID_TEXT}))) AS bytes FROM customer"
    return run_sql(spark, sf_dir, text, "customer")


@query(f"SELECT c_custkey, {UUID_TEXT} AS uuid FROM customer")
def fn_binary_to_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT c_custkey, binaryToUUID(unhex(concat(md5(c_name), 'ff'))) AS uuid FROM customer"
    return run_sql(spark, sf_dir, text, "customer")


@query("""
    SELECT c_custkey,
           substr(m, 15, 2) || substr(m, 13, 2) || substr(m, 11, 2) || substr(m, 9, 2) || '-' || substr(m, 7, 2)
           || substr(m, 5, 2) || '-' || substr(m, 3, 2) || substr(m, 1, 2) || '-' || substr(m, 31, 2) || substr(m, 29, 2)
           || '-' || substr(m, 27, 2) || substr(m, 25, 2) || substr(m, 23, 2) || substr(m, 21, 2) || substr(m, 19, 2)
           || substr(m, 17, 2) AS uuid
    FROM (SELECT c_custkey, md5(c_name) AS m FROM customer)""")
def fn_juuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT c_custkey, binaryToJUUID(cast(base64(unhex(md5(c_name))) AS binary)) AS uuid FROM customer"
    return run_sql(spark, sf_dir, text, "customer")


@query("SELECT COUNT(*) AS n, COUNT(*) AS distinct_ids, COUNT(*) AS well_formed FROM lineitem")
def fn_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "lineitem").select(time_uuid().alias("id"))
    shape = r"^[0-9a-f]{8}-[0-9a-f]{4}-1[0-9a-f]{3}-[89ab][0-9a-f]{3}-01[0-9a-f]{10}$"
    return spark.read.parquet(stage(spark, named, "parquet")).agg(
        F.count("*").alias("n"),
        F.count_distinct("id").alias("distinct_ids"),
        F.count_if(F.col("id").rlike(shape)).alias("well_formed"),
    )
