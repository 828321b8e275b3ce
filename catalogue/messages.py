"""Kafka-shaped frames built from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query, stage, table
from rowferry import move, scratch_dir
from rowferry.sinks import encode_messages
from rowferry.sources import decode_messages, unwrap_change_stream


def _frame(spark: SparkSession, sf_dir: str, value: F.Column) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


@query("SELECT 'events' AS topic, event_id AS offset_, CAST(user_id AS VARCHAR) AS key, props AS value FROM events")
def kafka_decode_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = _frame(spark, sf_dir, F.col("props"))
    decoded = decode_messages(frame, "string", "string").withColumnRenamed("offset", "offset_")
    return decoded.select("topic", "offset_", "key", "value")


@query("""
    SELECT CAST(event_id AS VARCHAR) AS key,
           '{"event_type":"' || event_type || '","user":{"id":' || user_id || '}}' AS value,
           'event_type=' || event_type AS header
    FROM events""")
def kafka_encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type", "struct(event_type, struct(user_id AS id) AS user) AS value"
    )
    encoded = encode_messages(shaped, "value", "event_id", "event_type", "string", "string")
    header = F.concat_ws("=", F.col("headers")[0]["key"], F.col("headers")[0]["value"].cast("string"))
    return encoded.select("key", "value", header.alias("header"))


@query("""
    SELECT event_id AS offset_,
           CASE WHEN event_type IN ('view', 'signup') THEN EPOCH_US(ts) // 1000 ELSE EPOCH_US(ts) // 1000000 * 1000 END AS at_ms,
           CASE WHEN event_type NOT IN ('error', 'signup') THEN user_id END AS key,
           CASE WHEN event_type NOT IN ('error', 'signup') THEN event_type END AS event_type,
           CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS amount
    FROM events""")
def cdc_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views lack the cluster time, errors are deletes without a document, signups have a broken payload."""
    payload = """to_json(named_struct(
        'operationType', if(event_type = 'error', 'delete', 'insert'),
        'clusterTime', if(event_type = 'view', NULL,
            named_struct('$timestamp', named_struct('t', unix_seconds(cast(ts AS timestamp)), 'i', 1L))),
        'fullDocument', if(event_type = 'error', NULL,
            named_struct('_id', user_id, 'event_type', event_type, 'value', value)),
        'ns', named_struct('coll', 'events', 'db', 'shop')))"""
    envelope = f"""to_json(named_struct(
        'payload', if(event_type = 'signup', 'not json', {payload}),
        'schema', named_struct('optional', false, 'type', 'string')))"""
    frame = decode_messages(_frame(spark, sf_dir, F.expr(envelope)), "string", "string")
    documents = unwrap_change_stream(frame, "_id bigint, event_type string, value double")
    return documents.select(
        F.col("offset").alias("offset_"),
        F.unix_millis("timestamp").alias("at_ms"),
        "key",
        F.col("value.event_type"),
        F.col("value.value").alias("amount"),
    )


def _topic(path: str, **options) -> dict[str, object]:
    """A topic endpoint over a dataset of Kafka-shaped rows, which stands in for the broker."""
    return {
        "platform": "kafka",
        "format": "parquet",
        "bootstrapservers": "none:9092",
        "topic": "events",
        "keyformat": "string",
        "valueformat": "string",
        "sparkoptions": {"path": path, "checkpointLocation": f"{path}/_checkpoint"},
        **options,
    }


RESHAPED = """
    SELECT CAST(user_id AS VARCHAR) AS key,
           '{"offset":' || event_id || ',"k":' || JSON_EXTRACT_STRING(props, '$.k') || '}' AS value FROM events"""


def _reshape(spark: SparkSession, sf_dir: str, source: dict[str, object], **destination) -> DataFrame:
    topic, target = stage(spark, _frame(spark, sf_dir, F.col("props")), "parquet"), scratch_dir(spark, "topic")
    document = {
        "source": _topic(topic, alias="kf", **source),
        "sql": {"query": "SELECT key AS user, struct(offset, from_json(value, 'k bigint').k AS k) AS value FROM kf"},
        "properties": {"spark.sql.streaming.schemaInference": True},
        "destination": _topic(target, keyfield="user", **destination),
    }
    move(spark, document)
    return spark.read.parquet(target)


@query(RESHAPED)
def kafka_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reshape(spark, sf_dir, {})


@query(RESHAPED)
def stream_kafka_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reshape(spark, sf_dir, {"isstream": "true", "streamwatermarkdelay": "1 hour"}, trigger="available_now")
