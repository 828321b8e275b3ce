"""Kafka-shaped frames: options, key and value decoding, and change-stream envelopes."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Consumer defaults.
CONSUMER_DEFAULTS = {"max.poll.records": "500", "session.timeout.ms": "120000"}
# Fixed value: a registry-framed Avro message starts with one magic byte and a four-byte schema id.
REGISTRY_HEADER_BYTES = 5


def secure_options(endpoint: Mapping[str, object]) -> dict[str, str]:
    """TLS options from the key and trust store settings of an endpoint."""
    # Specification key -> client option.
    names = {
        "keystorepath": "kafka.ssl.keystore.location",
        "truststorepath": "kafka.ssl.truststore.location",
        "keystorepassword": "kafka.ssl.keystore.password",
        "truststorepassword": "kafka.ssl.truststore.password",
        "keypassword": "kafka.ssl.key.password",
    }
    if not (endpoint.get("keystorepath") or endpoint.get("truststorepath")):
        return {}
    options = {option: str(endpoint[key]) for key, option in names.items() if endpoint.get(key)}
    return {"kafka.security.protocol": "SSL", **options}


def consumer_options(endpoint: Mapping[str, object]) -> dict[str, str]:
    return {
        **secure_options(endpoint),
        **CONSUMER_DEFAULTS,
        "kafka.bootstrap.servers": str(endpoint["bootstrapservers"]),
        "subscribe": str(endpoint["topic"]),
        **{k: str(v) for k, v in (endpoint.get("sparkoptions") or {}).items()},
    }


def subject_name(
    topic: str, is_key: bool, strategy: str = "TopicNameStrategy", record: str = "", namespace: str = ""
) -> str:
    """The schema subject of a topic under one of the three naming strategies."""
    full_name = f"{namespace}.{record}" if namespace else record
    if strategy.lower() == "recordnamestrategy":
        return full_name
    if strategy.lower() == "topicrecordnamestrategy":
        return f"{topic}-{full_name}"
    return f"{topic}-{'key' if is_key else 'value'}"


def registry_header(schema_id: int) -> Column:
    """The bytes in front of an Avro message whose schema has this id in the registry."""
    return F.unhex(F.lit(f"00{schema_id:08X}"))


def from_registry_avro(column: Column, schema: str, reader: str | None = None) -> Column:
    """Avro column without its registry header, in the shape of the reader's schema where one is given.

    Needs the spark-avro package on the cluster.
    """
    from pyspark.sql.avro.functions import from_avro

    options = {"avroSchema": reader} if reader else {}
    return from_avro(F.substring(column, REGISTRY_HEADER_BYTES + 1, 2147483647), schema, options)


# what decodes a column with its header by a schema, and by a reader's schema where that is another one
Decoder = Callable[..., Column]


def schema_id(column: Column) -> Column:
    """The schema id in the five bytes before an Avro message; null where they are no such header."""
    header = F.hex(F.substring(column, 1, REGISTRY_HEADER_BYTES))
    return F.when(header.rlike("^00[0-9A-F]{8}$"), F.conv(F.substring(header, 3, 8), 16, 10).cast("long"))


def from_registry_ids(column: Column, schemas: Mapping[object, str], decode: Decoder | None = None) -> Column:
    """Avro messages of several schemas in one topic: each row by the schema that its header names.

    `schemas` maps ids to Avro schemas; the last one is the reader's, so that older messages come in its shape. An id
    that is not among them, or a message without header, fails the read.
    """
    decode = decode or from_registry_avro
    number = schema_id(column)
    reader = list(schemas.values())[-1]
    message = F.concat(F.lit("no schema for the id of a message: "), F.coalesce(number.cast("string"), F.lit("no header")))
    decoded = F.raise_error(message)
    for key, schema in schemas.items():
        # a decoder must not meet messages of other schemas
        own = F.when(number == int(key), column)
        decoded = F.when(number == int(key), decode(own, schema) if schema == reader else decode(own, schema, reader)).otherwise(decoded)
    return F.when(column.isNotNull(), decoded)


def decode_messages(
    frame: DataFrame,
    keyformat: str = "avro",
    valueformat: str = "avro",
    keyschema: str | Mapping[object, str] | None = None,
    valueschema: str | Mapping[object, str] | None = None,
    decode: Decoder | None = None,
) -> DataFrame:
    """Replace the binary key and value; the other columns keep their order and come first.

    An Avro schema is one for all messages, or a map from the ids in their headers to schemas.
    """

    def decoded(name: str, message_format: str, schema: str | Mapping[object, str] | None) -> Column:
        if message_format != "avro":
            return F.col(name).cast("string").alias(name)
        if not schema:
            raise ValueError(f"an avro {name} needs its schema ({name}schema)")
        if isinstance(schema, Mapping):
            return from_registry_ids(F.col(name), schema, decode).alias(name)
        return (decode or from_registry_avro)(F.col(name), schema).alias(name)

    kept = [F.col(f"`{c}`") for c in frame.columns if c not in ("key", "value")]
    return frame.select(*kept, decoded("key", keyformat, keyschema), decoded("value", valueformat, valueschema))


def unwrap_change_stream(frame: DataFrame, documentschema: str) -> DataFrame:
    """Documents out of change-stream messages: JSON whose `payload` field is again JSON text.

    The event time is the cluster time where there is one, else the record's own timestamp.
    """
    envelope = "payload string, schema struct<optional: boolean, type: string>"
    payload = (
        "operationType string, clusterTime struct<`$timestamp`: struct<t: bigint, i: bigint>>, "
        f"fullDocument struct<{documentschema}>, ns struct<coll: string, db: string>"
    )
    opened = frame.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.from_json(F.from_json("value", envelope).getField("payload"), payload).alias("payload"),
    )
    seconds = F.col("payload.clusterTime").getField("$timestamp").getField("t")
    fields = opened.select("payload.fullDocument.*").columns
    return opened.select(
        "topic",
        "partition",
        "offset",
        F.coalesce(F.timestamp_seconds(seconds), F.col("timestamp").cast("timestamp")).alias("timestamp"),
        F.col("payload.fullDocument._id").alias("key"),
        F.struct(*[F.col(f"payload.fullDocument.`{f}`").alias(f) for f in fields]).alias("value"),
    )


def read_messages(spark: SparkSession, endpoint: Mapping[str, object], streaming: bool = False) -> DataFrame:
    """A topic, decoded, with its change-stream envelope removed when the endpoint describes one."""
    reader = spark.readStream if streaming else spark.read
    frame = reader.format(endpoint.get("format", "kafka")).options(**consumer_options(endpoint)).load()
    frame = decode_messages(
        frame,
        endpoint.get("keyformat", "avro"),
        endpoint.get("valueformat", "avro"),
        endpoint.get("keyschema"),
        endpoint.get("valueschema"),
    )
    documentschema = (endpoint.get("kafkaconnectmongodboptions") or {}).get("documentschema")
    return unwrap_change_stream(frame, documentschema) if documentschema else frame
