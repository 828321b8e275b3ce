"""Kafka-shaped sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.sources.messages import registry_header, secure_options

NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def _encoded(
    df: DataFrame, field: str, message_format: str, schema: str | None, schema_id: int | None
) -> Column:
    column = F.col(f"`{field}`")
    data_type = df.schema[field].dataType
    if message_format == "avro":
        from pyspark.sql.avro.functions import to_avro

        message = to_avro(column, schema) if schema else to_avro(column)
        return message if schema_id is None else F.concat(registry_header(schema_id), message)
    if isinstance(data_type, T.BinaryType):
        return column
    return F.to_json(column) if isinstance(data_type, NESTED) else column.cast("string")


def encode_messages(
    df: DataFrame,
    valuefield: str = "value",
    keyfield: str | None = None,
    headerfield: str | None = None,
    keyformat: str = "avro",
    valueformat: str = "avro",
    keyschema: str | None = None,
    valueschema: str | None = None,
    keyschemaid: int | None = None,
    valueschemaid: int | None = None,
) -> DataFrame:
    """`value`, and `key` and `headers` where asked for. Nested values become JSON text unless they go as Avro.

    Avro messages carry a registry header when the id of their schema is given.
    The header column may be text, which becomes one header named after its column, or already an array of
    key/value structs.
    """
    columns = [_encoded(df, valuefield, valueformat, valueschema, valueschemaid).alias("value")]
    if keyfield:
        columns.append(_encoded(df, keyfield, keyformat, keyschema, keyschemaid).alias("key"))
    if headerfield:
        header = F.col(f"`{headerfield}`")
        if not isinstance(df.schema[headerfield].dataType, T.ArrayType):
            header = F.array(
                F.struct(F.lit(headerfield).alias("key"), header.cast("string").cast("binary").alias("value"))
            )
        columns.append(header.alias("headers"))
    return df.select(*columns)


def producer_options(endpoint: Mapping[str, object]) -> dict[str, str]:
    return {
        **secure_options(endpoint),
        "kafka.bootstrap.servers": str(endpoint["bootstrapservers"]),
        "topic": str(endpoint["topic"]),
        "includeHeaders": str(bool(endpoint.get("headerfield"))).lower(),
        **{k: str(v) for k, v in (endpoint.get("sparkoptions") or {}).items()},
    }


def encode_for(df: DataFrame, endpoint: Mapping[str, object]) -> DataFrame:
    return encode_messages(
        df,
        endpoint.get("valuefield", "value"),
        endpoint.get("keyfield"),
        endpoint.get("headerfield"),
        endpoint.get("keyformat", "avro"),
        endpoint.get("valueformat", "avro"),
        endpoint.get("keyschema"),
        endpoint.get("valueschema"),
        _number(endpoint.get("keyschemaid")),
        _number(endpoint.get("valueschemaid")),
    )


def _number(given: object) -> int | None:
    return None if given is None else int(str(given))


def write_messages(df: DataFrame, endpoint: Mapping[str, object]) -> None:
    writer = encode_for(df, endpoint).write.format(endpoint.get("format", "kafka"))
    writer.options(**producer_options(endpoint)).mode("append").save()
