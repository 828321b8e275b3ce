"""Options of store connectors that ship as separate Spark packages, for their sources and sinks alike.

An endpoint may set `format` to use another connector that understands the same options.
"""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import quote_plus

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession

from rowferry.sources.jdbc import is_true

# Connector format per platform.
FORMATS = {
    "mongodb": "mongodb",
    "cassandra": "org.apache.spark.sql.cassandra",
    "elastic": "org.elasticsearch.spark.sql",
    "snowflake": "snowflake",
}
ELASTIC_PORT = 9200
# Write tuning of the wide-column store.
CASSANDRA_WRITE = {
    "spark.cassandra.output.consistency.level": "LOCAL_QUORUM",
    "spark.cassandra.output.batch.size.bytes": "1024",
    "spark.cassandra.output.batch.grouping.buffer.size": "1000",
    "spark.cassandra.output.concurrent.writes": "100",
    "spark.cassandra.output.batch.grouping.key": "none",
    "spark.cassandra.output.ignoreNulls": "true",
}
ELASTIC_OPERATIONS = ("index", "create", "update", "upsert")


def _text(options: Mapping[str, object] | None) -> dict[str, str]:
    return {k: str(v) for k, v in (options or {}).items()}


def mongodb_uri(endpoint: Mapping[str, object]) -> str:
    replica = endpoint.get("replicaset")
    target = f"{endpoint['cluster']}:27017/{endpoint['database']}.{endpoint['collection']}"
    if not is_true(endpoint.get("authenticationenabled", True)):
        return f"mongodb://{target}" + (f"?replicaSet={replica}" if replica else "")
    uri = f"mongodb://{quote_plus(str(endpoint['login']))}:{quote_plus(str(endpoint['password']))}@{target}"
    uri += f"?authSource={endpoint.get('authenticationdatabase') or 'admin'}"
    if replica:
        uri += f"&replicaSet={replica}"
    if is_true(endpoint.get("sslenabled", False)):
        uri += "&ssl=true"
    return uri


def _mongodb(endpoint: Mapping[str, object], writing: bool) -> dict[str, str]:
    uri = mongodb_uri(endpoint)
    options = {
        "connection.uri": uri,
        "uri": uri,
        "database": str(endpoint["database"]),
        "collection": str(endpoint["collection"]),
    }
    if writing:
        replace = is_true(endpoint.get("replacedocuments", True))
        options["replaceDocument"] = str(replace).lower()
        options["operationType"] = "replace" if replace else "update"
        options["ordered"] = str(is_true(endpoint.get("orderedrecords", False))).lower()
        if endpoint.get("maxBatchSize"):
            options["maxBatchSize"] = str(endpoint["maxBatchSize"])
    elif endpoint.get("samplesize"):
        options["sampleSize"] = str(endpoint["samplesize"])
    return {**options, **_text(endpoint.get("sparkoptions"))}


def _cassandra(endpoint: Mapping[str, object], writing: bool) -> dict[str, str]:
    options = {
        "keyspace": str(endpoint["keyspace"]),
        "table": str(endpoint["table"]),
        "spark.cassandra.connection.host": str(endpoint["cluster"]),
        "spark.cassandra.auth.username": str(endpoint.get("login", "")),
        "spark.cassandra.auth.password": str(endpoint.get("password", "")),
    }
    if writing:
        options.update(CASSANDRA_WRITE)
    else:
        options["spark.cassandra.input.consistency.level"] = "LOCAL_QUORUM"
    if endpoint.get("local_dc"):
        options["spark.cassandra.connection.local_dc"] = str(endpoint["local_dc"])
    return {**options, **_text(endpoint.get("sparkoptions"))}


def elastic_resource(endpoint: Mapping[str, object]) -> str:
    return f"{endpoint['index']}/{endpoint.get('type', '')}"


def _elastic(endpoint: Mapping[str, object], writing: bool) -> dict[str, str]:
    options = {
        "es.nodes": str(endpoint["clustername"]),
        "es.port": str(endpoint.get("port") or ELASTIC_PORT),
        "es.clustername": str(endpoint["clustername"]),
        "es.nodes.wan.only": "true",
        "es.net.http.auth.user": str(endpoint.get("login", "")),
        "es.net.http.auth.pass": str(endpoint.get("password", "")),
        "es.internal.es.version": str(endpoint.get("version", "")),
        "es.resource": elastic_resource(endpoint),
    }
    if writing:
        operation = str(endpoint.get("savemode", "index"))
        if operation not in ELASTIC_OPERATIONS:
            raise ValueError(f"savemode {operation!r}: use one of {', '.join(ELASTIC_OPERATIONS)}")
        options["es.write.operation"] = operation
        if endpoint.get("mappingid"):
            options["es.mapping.id"] = str(endpoint["mappingid"])
    else:
        options["es.index.auto.create"] = "true"
    return {**options, **_text(endpoint.get("esoptions"))}


def _snowflake(endpoint: Mapping[str, object], writing: bool) -> dict[str, str]:
    options = {
        "sfUrl": str(endpoint["url"]),
        "sfUser": str(endpoint["user"]),
        "sfPassword": str(endpoint.get("password", "")),
        "sfDatabase": str(endpoint["database"]),
        "sfSchema": str(endpoint["schema"]),
        **_text(endpoint.get("options")),
    }
    if writing:
        options["dbtable"] = str(endpoint["table"])
    else:
        options["query"] = f"SELECT * FROM {endpoint['table']}"
    return options


_OPTIONS = {"mongodb": _mongodb, "cassandra": _cassandra, "elastic": _elastic, "snowflake": _snowflake}


def connector_options(endpoint: Mapping[str, object], writing: bool = False) -> dict[str, str]:
    return _OPTIONS[endpoint["platform"]](endpoint, writing)


def _prepared(io: DataFrameReader | DataFrameWriter, endpoint: Mapping[str, object], writing: bool):
    return io.format(endpoint.get("format", FORMATS[endpoint["platform"]])).options(
        **connector_options(endpoint, writing)
    )


def read_connector(spark: SparkSession, endpoint: Mapping[str, object]) -> DataFrame:
    return _prepared(spark.read, endpoint, writing=False).load()


def write_connector(df: DataFrame, endpoint: Mapping[str, object]) -> None:
    mode = "append"
    if endpoint["platform"] == "snowflake":
        mode = str(endpoint.get("savemode", "append")).lower()
    _prepared(df.write, endpoint, writing=True).mode(mode).save()
