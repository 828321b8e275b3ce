from __future__ import annotations

import os

import json

import pytest
from pyspark.sql import functions as F

from rowferry import job_session
from rowferry.sources import parse_documents, parse_mixed_documents, read_source, stage_documents, to_json_documents
from rowferry.sources.connectors import connector_options, mongodb_uri
from rowferry.sources.files import endpoint_path, file_options, file_path
from rowferry.sources.jdbc import connection, jdbc_read_options
from rowferry.sources.messages import consumer_options, registry_header, subject_name
from tests.conftest import rows

HELLO = os.path.join(os.path.dirname(__file__), "fixtures", "hello.csv")


def files(path, fileformat, **options):
    return {"platform": "filesystem", "path": path, "fileformat": fileformat, **options}


def test_csv_is_text_without_a_schema(spark):
    df = read_source(job_session(spark), files(HELLO, "csv"))
    assert df.dtypes == [("HelloField", "string"), ("WorldField", "string"), ("IntField", "string")]
    assert df.count() == 5


def test_csv_with_ddl(spark):
    ddl = "`HelloField` STRING, `WorldField` STRING, `IntField` INT"
    df = read_source(job_session(spark), files(HELLO, "csv", schema=ddl))
    assert df.agg(F.sum("IntField")).first()[0] == 8


def test_malformed_rows_are_dropped_from_rows_and_counts(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,x\n2\n3,y,z\n")
    df = read_source(job_session(spark), files(str(path), "csv"))
    assert rows(df) == [("1", "x")]
    assert df.count() == 1


def test_user_options_win():
    assert file_options("csv", sparkoptions={"header": "false", "quote": "'"})["header"] == "false"
    assert file_options("csv", delimiter="\t")["delimiter"] == "\t"
    assert file_options("parquet") == {"mergeSchema": "false"}
    assert file_options("parquet", mergeschema=True) == {"mergeSchema": "true"}
    assert file_options("json") == {}


def test_charset(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("a\nétage\n".encode("iso-8859-1"))
    df = read_source(job_session(spark), files(str(path), "csv", charset="iso-8859-1"))
    assert rows(df) == [("étage",)]


def test_path_prefixes(spark):
    assert file_path(spark, "bucket/x") == "bucket/x"
    assert file_path(spark, "bucket/x", object_store=True) == "s3a://bucket/x"
    assert file_path(spark, "bucket/x", "gs://", object_store=True) == "gs://bucket/x"
    store = {"platform": "s3", "s3path": "b/x"}
    assert endpoint_path(spark, {**store, "s3_service_endpoint": "https://e"}) == "s3a://b/x"
    assert endpoint_path(spark, {"platform": "filesystem", "path": "/x", "fileprefix": "file://"}) == "file:///x"


def test_partition_discovery(spark, folder):
    spark.createDataFrame([(1, "USED"), (2, "UNUSED"), (3, "USED")], "id int, salt string").write.partitionBy(
        "salt"
    ).option("header", "true").csv(folder)
    df = read_source(job_session(spark), files(folder, "csv"))
    assert rows(df.groupBy("salt").count()) == [("UNUSED", 1), ("USED", 2)]


def test_unknown_platform_raises(spark):
    with pytest.raises(ValueError, match="unknown source platform"):
        read_source(spark, {"platform": "floppy"})


def test_avro_needs_its_package(spark, folder):
    try:
        spark.range(3).write.format("avro").save(folder)
    except Exception as error:
        if "avro" in str(error).lower():
            pytest.skip("spark-avro is not on this machine")
        raise
    assert read_source(job_session(spark), files(folder, "avro")).count() == 3


def test_documents_are_staged_in_groups(spark, folder):
    documents = to_json_documents(spark.range(0, 45, 1, 1).select(F.col("id").alias("_id")))
    staged = stage_documents(documents, folder, group_size=20)
    assert rows(staged.groupBy("partition").count()) == [(1, 20), (2, 20), (3, 5)]
    # a second try does not add to the first
    assert stage_documents(documents, folder, group_size=20).count() == 45
    assert parse_documents(staged).agg(F.sum("_id")).first()[0] == sum(range(45))


def test_sampled_schema(spark):
    texts = spark.createDataFrame([('{"a":1}',), ('{"a":2,"b":"x"}',)], "jsonfield string").coalesce(1)
    assert parse_documents(texts).columns == ["a", "b"]
    # a sample would lose the fields of other documents
    assert parse_documents(texts, samplesize=1).columns == ["a", "b"]


@pytest.mark.parametrize(
    ("endpoint", "url", "driver"),
    [
        (
            {"platform": "mssql"},
            "jdbc:sqlserver://h:1433;database=d",
            "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        ),
        (
            {"platform": "mssql", "iswindowsauthenticated": "true", "domain": "corp"},
            "jdbc:jtds:sqlserver://h:1433/d;domain=corp;useNTLMv2=true",
            "net.sourceforge.jtds.jdbc.Driver",
        ),
        (
            {"platform": "mysql", "port": "3307"},
            "jdbc:mysql://h:3307/d?rewriteBatchedStatements=true&cachePrepStmts=true",
            "com.mysql.jdbc.Driver",
        ),
        ({"platform": "oracle"}, "jdbc:oracle:thin:@//h:1521/d", "oracle.jdbc.driver.OracleDriver"),
        (
            {"platform": "postgres", "sslenabled": "true"},
            "jdbc:postgresql://h:5432/d?sslmode=require",
            "org.postgresql.Driver",
        ),
        (
            {"platform": "teradata", "iswindowsauthenticated": True, "jdbcoptions": {"logging_level": "DEBUG"}},
            "jdbc:teradata://h/LOGMECH=LDAP,TYPE=DEFAULT,DATABASE=d,TMODE=TERA,DBS_PORT=1025,LOG=DEBUG",
            "com.teradata.jdbc.TeraDriver",
        ),
    ],
)
def test_jdbc_presets(endpoint, url, driver):
    found = connection({"server": "h", "database": "d", "login": "u", "password": "p", **endpoint})
    assert found == {"url": url, "driver": driver, "user": "u", "password": "p"}


def test_jdbc_url_wins():
    assert connection({"platform": "mysql", "url": "jdbc:x", "server": "h", "database": "d"})["url"] == "jdbc:x"
    with pytest.raises(ValueError, match="url, or server and database"):
        connection({"platform": "mysql", "server": "h"})


def test_jdbc_scans():
    base = {"platform": "mysql", "url": "jdbc:x", "table": "t"}
    whole = jdbc_read_options(base)
    assert whole["dbtable"] == "t" and whole["fetchsize"] == "72000" and "partitionColumn" not in whole
    assert jdbc_read_options({**base, "jdbcoptions": {"fetchsize": 5}})["fetchsize"] == "5"
    assert jdbc_read_options({**base, "table": "(select 1) A"})["dbtable"] == "(select 1) A"
    assert jdbc_read_options(base, "select 2")["dbtable"] == "(select 2) S"
    bounds = {"primarykey": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "10"}
    ranged = jdbc_read_options({**base, **bounds})
    assert ranged["partitionColumn"] == "id" and ranged["numPartitions"] == "10" and ranged["upperBound"] == "1000"
    with pytest.raises(ValueError, match="numPartitions"):
        jdbc_read_options({**base, "primarykey": "id", "lowerBound": 1, "upperBound": 2})


def test_kafka_options():
    endpoint = {"bootstrapservers": "b:9092", "topic": "t", "sparkoptions": {"startingOffsets": "earliest"}}
    options = consumer_options({**endpoint, "truststorepath": "/t.jks", "truststorepassword": "s"})
    assert options["subscribe"] == "t" and options["startingOffsets"] == "earliest"
    assert options["kafka.security.protocol"] == "SSL" and options["kafka.ssl.truststore.location"] == "/t.jks"
    assert "kafka.security.protocol" not in consumer_options(endpoint)


def test_subject_names():
    assert subject_name("t", True) == "t-key"
    assert subject_name("t", False) == "t-value"
    assert subject_name("t", False, "RecordNameStrategy", "R", "n.s") == "n.s.R"
    assert subject_name("t", False, "TopicRecordNameStrategy", "R", "n.s") == "t-n.s.R"


def test_connector_options():
    mongo = {"platform": "mongodb", "cluster": "c", "database": "d", "collection": "k", "login": "u@x", "password": "p/w"}
    assert mongodb_uri(mongo) == "mongodb://u%40x:p%2Fw@c:27017/d.k?authSource=admin"
    assert mongodb_uri({**mongo, "authenticationenabled": "false", "replicaset": "r"}) == "mongodb://c:27017/d.k?replicaSet=r"
    assert connector_options({**mongo, "samplesize": 50})["sampleSize"] == "50"
    assert connector_options({**mongo, "replacedocuments": "false"}, writing=True)["operationType"] == "update"
    wide = {"platform": "cassandra", "cluster": "c", "keyspace": "k", "table": "t", "local_dc": "dc1"}
    assert connector_options(wide)["spark.cassandra.input.consistency.level"] == "LOCAL_QUORUM"
    tuned = connector_options({**wide, "sparkoptions": {"spark.cassandra.output.concurrent.writes": 5}}, writing=True)
    assert tuned["spark.cassandra.output.concurrent.writes"] == "5"
    assert tuned["spark.cassandra.output.ignoreNulls"] == "true"
    elastic = {"platform": "elastic", "clustername": "e", "index": "i", "type": "doc", "version": "6.8"}
    assert connector_options(elastic)["es.port"] == "9200" and connector_options(elastic)["es.resource"] == "i/doc"
    written = connector_options({**elastic, "savemode": "upsert", "mappingid": "k"}, writing=True)
    assert written["es.write.operation"] == "upsert" and written["es.mapping.id"] == "k"
    with pytest.raises(ValueError, match="savemode"):
        connector_options({**elastic, "savemode": "sideways"}, writing=True)
    snow = {"platform": "snowflake", "url": "u", "user": "x", "database": "d", "schema": "s", "table": "(select 1) A"}
    assert connector_options(snow)["query"] == "SELECT * FROM (select 1) A"
    assert connector_options(snow, writing=True)["dbtable"] == "(select 1) A"


def test_registry_header(spark):
    assert bytes(spark.range(1).select(registry_header(258)).first()[0]) == b"\x00\x00\x00\x01\x02"


MIXED = [
    '{"a":1,"b":{"c":"x","d e":[1,2]},"n":null,"OBJECT<":"VOID"}',
    '{"a":"t","b":{"c":2.5},"f":1.5,"g":[]}',
    '{"a":true,"g":[{"h":1}],"z":"2024-01-01","big":123456789012345678901234567890}',
    "{}",
]


def document_of(row, columns):
    """The fields of a parsed document, typed or rescued, as plain values without nulls."""
    def clean(value):
        if isinstance(value, dict):
            return {k: clean(v) for k, v in value.items() if clean(v) is not None}
        return [clean(v) for v in value] if isinstance(value, list) else value

    kept = json.loads(row["whole"], parse_float=str)
    rescued = kept.pop("_rescued", None) or {}
    return clean({**kept, **rescued})


@pytest.mark.parametrize("samplesize", [None, 1, 2])
def test_no_field_of_mixed_documents_is_lost(spark, samplesize):
    df = spark.createDataFrame([(t,) for t in MIXED], "jsonfield string").coalesce(1)
    parsed = parse_mixed_documents(df, samplesize=samplesize)
    if not samplesize:
        kinds = {f.name: f.dataType.simpleString() for f in parsed.schema}
        assert kinds["a"] == "variant" and kinds["b"] == "struct<c:variant,d e:array<bigint>>" and kinds["n"] == "variant"
        assert parsed.where("_rescued IS NOT NULL").count() == 0
    rows_found = parsed.select(F.to_json(F.struct("*")).alias("whole")).collect()
    want = [document_of({"whole": t}, None) for t in MIXED]
    assert [document_of(r, parsed.columns) for r in rows_found] == want


def test_documents_that_are_no_objects(spark):
    df = spark.createDataFrame([("[1]",), ('{"a":1}',), ("null",)], "jsonfield string")
    assert parse_mixed_documents(df).select(F.to_json("value")).collect()[0][0] == "[1]"
    with pytest.raises(Exception, match="MALFORMED"):
        parse_mixed_documents(spark.createDataFrame([("{x",)], "jsonfield string")).collect()
    assert parse_mixed_documents(df.limit(0)).count() == 0
