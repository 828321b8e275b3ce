"""Load and save paths of connectors that are not on this machine.

`format` points the endpoint at Parquet files, which ignore the connector's own options and keep the rest of the
path: option mapping, encoding, modes and the job around it.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowferry import job_session, move, transform
from rowferry.plans.templates import expand_inline_jdbc, jdbc_value
from rowferry.sinks import write_sink
from rowferry.sources import read_source
from tests.conftest import rows

STORES = {
    "mongodb": {"cluster": "c", "database": "d", "collection": "k", "login": "u", "password": "p"},
    "cassandra": {"cluster": "c", "keyspace": "k", "table": "t", "login": "u", "password": "p"},
    "elastic": {"clustername": "c", "index": "i", "version": "6.8", "login": "u", "password": "p"},
    "snowflake": {"url": "u", "user": "x", "password": "p", "database": "d", "schema": "s", "table": "t"},
    "mysql": {"server": "h", "database": "d", "table": "t", "login": "u", "password": "p"},
    "postgres": {"url": "jdbc:x", "table": "t", "login": "u", "password": "p"},
    "teradata": {"server": "h", "database": "d", "table": "t", "login": "u", "password": "p"},
}
# where each platform takes options that go to the connector as they are
OPTIONS = {"elastic": "esoptions", "snowflake": "options", "mysql": "jdbcoptions", "postgres": "jdbcoptions", "teradata": "jdbcoptions"}


def endpoint(platform, path, **options):
    passed = OPTIONS.get(platform, "sparkoptions")
    return {"platform": platform, "format": "parquet", passed: {"path": str(path)}, **STORES[platform], **options}


@pytest.mark.parametrize("platform", STORES)
def test_store_to_store(spark, tmp_path, platform):
    spark.range(5).selectExpr("id", "concat('n', id) AS name").write.parquet(str(tmp_path / "in"))
    job = {
        "source": endpoint(platform, tmp_path / "in", alias="s"),
        "sql": {"query": "SELECT id, upper(name) AS name FROM s WHERE id > 2"},
        "destination": endpoint(platform, tmp_path / "out"),
    }
    move(spark, job)
    move(spark, job)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(3, "N3"), (3, "N3"), (4, "N4"), (4, "N4")]


@pytest.mark.parametrize("platform", ["snowflake", "mysql"])
def test_overwriting_stores(spark, tmp_path, platform):
    for n in (5, 2):
        write_sink(spark.range(n), endpoint(platform, tmp_path / "out", savemode="overwrite"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_documents_from_a_json_field(spark, tmp_path):
    df = spark.sql("""SELECT '{"_id":1,"name":"a"}' AS body UNION ALL SELECT '{"_id":2,"tags":["x"]}'""")
    write_sink(df, endpoint("mongodb", tmp_path / "out", documentfromjsonfield="true", jsonfield="body"))
    got = spark.read.parquet(str(tmp_path / "out")).select("_id", "name", "tags")
    assert rows(got) == [(1, "a", None), (2, None, ["x"])]


def test_mixed_documents_are_staged_and_cleaned_up(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    source = endpoint("mongodb", tmp_path / "in", overrideconnector="true", tmpfilelocation=str(tmp_path / "tmp"))
    move(spark, {"source": source, "destination": {"platform": "filesystem", "path": str(tmp_path / "out"), "fileformat": "json"}})
    got = spark.read.json(str(tmp_path / "out"))
    assert rows(got.select("jsonfield")) == [(f'{{"id":{i}}}',) for i in range(5)]
    # the staged folder goes, the folder that the user named stays
    assert list((tmp_path / "tmp").iterdir()) == []


def kafka(path, **options):
    return {
        "platform": "kafka",
        "format": "parquet",
        "bootstrapservers": "b:9092",
        "topic": "t",
        "keyformat": "string",
        "valueformat": "string",
        "sparkoptions": {"path": str(path), "checkpointLocation": f"{path}-checkpoint"},
        **options,
    }


def frame(spark, path):
    spark.range(4).selectExpr(
        "cast(cast(id AS string) AS binary) AS key",
        "cast(to_json(named_struct('IntField', id, 'WorldField', 'w')) AS binary) AS value",
        "'t' AS topic",
        "0 AS partition",
        "id AS offset",
        "timestamp_seconds(id) AS timestamp",
    ).write.parquet(str(path))


def test_kafka_batch(spark, tmp_path):
    frame(spark, tmp_path / "in")
    text = "SELECT key AS HelloField, struct(offset, from_json(value, 'IntField int').IntField AS n) AS value, topic FROM kf"
    destination = kafka(tmp_path / "out", keyfield="HelloField", headerfield="topic")
    move(spark, {"source": kafka(tmp_path / "in", alias="kf"), "sql": {"query": text}, "destination": destination})
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["value", "key", "headers"]
    assert rows(got.select("key", "value"))[2] == ("2", '{"offset":2,"n":2}')


def test_kafka_stream(spark, tmp_path):
    frame(spark, tmp_path / "in")
    job = {
        "source": kafka(tmp_path / "in", alias="kf", isstream="true", streamwatermarkdelay="1 minute"),
        "sql": {"query": "SELECT key, value FROM kf"},
        "properties": {"spark.sql.streaming.schemaInference": True},
        "destination": kafka(tmp_path / "out", keyfield="key", trigger="available_now"),
    }
    move(spark, job)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_avro_needs_a_schema(spark, tmp_path):
    frame(spark, tmp_path / "in")
    with pytest.raises(ValueError, match="valueschema"):
        read_source(spark, {**kafka(tmp_path / "in"), "valueformat": "avro"})


def test_change_stream(spark, tmp_path):
    inner = """to_json(named_struct('operationType', 'insert', 'fullDocument', named_struct('_id', id, 'n', id * 2)))"""
    spark.range(2).selectExpr(
        "cast('k' AS binary) AS key",
        f"cast(to_json(named_struct('payload', {inner})) AS binary) AS value",
        "'t' AS topic",
        "0 AS partition",
        "id AS offset",
        "timestamp_seconds(id) AS timestamp",
    ).write.parquet(str(tmp_path / "in"))
    source = kafka(tmp_path / "in", kafkaconnectmongodboptions={"documentschema": "_id bigint, n bigint"})
    df = read_source(job_session(spark), source)
    assert df.columns == ["topic", "partition", "offset", "timestamp", "key", "value"]
    assert rows(df.select("key", "value.n")) == [(0, 0), (1, 2)]


def test_inline_jdbc_values(spark, tmp_path):
    spark.range(1, 2).selectExpr("id", "42.7D AS x").write.parquet(str(tmp_path / "one"))
    source = endpoint("mysql", tmp_path / "one")
    assert jdbc_value(spark, source, "select max(id) from t", "long") == "1"
    text = 'inlineexprforjdbc{{"sql":"select max(id) from t","coltype":"int"}}'
    expanded = expand_inline_jdbc(spark, {**source, "upperBound": text, "lowerBound": "0"})
    assert expanded["upperBound"] == "1" and expanded["lowerBound"] == "0"
    with pytest.raises(ValueError, match="unknown coltype"):
        jdbc_value(spark, source, "q", "blob")
    spark.range(2).write.parquet(str(tmp_path / "two"))
    with pytest.raises(ValueError, match="exactly one row"):
        jdbc_value(spark, endpoint("mysql", tmp_path / "two"), "q")


def test_query_from_a_file(spark, tmp_path):
    (tmp_path / "q.sql").write_text("select id from t")
    spark.range(3).write.parquet(str(tmp_path / "in"))
    df = transform(spark, {"source": endpoint("postgres", tmp_path / "in", querys3sqlfile={"path": str(tmp_path / "q.sql")})})
    assert df.agg(F.sum("id")).first()[0] == 3
