from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from rowferry import job_session
from rowferry.sinks import (
    encode_messages,
    html_table,
    insert_into_table,
    log_events,
    render_rows,
    write_files,
    write_raw_json,
    write_sequence_file,
    write_sink,
)
from rowferry.sinks.jdbc import jdbc_write_options
from rowferry.sinks.messages import producer_options
from tests.conftest import rows


def data_files(folder):
    return [f for f in glob.glob(f"{folder}/**/part-*", recursive=True) if not f.endswith(".crc")]


def test_unknown_format_and_mode(spark, folder):
    with pytest.raises(ValueError, match="unknown file format"):
        write_files(spark.range(1), folder, "parket")
    with pytest.raises(ValueError, match="unknown savemode"):
        write_files(spark.range(1), folder, "json", "sometimes")
    with pytest.raises(ValueError, match="unknown destination platform"):
        write_sink(spark.range(1), {"platform": "floppy"})


def test_save_modes(spark, folder):
    write_files(spark.range(2), folder, "parquet", "ErrorIfExists")
    with pytest.raises(Exception, match="already exists"):
        write_files(spark.range(2), folder, "parquet", "ErrorIfExists")
    write_files(spark.range(5), folder, "parquet", "Ignore")
    assert spark.read.parquet(folder).count() == 2
    write_files(spark.range(5), folder, "parquet", "Overwrite")
    assert spark.read.parquet(folder).count() == 5


@pytest.mark.parametrize(("partitions", "count"), [(4, 4), (8, 2), (2, 6)])
def test_file_count(spark, folder, partitions, count):
    df = spark.range(0, 1000, 1, partitions)
    write_files(df, folder, "json", coalescefilecount=count)
    assert len(data_files(folder)) == count
    assert spark.read.json(folder).count() == 1000


def test_partitioned_layout_has_one_file_per_small_partition(spark, folder):
    df = spark.range(0, 1000, 1, 8).withColumn("k", F.col("id") % 3)
    write_files(df, folder, "parquet", groupbyfields="k")
    assert sorted(os.path.basename(d) for d in glob.glob(f"{folder}/k=*")) == ["k=0", "k=1", "k=2"]
    assert len(data_files(folder)) == 3
    assert spark.read.parquet(folder).count() == 1000


def test_without_rebalance_every_task_writes(spark, folder):
    df = spark.range(0, 1000, 1, 8).withColumn("k", F.col("id") % 3)
    write_files(df, folder, "parquet", groupbyfields="k", rebalance=False)
    assert len(data_files(folder)) == 24


def test_csv_has_a_header_and_user_options_win(spark, folder):
    write_files(spark.range(0, 1, 1, 1).selectExpr("id", "'x;y' AS s"), folder, "csv", sparkoptions={"sep": ";"})
    assert open(data_files(folder)[0]).read() == 'id;s\n0;"x;y"\n'


def test_repeated_columns_are_refused(spark, folder):
    df = spark.range(1).alias("x").crossJoin(spark.range(1).alias("y"))
    with pytest.raises(ValueError, match="more than once: id"):
        write_files(df, folder, "json")


@pytest.mark.parametrize("fileformat", ["sequencefile", "sequencefilesnappy", "sequencefiledeflate"])
def test_sequence_file_numbers_all_rows(spark, folder, fileformat):
    write_sequence_file(spark.range(0, 100, 1, 4), folder, fileformat)
    pairs = spark.sparkContext.sequenceFile(folder).collect()
    assert sorted(pairs) == [(i, f'{{"id":{i}}}') for i in range(100)]


def test_raw_json(spark, folder):
    df = spark.createDataFrame([('{"a":1}', 9), ('{"b":"x"}', 9), (None, 9)], "doc string, other int")
    write_raw_json(df.where("doc IS NOT NULL"), folder)
    assert rows(spark.read.text(folder)) == [('{"a":1}',), ('{"b":"x"}',)]
    with pytest.raises(Exception, match="no JSON document"):
        write_raw_json(df, folder)


def test_insert_by_position_with_dynamic_partitions(spark, folder):
    session = job_session(spark)
    session.sql(f"CREATE TABLE t_pos (a INT, b STRING, p INT) USING parquet PARTITIONED BY (p) LOCATION '{folder}'")
    try:
        insert_into_table(session.createDataFrame([(1, "x", 1), (2, "y", 2)], "q int, r string, s int"), "t_pos")
        again = session.createDataFrame([(3, "z", 2)], "b int, a string, p int")
        insert_into_table(again, "t_pos", "default", "overwrite", partitions=True)
        assert rows(session.table("t_pos")) == [(1, "x", 1), (3, "z", 2)]
        insert_into_table(again, "t_pos", savemode="overwrite")
        assert rows(session.table("t_pos")) == [(3, "z", 2)]
    finally:
        session.sql("DROP TABLE t_pos")


def test_jdbc_options():
    base = {"platform": "postgres", "url": "jdbc:x", "table": "s.t", "login": "u", "password": "p"}
    options = jdbc_write_options({**base, "jdbcoptions": {"batchsize": 500}})
    assert options["stringtype"] == "unspecified" and options["batchsize"] == "500" and options["dbtable"] == "s.t"
    assert "stringtype" not in jdbc_write_options({**base, "platform": "mysql"})


def test_encoded_messages(spark):
    df = spark.sql("SELECT 7 id, 'h' origin, named_struct('a', 1) value, cast('b' AS binary) raw")
    encoded = encode_messages(df, "value", "id", "origin", "string", "string")
    row = encoded.first()
    assert encoded.columns == ["value", "key", "headers"]
    assert (row["value"], row["key"]) == ('{"a":1}', "7")
    assert [(h["key"], bytes(h["value"])) for h in row["headers"]] == [("origin", b"h")]
    assert encode_messages(df, "raw", valueformat="string").dtypes == [("value", "binary")]


def test_producer_options():
    endpoint = {"bootstrapservers": "b", "topic": "t", "headerfield": "h", "sparkoptions": {"kafka.acks": "all"}}
    options = producer_options(endpoint)
    assert options["includeHeaders"] == "true" and options["kafka.acks"] == "all" and options["topic"] == "t"


def test_rendered_rows_and_html(spark):
    df = spark.createDataFrame([(1, "<b>"), (2, None)], "id int, name string").orderBy("id")
    assert [tuple(r) for r in render_rows(df, limit=1).collect()] == [("1", "&lt;b&gt;")]
    assert html_table(df) == (
        "<table><tr><th>id</th><th>name</th></tr><tr><td>1</td><td>&lt;b&gt;</td></tr>"
        "<tr><td>2</td><td>null</td></tr></table>"
    )


def test_log_events(spark):
    df = job_session(spark).createDataFrame([("05/01/2024 10:00:00", 1)], "at string, v int")
    row = log_events(df, "at", "dd/MM/yyyy HH:mm:ss").first()
    assert row["timestamp"] == 1704448800000
    assert row["message"] == '{"at":"05/01/2024 10:00:00","v":1}'
    assert log_events(df).first()["timestamp"] > 1704448800000


def test_console_preview_shows_the_result(spark, capsys):
    write_sink(spark.sql("SELECT 'shown' AS word"), {"platform": "console", "numrows": "5", "truncate": "false"})
    assert "shown" in capsys.readouterr().out
