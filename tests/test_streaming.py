from __future__ import annotations

import glob
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rowferry import SpecError, job_session, move, run_job
from rowferry.plans.spec import parse_job
from rowferry.sources import read_source
from rowferry.streaming import interval_join, start_stream
from tests.conftest import rows

SCHEMA = "id int, at timestamp, v string"


def files(path, fileformat="json", **options):
    return {"platform": "filesystem", "path": str(path), "fileformat": fileformat, **options}


def batch(spark, folder, *data):
    session = job_session(spark)
    df = session.createDataFrame(list(data), "id int, at string, v string")
    df.withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").json(str(folder))


def output(spark, folder, schema=SCHEMA):
    return job_session(spark).read.schema(schema).json(str(folder))


def test_restart_takes_only_new_files(spark, tmp_path):
    job = {
        "source": files(tmp_path / "in", isstream="true", schema=SCHEMA),
        "destination": files(tmp_path / "out", trigger="available_now"),
    }
    batch(spark, tmp_path / "in", (1, "2024-01-01", "a"))
    move(spark, job)
    batch(spark, tmp_path / "in", (2, "2024-01-02", "b"))
    move(spark, job)
    move(spark, job)
    assert [r[0] for r in rows(output(spark, tmp_path / "out"))] == [1, 2]


def test_schema_is_inferred_from_a_batch_read(spark, tmp_path):
    batch(spark, tmp_path / "in", (1, "2024-01-01", "a"))
    df = read_source(job_session(spark), files(tmp_path / "in", isstream=True))
    assert df.isStreaming and dict(df.dtypes)["id"] == "bigint"


def test_single_file_becomes_its_folder(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in"))
    (only,) = glob.glob(str(tmp_path / "in" / "part-*.parquet"))
    spark.range(7).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    job = {
        "source": files(only, "parquet", isstream="true"),
        "destination": files(tmp_path / "out", trigger="available_now", groupbyfields="id"),
    }
    move(spark, job)
    assert output(spark, tmp_path / "out", "id bigint").count() == 5
    assert os.path.isdir(tmp_path / "out" / "id=3")


def test_late_rows_are_left_out_after_the_watermark(spark, tmp_path):
    job = {
        "source": files(
            tmp_path / "in",
            isstream="true",
            schema=SCHEMA,
            alias="e",
            streamwatermarkfield="at",
            streamwatermarkdelay="1 hour",
        ),
        "sql": {"query": "SELECT window.start AS at, count(*) AS n FROM e GROUP BY window(at, '1 hour')"},
        "destination": files(tmp_path / "out", trigger="available_now"),
    }
    batch(spark, tmp_path / "in", (1, "2024-01-01 00:10:00", "a"), (2, "2024-01-01 05:00:00", "b"))
    move(spark, job)
    # the hour from 00:00 is closed by now, the one from 05:00 is not
    batch(spark, tmp_path / "in", (3, "2024-01-01 00:20:00", "late"), (4, "2024-01-01 05:30:00", "c"))
    batch(spark, tmp_path / "in", (5, "2024-01-01 09:00:00", "d"))
    move(spark, job)
    got = output(spark, tmp_path / "out", "at timestamp, n bigint").select(F.hour("at"), "n")
    assert rows(got) == [(0, 1), (5, 2)]


def test_unmatched_rows_of_a_stream_join_wait_for_the_watermark(spark, tmp_path):
    batch(spark, tmp_path / "l", (1, "2024-01-01 00:00:00", "a"), (2, "2024-01-01 00:00:00", "b"), (3, "2024-01-03", "c"))
    batch(spark, tmp_path / "r", (1, "2024-01-01 00:30:00", "x"), (2, "2024-01-01 02:00:00", "y"), (9, "2024-01-03", "z"))
    mark = {"isstream": "true", "schema": SCHEMA, "streamwatermarkfield": "at", "streamwatermarkdelay": "1 hour"}
    text = (
        "SELECT l.id, l.v, r.v AS w FROM l LEFT JOIN r ON l.id = r.id "
        "AND r.at BETWEEN l.at AND l.at + INTERVAL 1 HOUR"
    )
    move(
        spark,
        {
            "sources": [files(tmp_path / "l", alias="l", **mark), files(tmp_path / "r", alias="r", **mark)],
            "sql": {"query": text},
            "destination": files(tmp_path / "out", trigger="available_now"),
        },
    )
    # 3 has no match either, but the watermark has not passed it
    assert rows(output(spark, tmp_path / "out", "id int, v string, w string")) == [(1, "a", "x"), (2, "b", None)]


def test_console(spark, tmp_path):
    batch(spark, tmp_path / "in", (1, "2024-01-01", "seen"))
    df = read_source(job_session(spark), files(tmp_path / "in", isstream=True, schema=SCHEMA))
    query = start_stream(df, {"platform": "console", "trigger": "available_now", "numrows": 3, "outputmode": "append"})
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    assert query.recentProgress[0]["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming")


def test_bad_stream_destinations(spark, tmp_path):
    batch(spark, tmp_path / "in", (1, "2024-01-01", "a"))
    df = read_source(job_session(spark), files(tmp_path / "in", isstream=True, schema=SCHEMA))
    with pytest.raises(ValueError, match="cannot be a stream destination"):
        start_stream(df, {"platform": "mysql"})
    with pytest.raises(ValueError, match="unknown trigger"):
        start_stream(df, files(tmp_path / "out", trigger="hourly"))
    with pytest.raises(ValueError, match="unknown stream file format"):
        start_stream(df, files(tmp_path / "out", "sequencefile"))


def test_failing_stream_fails_the_job(spark, tmp_path):
    batch(spark, tmp_path / "in", (1, "2024-01-01", "a"))
    job = {
        "source": files(tmp_path / "in", isstream="true", schema=SCHEMA, alias="e"),
        "sql": {"query": "SELECT raise_error('broken') AS x, * FROM e"},
        "destination": files(tmp_path / "out", trigger="available_now"),
    }
    result = run_job(spark, job)
    assert result.status == "Failed" and "broken" in result.error


def test_jobs_after_a_stream_run(spark, tmp_path):
    """The wait is for the job's own query, also while another one is active."""
    batch(spark, tmp_path / "in", (1, "2024-01-01", "a"))
    endless = read_source(job_session(spark), files(tmp_path / "in", isstream=True, schema=SCHEMA))
    running = start_stream(endless, files(tmp_path / "endless", trigger="processing_time", triggerinterval="1 second"))
    try:
        job = {
            "source": files(tmp_path / "in", isstream="true", schema=SCHEMA),
            "destination": files(tmp_path / "out", trigger="available_now"),
        }
        assert run_job(spark, job).status == "Completed"
        assert running.isActive
    finally:
        running.stop()


def hot_streams(spark, tmp_path, n=3000):
    """One key has all rows; a third of the left rows meets nothing."""
    left = spark.range(n).selectExpr("id AS a", "1 AS k", "timestamp_seconds(1700000000 + id * 30) AS at")
    right = spark.range(n).where("id % 3 = 1").selectExpr("id AS b", "1 AS h", "timestamp_seconds(1700000000 + id * 30 + 20) AS until")
    for df, name in ((left, "l"), (right, "r")):
        df.write.parquet(str(tmp_path / name))
    return left, right


@pytest.mark.parametrize(("how", "slices", "salts"), [("left", 4, 1), ("left", 1, 3), ("inner", 7, 2)])
def test_interval_join_agrees_with_a_plain_join(spark, how, slices, salts):
    draw = random.Random(slices)
    left = [(i, draw.choice([1, 1, 1, 2, None]), datetime(2024, 1, 1) + timedelta(seconds=draw.randint(-9000, 9000))) for i in range(150)]
    right = [(i, draw.choice([1, 1, 2, 3, None]), datetime(2024, 1, 1) + timedelta(seconds=draw.randint(-9000, 9000))) for i in range(150)]
    right += [(900 + i, *left[i][1:]) for i in range(5)]
    right += [(800 + i, left[i][1], left[i][2] + timedelta(minutes=20)) for i in range(5)]
    a = spark.createDataFrame(left, "a int, k int, at timestamp")
    b = spark.createDataFrame(right, "b int, h int, until timestamp")
    got = interval_join(a, b, "k", "h", "at", "until", "20 minutes", how, slices, salts)
    assert got.columns == ["a", "k", "at", "b", "h", "until"]
    near = (F.col("k") == F.col("h")) & F.col("until").between(F.col("at"), F.col("at") + F.expr("INTERVAL 20 MINUTES"))
    assert rows(got) == rows(a.join(b, near, how))


def test_interval_join_refuses_what_it_cannot_do(spark):
    a = spark.sql("SELECT 1 AS k, now() AS at")
    with pytest.raises(ValueError, match="columns k"):
        interval_join(a, a.withColumnRenamed("at", "until"), "k", "k", "at", "until", "1 hour")
    b = a.toDF("h", "until")
    with pytest.raises(ValueError, match="fixed length"):
        interval_join(a, b, "k", "h", "at", "until", "1 month")
    with pytest.raises(ValueError, match="inner or left"):
        interval_join(a, b, "k", "h", "at", "until", "1 hour", "full")


def test_state_of_a_hot_key_is_in_many_tasks(spark, tmp_path):
    left, right = hot_streams(spark, tmp_path)
    sources = [
        files(tmp_path / name, "parquet", alias=name, isstream="true", streamwatermarkfield=time, streamwatermarkdelay="2 days")
        for name, time in (("l", "at"), ("r", "until"))
    ]
    join = {"left": "l", "right": "r", "alias": "j", "leftkeys": "k", "rightkeys": "h", "lefttime": "at", "righttime": "until", "within": "1 minute"}
    job = {
        "sources": sources,
        "intervaljoins": [join],
        "sql": {"query": "SELECT a, b FROM j"},
        "destination": files(tmp_path / "out", "parquet", trigger="available_now"),
    }
    move(spark, job)
    got = spark.read.parquet(str(tmp_path / "out"))
    near = F.col("until").between(F.col("at"), F.col("at") + F.expr("INTERVAL 1 MINUTE"))
    assert rows(got.where("b IS NOT NULL")) == rows(left.join(right, near).select("a", "b"))
    state = spark.read.format("statestore").option("joinSide", "left").load(str(tmp_path / "out" / "_checkpoint"))
    held = {r["partition_id"]: r["count"] for r in state.groupBy("partition_id").count().collect()}
    assert len(held) >= 6 and max(held.values()) < sum(held.values()) / 2


def test_an_interval_join_has_to_be_read(spark):
    with pytest.raises(SpecError, match="interval join needs left"):
        parse_job({"source": {"platform": "filesystem", "alias": "a"}, "destination": {"platform": "console"}, "sql": {"query": "x"}, "intervaljoins": [{"alias": "j"}]})


def test_state_holds_few_copies_of_right_rows(spark, tmp_path):
    _, right = hot_streams(spark, tmp_path)
    a, b = (
        spark.readStream.schema(schema).parquet(str(tmp_path / name)).withWatermark(time, "2 days")
        for name, schema, time in (("l", "a long, k int, at timestamp", "at"), ("r", "b long, h int, until timestamp", "until"))
    )
    joined = interval_join(a, b, "k", "h", "at", "until", "1 minute")
    start_stream(joined, files(tmp_path / "out", "parquet", trigger="available_now")).awaitTermination()
    state = spark.read.format("statestore").option("joinSide", "right").load(str(tmp_path / "out" / "_checkpoint"))
    assert right.count() <= state.count() <= 1.2 * right.count()


def test_interval_counts_over_two_runs(spark, tmp_path):
    """Counts of a hot key add up over runs, and a row without a match comes once the watermark has passed it."""
    join = {"left": "l", "right": "r", "alias": "j", "leftkeys": "k", "rightkeys": "h", "lefttime": "at", "righttime": "until"}
    job = {
        "sources": [
            files(tmp_path / name, "parquet", alias=name, isstream="true", schema=schema, streamwatermarkfield=time, streamwatermarkdelay="1 hour")
            for name, schema, time in (("l", "a long, k int, at timestamp", "at"), ("r", "b long, h int, until timestamp", "until"))
        ],
        "intervaljoins": [{**join, "within": "10 minutes", "type": "count"}],
        "sql": {"query": "SELECT a, at, n FROM j"},
        "destination": files(tmp_path / "out", "parquet", trigger="available_now"),
    }
    left = spark.range(600).selectExpr("id AS a", "if(id = 7, NULL, 1) AS k", "timestamp_micros(1700000000000000 + id * 30000001) AS at")
    right = spark.range(600).where("id % 97 < 5").selectExpr("id AS b", "1 AS h", "timestamp_micros(1700000000000000 + id * 30000001 + 600000000) AS until")
    for low, high in ((0, 300), (300, 600)):
        left.where(f"a >= {low} AND a < {high}").write.mode("append").parquet(str(tmp_path / "l"))
        right.where(f"b >= {low} AND b < {high}").write.mode("append").parquet(str(tmp_path / "r"))
        move(spark, job)
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("a", "at").agg(F.sum("n").alias("n"))
    near = (F.col("k") == F.col("h")) & F.col("until").between(F.col("at"), F.col("at") + F.expr("INTERVAL 10 MINUTES"))
    wanted = left.join(right, near, "left").groupBy("a", "at").agg(F.count("b").alias("n"))
    # the watermark stands an hour before the earlier of the last times, in whole milliseconds
    last = min(left.agg(F.max("at")).first()[0], right.agg(F.max("until")).first()[0]) - timedelta(hours=1)
    last = last.replace(microsecond=last.microsecond // 1000 * 1000)
    assert rows(got) == rows(wanted.where((F.col("n") > 0) | (F.col("at") + F.expr("INTERVAL 10 MINUTES") < F.lit(last))))
