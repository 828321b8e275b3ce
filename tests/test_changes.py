from __future__ import annotations

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowferry import job_session
from rowferry.functions import compact_date
from rowferry.operators import (
    WatermarkState,
    append_copy,
    compact,
    compact_changes,
    copy_partitions,
    drop_partitions,
    latest_per_key,
    missing_rows,
    nest,
    partition_columns,
    replace_partitions,
    rewrite_dataset,
    rows_in_scope,
)
from rowferry.plans.job import run_commands
from tests.conftest import rows

BASE = [
    (1, 10, "2019-01-02T10:11:12", "2019-01-02T10:11:12"),
    (2, 20, "2019-01-02T10:11:12", "2019-01-02T10:11:12"),
    (3, 30, "2019-01-02T10:11:12", "2019-01-02T10:11:12"),
    (4, 40, "2019-05-06T07:08:09", "2019-05-06T07:08:09"),
    (5, 50, "2019-01-02T10:11:12", "2019-03-03T00:00:00"),
]
LOG = [
    (1, 11, "2019-01-02T10:11:12", "2019-02-01T00:00:00", 2),
    (1, 12, "2019-01-02T10:11:12", "2019-02-02T00:00:00", 2),
    (2, 20, "2019-01-02T10:11:12", "2019-02-01T00:00:00", 1),
    (2, 21, "2019-01-02T10:11:12", "2019-04-01T00:00:00", 2),
    (5, 51, "2019-01-02T10:11:12", "2019-03-03T00:00:00", 2),
    (6, 60, "2019-07-07T07:07:07", "2019-07-07T07:07:07", 3),
]


def compacted(spark, **options):
    base = spark.createDataFrame(BASE, "id int, n int, created string, updated string")
    log = spark.createDataFrame(LOG, "id int, n int, created string, updated string, operation int")
    base = base.withColumn("updated", F.col("updated").cast("timestamp_ntz"))
    log = log.withColumn("updated", F.col("updated").cast("timestamp_ntz"))
    df = compact_changes(
        base, log, "id", "created", "updated", F.col("operation") == 1, tie_break=[F.desc("n")], **options
    )
    return df.select("id", "n", compact_date("created").alias("part"), F.year("updated").alias("year"))


def test_compaction(spark):
    # 4 lies in a partition no change touches; a delete wins over later changes; equal dates go to the tie break
    assert rows(compacted(spark)) == [
        (1, 12, "2019010210", 2019),
        (2, 20, "2019010210", 3000),
        (3, 30, "2019010210", 2019),
        (5, 51, "2019010210", 2019),
        (6, 60, "2019070707", 2019),
    ]


def test_compaction_can_drop_deletes(spark):
    assert [r[0] for r in rows(compacted(spark, drop_deletes=True))] == [1, 3, 5, 6]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(0, 1000).withColumn("k", F.col("id") % 2)
    latest = latest_per_key(df, "k", [F.desc("id")])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(latest) == [(998, 0), (999, 1)]


def test_missing_rows(spark):
    source = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    destination = spark.createDataFrame([(2,), (2,), (3,), (None,)], "id int")
    assert rows(missing_rows(source, destination, "id")) == sorted([(1,), (None,)], key=repr)


@pytest.mark.parametrize("limit", [1000, 1])
def test_scope_prunes_partitions(spark, folder, monkeypatch, limit):
    monkeypatch.setattr("rowferry.operators.delta.LIST_LIMIT", limit)
    data = [(i, f"2024-01-0{i % 5 + 1}", None if i % 7 == 0 else "x") for i in range(20)]
    spark.createDataFrame(data, "id int, p string, q string").write.partitionBy("p").parquet(folder)
    base = spark.read.parquet(folder)
    changes = spark.createDataFrame([("2024-01-02",), ("2024-01-04",), ("2024-01-04",), (None,)], "p string")
    changes = changes.withColumn("p", F.col("p").cast("date"))
    found = rows_in_scope(base, changes, "p")
    assert sorted(r["id"] for r in found.collect()) == [i for i in range(20) if i % 5 in (1, 3)]
    by_q = rows_in_scope(base, spark.createDataFrame([(None,)], "q string"), "q")
    assert sorted(r["id"] for r in by_q.collect()) == [0, 7, 14]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    if limit > 1:
        assert "PartitionFilters: [(p#" in plan and "IN (2024-01-02,2024-01-04)" in plan


def parts(folder):
    return sorted(os.path.relpath(d, folder) for d in glob.glob(f"{folder}/*=*"))


def test_replace_partitions_leaves_others_alone(spark, folder):
    first = spark.createDataFrame([(1, "01"), (2, "02"), (3, "03")], "id int, p string")
    replace_partitions(first, folder, "parquet", ["p"])
    second = spark.createDataFrame([(9, "02")], "id int, p string")
    replace_partitions(second, folder, "parquet", ["p"])
    assert parts(folder) == ["p=01", "p=02", "p=03"]
    assert rows(spark.read.schema("id int, p string").parquet(folder)) == [(1, "01"), (3, "03"), (9, "02")]


def test_replace_partitions_drops_the_emptied_ones(spark, folder):
    first = spark.createDataFrame([(1, "a:1"), (2, "b"), (3, None), (4, "d")], "id int, p string")
    replace_partitions(first, folder, "parquet", ["p"])
    affected = first.where("p IS NULL OR p <> 'd'")
    replace_partitions(first.where("p = 'b'"), folder, "parquet", ["p"], affected)
    got = spark.read.schema("id int, p string").parquet(folder)
    assert rows(got) == sorted([(2, "b"), (4, "d")], key=repr)
    nulls = spark.createDataFrame([(7, None), (8, "")], "id int, p string")
    replace_partitions(nulls, folder, "parquet", ["p"], nulls)
    got = spark.read.schema("id int, p string").parquet(folder)
    assert rows(got) == sorted([(2, "b"), (4, "d"), (7, None), (8, None)], key=repr)


def test_copy_keeps_partition_text(spark, tmp_path):
    source, destination = str(tmp_path / "source"), str(tmp_path / "destination")
    spark.createDataFrame([(1, "01", "x")], "id int, p string, q string").write.partitionBy("p", "q").json(source)
    assert partition_columns(spark, source) == ["p", "q"]
    copy_partitions(job_session(spark), source, destination, "json", removesource=True)
    assert os.path.isdir(f"{destination}/p=01/q=x") and not os.path.exists(source)


def test_copy_needs_partitions(spark, folder):
    spark.range(1).write.parquet(folder)
    with pytest.raises(ValueError, match="no partition folders"):
        copy_partitions(spark, folder, folder + "2", "parquet")


def test_append_copy(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(2).write.parquet(a)
    spark.range(3).write.parquet(b)
    append_copy(spark, a, b, "parquet")
    assert spark.read.parquet(b).count() == 5


def test_drop_partitions_counts(spark, folder):
    spark.createDataFrame([(1, "a b"), (2, "c")], "id int, p string").write.partitionBy("p").parquet(folder)
    assert drop_partitions(spark, folder, [{"p": "a b"}, {"p": "zz"}]) == 1
    assert parts(folder) == ["p=c"]


def test_failed_rewrite_keeps_the_old_content(spark, folder):
    spark.range(3).write.parquet(folder)
    df = spark.read.parquet(folder).select(F.raise_error(F.lit("broken")).cast("int").alias("id"))
    with pytest.raises(Exception, match="broken"):
        rewrite_dataset(df, folder, "parquet")
    assert spark.read.parquet(folder).count() == 3


def test_compact(spark, folder):
    spark.range(0, 100, 1, 10).write.parquet(folder)
    compact(spark, folder, "parquet")
    assert len(glob.glob(f"{folder}/part-*.parquet")) == 1
    assert spark.read.parquet(folder).agg(F.sum("id")).first()[0] == 4950


def test_watermark_state(spark, folder):
    state = WatermarkState(spark, folder, "orders", datetime(2024, 1, 1))
    events = spark.createDataFrame([(d, datetime(2024, 1, d)) for d in (1, 2, 3, 4)], "id int, at timestamp_ntz")
    window = state.open(datetime(2024, 1, 3))
    assert [r[0] for r in rows(state.select(events, "at", window))] == [2, 3]
    # not closed yet, so a repeated move sees the same window
    assert state.open(datetime(2024, 1, 3)) == window
    state.close(window)
    window = state.open(datetime(2024, 1, 9))
    assert window == (datetime(2024, 1, 3), datetime(2024, 1, 9))
    assert [r[0] for r in rows(state.select(events, "at", window))] == [4]
    assert WatermarkState(spark, folder, "other", datetime(2020, 1, 1)).current() == datetime(2020, 1, 1)


def test_watermark_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([(1, datetime(2024, 1, 1))], "id int, at timestamp_ntz").write.parquet(path)
    state = WatermarkState(spark, str(tmp_path / "state"), "x", datetime(2024, 1, 1))
    df = state.select(spark.read.parquet(path), "at", state.open(datetime(2024, 2, 1)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at" in plan and "LessThanOrEqual(at" in plan


FOODS = [(1, "apple"), (2, "banana"), (3, "spinach"), (4, "tomato")]
KINDS = [(1, "fruit"), (2, "vegetable"), (3, "mineral")]
PAIRS = [(1, 1), (1, 2), (2, 3), (1, 4), (2, 4)]


def test_nested_documents(spark):
    foods = spark.createDataFrame(FOODS, "foodid int, food string")
    kinds = spark.createDataFrame(KINDS, "foodtypeid int, foodtype string")
    pairs = spark.createDataFrame(PAIRS + PAIRS, "foodtypeid int, foodid int")
    named = pairs.join(foods, "foodid")
    values = nest(kinds, named, ("foodtypeid", "foodtypeid"), "food", "foods").select("foodtype", "foods")
    assert [(r[0], r[1]) for r in values.orderBy("foodtypeid").collect()] == [
        ("fruit", ["apple", "banana", "tomato"]),
        ("vegetable", ["spinach", "tomato"]),
        ("mineral", []),
    ]
    documents = nest(kinds, named, ("foodtypeid", "foodtypeid"), {"id": "foodid", "name": "food"}, "foods")
    first = documents.where("foodtypeid = 2").select(F.to_json("foods")).first()[0]
    assert first == '[{"id":3,"name":"spinach"},{"id":4,"name":"tomato"}]'


def test_nesting_agrees_with_a_correlated_subquery(spark):
    spark.createDataFrame(KINDS, "foodtypeid int, foodtype string").createOrReplaceTempView("kinds")
    spark.createDataFrame(PAIRS, "kind int, foodid int").createOrReplaceTempView("pairs")
    by_sql = spark.sql(
        "SELECT foodtype, sort_array((SELECT collect_set(foodid) FROM pairs WHERE kind = foodtypeid)) AS ids FROM kinds"
    )
    by_nest = nest(spark.table("kinds"), spark.table("pairs"), ("foodtypeid", "kind"), "foodid", "ids")
    assert rows(by_sql) == rows(by_nest.select("foodtype", "ids"))


def test_copies_keep_the_columns_of_all_files(spark, tmp_path):
    source, destination = str(tmp_path / "s"), str(tmp_path / "d")
    spark.range(2).selectExpr("id").write.parquet(f"{source}/p=1")
    spark.range(2).selectExpr("id", "id * 2 AS twice").write.parquet(f"{source}/p=2")
    copy_partitions(spark, source, destination, "parquet")
    got = spark.read.option("mergeSchema", "true").parquet(destination)
    assert rows(got.where("p = 2").select("id", "twice")) == [(0, 0), (1, 2)]
    compact(spark, source, "parquet")
    assert "twice" in spark.read.option("mergeSchema", "true").parquet(source).columns


def test_json_is_copied_as_it_is(spark, tmp_path):
    lines = ['{"a":1.10,"b":null}', '{"a":123456789012345678901234567890}']
    source = str(tmp_path / "s")
    spark.createDataFrame([(line, "1") for line in lines], "value string, p string").write.partitionBy("p").text(source)
    copy_partitions(spark, source, str(tmp_path / "d"), "json")
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "d")).collect()) == sorted(lines)
    append_copy(spark, f"{source}/p=1", str(tmp_path / "flat"), "json")
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "flat")).collect()) == sorted(lines)


def test_staged_partitions_keep_their_types(spark, folder):
    rows_in = [(1, datetime(2024, 1, 1), None, "01")]
    df = spark.createDataFrame(rows_in, "id int, at timestamp_ntz, empty string, p string")
    replace_partitions(df, folder, "json", ["p"], df)
    assert rows(spark.read.schema(df.schema).json(folder)) == rows_in


@pytest.mark.parametrize("limit", [1000, 0])
def test_scope_means_the_same_for_any_number_of_groups(spark, monkeypatch, limit):
    monkeypatch.setattr("rowferry.operators.delta.LIST_LIMIT", limit)
    dates = spark.sql("SELECT date'2024-01-02' AS p, 1 AS id UNION ALL SELECT date'2024-01-03', 2")
    midnight = spark.sql("SELECT timestamp_ntz'2024-01-02 00:00:00' AS p")
    assert [r["id"] for r in rows_in_scope(dates, midnight, "p").collect()] == [1]
    with pytest.raises(ValueError, match="does not fit"):
        rows_in_scope(dates, spark.sql("SELECT timestamp_ntz'2024-01-02 10:00:00' AS p"), "p")
    texts = spark.sql("SELECT '01' AS p, 1 AS id UNION ALL SELECT '1', 2")
    assert [r["id"] for r in rows_in_scope(texts, spark.sql("SELECT 1 AS p"), "p").collect()] == [2]


def test_drop_partitions_by_any_column(spark, folder):
    spark.range(12).selectExpr("id", "id % 2 AS a", "id % 3 AS b").write.partitionBy("a", "b").parquet(folder)
    assert drop_partitions(spark, folder, [{"b": 1}]) == 2
    assert drop_partitions(spark, folder, [{"b": 2, "a": 0}]) == 1
    assert sorted(parts(folder)) == ["a=0", "a=1"]
    assert spark.read.parquet(folder).where("b = 1 OR (a = 0 AND b = 2)").count() == 0
    with pytest.raises(ValueError, match="not by c"):
        drop_partitions(spark, folder, [{"c": 1}])


AWKWARD = [("1", "red, blue", None), ("2", 'say "x"', ""), ("3", "tab\there; é", " x "), ("4", None, "\\")]


@pytest.mark.parametrize("delimiter", [",", "\t", ";"])
@pytest.mark.parametrize("partitioned", [True, False])
def test_delimited_text_is_copied_as_it_is(spark, tmp_path, delimiter, partitioned):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.createDataFrame([(*r, str(int(r[0]) % 2)) for r in AWKWARD], "id string, a string, b string, p string")
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    writer = df.repartition(3).write.options(header="true", delimiter=delimiter, **spaces)
    (writer.partitionBy("p") if partitioned else writer).csv(source)
    command = {"operation": "copy", "sourcepath": source, "destinationpath": target, "delimiter": delimiter}
    run_commands(spark, {"fileformat": "csv", "post_migrate_command": {**command, "partitioned": partitioned, "removesource": partitioned}}, "post")
    # quoted empty fields are empty texts, other empty fields are null
    got = spark.read.options(header="true", delimiter=delimiter, nullValue="\x01").csv(target)
    assert rows(got.selectExpr("id", "a", "b", "string(p)")) == rows(df)
    assert os.path.exists(source) is not partitioned


def test_files_without_header_are_copied_with_all_rows(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([("01", "a"), ("11", "a"), ("21", "a")], "x string, y string").repartition(3).write.csv(source)
    append_copy(spark, source, target, "csv", {"header": "false"})
    assert rows(spark.read.csv(target)) == [("01", "a"), ("11", "a"), ("21", "a")]


def test_appended_partitions_are_seen(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    for path, low in ((source, 0), (target, 10)):
        spark.range(low, low + 10).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(path)
    append_copy(spark, source, target, "parquet")
    assert spark.read.parquet(target).count() == 20


def test_compaction_keeps_documents(spark, folder):
    lines = ['{"a":1,"b":null}', '{"a":1.0,"c":[]}', '{"b":12345678901234567890}']
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(folder)
    compact(spark, folder, "json")
    assert rows(spark.read.text(folder)) == sorted((x,) for x in lines)


@pytest.mark.parametrize("kept", ["_spark_metadata", "_checkpoint"])
def test_stream_output_is_not_rewritten(spark, folder, kept):
    spark.range(5).write.parquet(folder)
    os.makedirs(f"{folder}/{kept}")
    with pytest.raises(ValueError, match="stream"):
        compact(spark, folder, "parquet")
    assert len(glob.glob(f"{folder}/part-*.parquet")) >= 5


def test_operations_of_a_job(spark, folder):
    spark.range(12).selectExpr("id", "id % 3 AS p").write.partitionBy("p").parquet(folder)
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW gone AS SELECT 4 AS id")
    commands = [
        {"operation": "drop_partitions", "path": folder, "partitions": [{"p": 0}]},
        {"operation": "delete_rows", "path": folder, "selection": "SELECT id FROM gone", "mappingid": "id"},
        {"operation": "compact", "path": folder},
    ]
    run_commands(spark, {"post_migrate_commands": commands}, "post")
    got = spark.read.parquet(folder)
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 5, 7, 8, 10, 11]
    assert len(glob.glob(f"{folder}/p=*")) == 2
