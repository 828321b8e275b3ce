"""Writes whose tasks get very many rows, and copies whose files follow the size of a table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import catalogue.changes
import catalogue.verification
from catalogue import QUERIES
from rowferry.operators import append_copy, compact
from rowferry.sinks import write_files

SMALL = "/root/testdata/sf0.001"


def held_by_tasks(spark, act):
    """The most bytes that sorts of one writing stage held while `act` ran."""
    context, group = spark.sparkContext, f"held-{id(act)}"
    context.setLocalProperty("spark.jobGroup.id", group)
    try:
        act()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    scala, tracker = context._jsc.sc(), context.statusTracker()
    scala.listenerBus().waitUntilEmpty(10_000)
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    known = [scala.statusStore().lastStageAttempt(s) for s in stages]
    return max(stage.peakExecutionMemory() for stage in known if stage.outputBytes())


@pytest.mark.parametrize("how", ["write", "append", "compact"])
def test_partitioned_writes_do_not_sort_rows(spark, tmp_path, how):
    rows, path = spark.range(20000).selectExpr("id", "id % 3 AS part"), str(tmp_path / "out")
    given = str(tmp_path / "in")
    rows.repartition(4).write.partitionBy("part").parquet(given)
    act = {
        "write": lambda: write_files(rows, path, "parquet", groupbyfields="part"),
        "append": lambda: append_copy(spark, given, path, "parquet"),
        "compact": lambda: compact(spark, given, "parquet"),
    }[how]
    assert held_by_tasks(spark, act) < 1 << 16
    stored = spark.read.parquet(given if how == "compact" else path)
    assert stored.count() == 20000
    files = stored.groupBy("part").agg(F.count_distinct("_metadata.file_name").alias("n")).collect()
    assert [r["n"] for r in files] == [1, 1, 1]


def test_packed_files_are_told_apart_at_any_size(spark, monkeypatch):
    monkeypatch.setattr(catalogue.changes, "SLICE_BYTES", 30_000)
    session = spark.newSession()
    # a rebalanced write of this size gives several large files
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    found = QUERIES["compact_packed"](session, SMALL).groupBy("part", "kept", "files").count().collect()
    counts = {r["part"]: (r["kept"], r["files"], r["count"]) for r in found}
    lines, orders = (spark.read.parquet(f"{SMALL}/{t}.parquet").count() for t in ("lineitem", "orders"))
    assert counts == {"items": (True, 1, lines), "orders": (False, 1, orders)}


def test_files_of_a_verified_copy_follow_the_table(spark, monkeypatch):
    asked, moved = [], catalogue.verification.moved

    def seen(*args, **options):
        asked.append(options["coalescefilecount"])
        return moved(*args, **options)

    monkeypatch.setattr(catalogue.verification, "moved", seen)
    monkeypatch.setattr(catalogue.verification, "COPY_BYTES", 20_000, raising=False)
    status = [r["status"] for r in QUERIES["verify_sums"](spark, SMALL).collect()]
    assert status == ["succeeded", "failed"] and asked[0] > 3
