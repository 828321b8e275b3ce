"""Replacements of files that are lost half way, files that stay as they are, and packed files."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from rowferry.operators import compact, copy_partitions, append_copy, replace_partitions, rewrite_dataset
from rowferry.operators import swap
from rowferry.operators.datasets import packed, setting
from rowferry.operators.keyed import delete_keyed_files, write_keyed_files
from rowferry.operators.swap import recover, swap_folder
from rowferry.plans.job import run_commands
from rowferry.session import Files
from tests.conftest import rows

CHANGING = ("rename", "delete", "make_folder", "write_text")


class Lost(BaseException):
    """The driver is gone: from some step on nothing it does takes effect."""


def lost_after(monkeypatch, steps):
    """Let the first `steps` changes of files happen; returns a counter of those that were tried."""
    tried = []

    def guarded(name, real):
        def call(self, *args):
            if any("-swap" in str(a) or "data" in str(a) for a in args):
                tried.append(name)
                if len(tried) > steps:
                    raise Lost
            return real(self, *args)

        return call

    for name in CHANGING:
        monkeypatch.setattr(Files, name, guarded(name, getattr(Files, name)))
    monkeypatch.setattr(swap, "THREADS", 1)
    return tried


def data(spark, folder):
    spark.range(24).selectExpr("id", "id % 3 AS p", "'old' AS v").repartition(2).write.partitionBy("p").parquet(folder)


def files(folder):
    return sorted(os.path.relpath(f, folder) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True))


def rewritten(spark, folder):
    new = spark.read.parquet(folder).selectExpr("id + 100 AS id", "'new' AS v", "p")
    rewrite_dataset(new, folder, "parquet", ["p"])


def replaced(spark, folder):
    new = spark.range(2).selectExpr("id + 100 AS id", "'new' AS v", "cast(id AS string) AS p")
    replace_partitions(new, folder, "parquet", ["p"], spark.range(3).selectExpr("id AS p"))


def upserted(spark, folder):
    new = spark.range(1, 27, 5).selectExpr("id", "'new' AS v", "id % 3 AS p")
    write_keyed_files(new, folder, "parquet", "id", "upsert", "p")


def packed_anew(spark, folder):
    compact(spark, folder, "parquet")


def deleted(spark, folder):
    delete_keyed_files(spark.range(0, 24, 3), folder, "parquet", "id")


@pytest.mark.parametrize("change", [rewritten, replaced, upserted, packed_anew, deleted])
def test_a_lost_run_leaves_all_old_or_all_new_rows(spark, tmp_path, monkeypatch, change):
    content = lambda folder: rows(spark.read.parquet(folder).select("id", "v", "p"))
    data(spark, str(tmp_path / "data-old"))
    data(spark, str(tmp_path / "data-new"))
    old = content(str(tmp_path / "data-old"))
    change(spark, str(tmp_path / "data-new"))
    new = content(str(tmp_path / "data-new"))
    step, ended, seen = 0, False, set()
    while not ended:
        folder = str(tmp_path / f"data{step}")
        data(spark, folder)
        with monkeypatch.context() as patch:
            tried = lost_after(patch, step)
            try:
                change(spark, folder)
                ended = True
            except Lost:
                pass
        met = content(folder)
        # a reader in between may meet rows twice, never fewer
        assert set(met) >= set(old) or set(met) >= set(new), step
        found = recover(spark, folder)
        assert found in (None, "undone", "finished")
        after = content(folder)
        assert after == (new if found == "finished" or ended else old) or (found is None and after == new), (step, found)
        assert not os.path.exists(swap_folder(folder))
        seen.add(found)
        step += 1
    assert {"undone", "finished"} <= seen and step == len(tried) + 1


def test_the_next_write_finishes_a_lost_one(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "data")
    spark.range(1000).selectExpr("id", "'old' AS v").repartition(4).write.parquet(folder)
    with monkeypatch.context() as patch:
        lost_after(patch, 5)
        with pytest.raises(Lost):
            rewritten_all = spark.read.parquet(folder).selectExpr("id", "'new' AS v")
            rewrite_dataset(rewritten_all, folder, "parquet")
    write_keyed_files(spark.sql("SELECT 5L AS id, 'last' AS v"), folder, "parquet", "id", "upsert")
    got = spark.read.parquet(folder).groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in got} == {"new": 999, "last": 1}


def test_rows_that_were_read_half_way_are_refused(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "data")
    data(spark, folder)
    with monkeypatch.context() as patch:
        lost_after(patch, 6)
        with pytest.raises(Lost):
            rewritten(spark, folder)
    half = spark.read.parquet(folder)
    with pytest.raises(RuntimeError, match="read it again"):
        rewrite_dataset(half, folder, "parquet", ["p"])
    assert spark.read.parquet(folder).count() == 24


@pytest.mark.parametrize("limit", ["10485760", "-1"])
@pytest.mark.parametrize("partitioned", [False, True])
def test_an_upsert_rewrites_only_files_with_its_keys(spark, tmp_path, limit, partitioned):
    folder = str(tmp_path / "data x")
    df = spark.range(0, 4000, 1, 200).selectExpr("id", "id div 400 AS p", "cast(id AS string) AS v")
    (df.write.partitionBy("p") if partitioned else df.write).parquet(folder)
    before = files(folder)
    assert len(before) == 200
    changes = spark.sql("SELECT explode(sequence(0L, 4500L, 500L)) AS id, 'new' AS v").selectExpr("id", "id div 400 AS p", "v")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", limit):
        write_keyed_files(changes, folder, "parquet", "id", "upsert", "p" if partitioned else ())
    kept = set(before) & set(files(folder))
    assert 190 <= len(kept) <= 192
    got = {r["id"]: r["v"] for r in spark.read.parquet(folder).collect()}
    assert got == {i: "new" if i % 500 == 0 else str(i) for i in [*range(4000), 4000, 4500]}


def test_a_delete_rewrites_only_files_with_its_keys(spark, folder):
    spark.range(0, 1000, 1, 20).selectExpr("id", "id * 2 AS v").write.parquet(folder)
    before = files(folder)
    run_commands(spark, {"post_migrate_command": {"operation": "delete_rows", "path": folder, "selection": "SELECT 70L AS id UNION ALL SELECT 71L", "mappingid": "id"}}, "post")
    assert len(set(before) & set(files(folder))) == 19
    assert spark.read.parquet(folder).count() == 998
    delete_keyed_files(spark.range(5000, 5003), folder, "parquet", "id")
    assert spark.read.parquet(folder).count() == 998


def test_only_touched_files_are_read_for_the_rewrite(spark, folder):
    from rowferry.operators.datasets import files_of, file_uri

    spark.range(0, 1000, 1, 20).write.parquet(folder)
    one = files_of(spark.read.parquet(folder), [file_uri(spark, folder, files(folder)[3])])
    assert one.count() == 50
    execution = one._jdf.queryExecution()
    execution.toRdd().count()
    assert execution.executedPlan().collectLeaves().head().metrics().apply("numFiles").value() == 1


def test_a_new_column_comes_to_every_file(spark, folder):
    spark.range(0, 40, 1, 4).write.parquet(folder)
    write_keyed_files(spark.sql("SELECT 3L AS id, 'x' AS note"), folder, "parquet", "id", "upsert")
    assert all("note" in spark.read.parquet(f"{folder}/{f}").columns for f in files(folder))
    assert spark.read.parquet(folder).count() == 40


def test_keys_of_no_file(spark, folder):
    spark.range(0, 40, 1, 4).selectExpr("id", "'a' AS v").write.parquet(folder)
    before = files(folder)
    new = spark.sql("SELECT 100L AS id, 'n' AS v")
    with pytest.raises(Exception, match="does not exist: 100"):
        write_keyed_files(new, folder, "parquet", "id", "update")
    assert files(folder) == before
    write_keyed_files(new, folder, "parquet", "id", "create")
    assert set(before) < set(files(folder)) and spark.read.parquet(folder).count() == 41
    with pytest.raises(Exception, match="exists already: 100"):
        write_keyed_files(new, folder, "parquet", "id", "create")


def test_bins():
    sizes = {"a": 60, "b": 50, "c": 40, "d": 30, "e": 20, "f": 10, "g": 200}
    bins = packed(sizes, 100)
    assert sorted(map(sorted, bins)) == [["a", "c"], ["b", "d", "e"], ["f"], ["g"]]
    many = packed({str(i): 10 for i in range(1000)}, 100)
    assert len(many) == 100 and packed({}, 5) == []


def test_large_files_stay_and_small_ones_are_packed(spark, folder):
    def add(low, high, tag, pieces):
        spark.range(low, high, 1, pieces).selectExpr("id", f"'{tag}' AS p", "sha2(cast(id AS string), 256) AS v").write.mode("append").partitionBy("p").parquet(folder)

    add(0, 20_000, "x", 1)
    add(20_000, 20_400, "x", 8)
    add(0, 300, "y z", 6)
    add(0, 30, "w", 1)
    large = max((f for f in files(folder)), key=lambda f: os.path.getsize(f"{folder}/{f}"))
    before = files(folder)
    total = rows(spark.read.parquet(folder))
    compact(spark, folder, "parquet", target_bytes=os.path.getsize(f"{folder}/{large}"))
    after = files(folder)
    assert large in after and sum(f.startswith("p=x") for f in after) == 2 and sum(f.startswith("p=y") for f in after) == 1
    assert [f for f in after if f.startswith("p=w")] == [f for f in before if f.startswith("p=w")]
    assert rows(spark.read.parquet(folder)) == total
    compact(spark, folder, "parquet", target_bytes=os.path.getsize(f"{folder}/{large}"))
    assert files(folder) == after


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_file_count_holds_for_every_partition(spark, folder, partitioned):
    df = spark.range(0, 3000, 1, 7).selectExpr("id", "id % 3 AS p")
    (df.write.partitionBy("p") if partitioned else df.write).parquet(folder)
    compact(spark, folder, "parquet", filecount=4)
    assert len(files(folder)) == (12 if partitioned else 4)
    assert rows(spark.read.parquet(folder)) == rows(df)
    counts = [spark.read.parquet(f"{folder}/{f}").count() for f in files(folder)]
    assert max(counts) - min(counts) <= max(counts) // 4
    before = files(folder)
    compact(spark, folder, "parquet", filecount=4)
    assert files(folder) == before


def test_other_layouts_are_refused(spark, tmp_path):
    a, b, c = (str(tmp_path / x) for x in "abc")
    spark.range(4).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(a)
    spark.range(4).selectExpr("id", "id % 2 AS o").write.partitionBy("o").parquet(b)
    spark.range(4).write.parquet(c)
    for call in (lambda: append_copy(spark, a, b, "parquet"), lambda: copy_partitions(spark, a, b, "parquet"), lambda: append_copy(spark, c, a, "parquet")):
        with pytest.raises(ValueError, match="is partitioned by"):
            call()
    with pytest.raises(ValueError, match="is partitioned by o"):
        write_keyed_files(spark.range(2).selectExpr("id", "id % 2 AS p"), b, "parquet", "id", "upsert", "p")
    assert spark.read.parquet(b).count() == 4 and spark.read.parquet(a).count() == 4


def test_many_partitions_are_replaced_at_once(spark, folder):
    spark.range(60).selectExpr("id", "id % 30 AS p").write.partitionBy("p").parquet(folder)
    kept = spark.range(60).selectExpr("id", "cast(id % 30 AS string) AS p").where("p % 2 = 0")
    replace_partitions(kept.where("id < 30"), folder, "parquet", ["p"], spark.range(30).selectExpr("id AS p"))
    assert sorted(r["id"] for r in spark.read.parquet(folder).collect()) == list(range(0, 30, 2))
    assert len(glob.glob(f"{folder}/p=*")) == 15
