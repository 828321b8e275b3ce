from __future__ import annotations

import glob
import os

import pytest

from rowferry.operators import delete_rows, keyed_write, unique_by_key, write_documents
from rowferry.operators.datasets import setting
from rowferry.operators.keyed import write_keyed_files
from rowferry.session import is_small
from tests.conftest import rows

SCHEMA = "id int, a string, b string"
STORED = [(1, "a1", "b1"), (2, "a2", None), (3, "a3", "b3")]


@pytest.fixture(params=["small", "large"])
def path_of_plan(spark, request):
    """Both plans: changes below and above the broadcast limit."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "10485760" if request.param == "small" else "-1"):
        yield request.param


def frame(spark, data, schema=SCHEMA):
    """A frame whose size Catalyst knows; frames made from Python objects have none."""
    literal = lambda v: "NULL" if v is None else repr(v)
    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in data)
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = ", ".join(f"cast(col{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(fields, 1))
    return spark.sql(f"SELECT {columns} FROM VALUES {values}")


def test_both_plans_are_covered(spark, path_of_plan):
    assert is_small(frame(spark, STORED)) is (path_of_plan == "small")
    assert not is_small(spark.createDataFrame(STORED, SCHEMA))


@pytest.mark.parametrize(
    ("mode", "given", "expected"),
    [
        ("index", [(2, None, "n2"), (4, "a4", "b4")], [(1, "a1", "b1"), (2, None, "n2"), (3, "a3", "b3"), (4, "a4", "b4")]),
        ("create", [(4, "a4", None)], [(1, "a1", "b1"), (2, "a2", None), (3, "a3", "b3"), (4, "a4", None)]),
        ("update", [(2, None, "n2")], [(1, "a1", "b1"), (2, "a2", "n2"), (3, "a3", "b3")]),
        ("upsert", [(3, "n3", None), (4, None, "b4")], [(1, "a1", "b1"), (2, "a2", None), (3, "n3", "b3"), (4, None, "b4")]),
    ],
)
def test_modes(spark, path_of_plan, mode, given, expected):
    got = keyed_write(frame(spark, STORED), frame(spark, given), "id", mode)
    assert rows(got) == sorted(expected, key=repr)


def test_nulls_can_overwrite(spark, path_of_plan):
    got = keyed_write(frame(spark, STORED), frame(spark, [(3, None, "n3")]), "id", "upsert", ignore_nulls=False)
    assert (3, None, "n3") in rows(got)
    assert (1, "a1", "b1") in rows(got)


@pytest.mark.parametrize(
    ("mode", "given", "message"),
    [
        ("create", [(9, "x", "y"), (2, "x", "y")], "exists already: 2"),
        ("update", [(1, "x", "y"), (9, "x", "y")], "does not exist: 9"),
        ("index", [(5, "x", "y"), (5, "z", "y")], "null or repeated key: 5"),
        ("upsert", [(None, "x", "y")], "null or repeated key: null"),
    ],
)
def test_broken_rules_fail(spark, path_of_plan, mode, given, message):
    df = keyed_write(frame(spark, STORED), frame(spark, given), "id", mode)
    with pytest.raises(Exception, match=message):
        df.collect()


@pytest.mark.parametrize(("mode", "given"), [("create", [(2, "x", "y")]), ("update", [(9, "x", "y")])])
def test_rules_hold_for_a_mere_count(spark, path_of_plan, mode, given):
    with pytest.raises(Exception, match="exist"):
        keyed_write(frame(spark, STORED), frame(spark, given), "id", mode).count()


def test_changes_may_bring_and_lack_columns(spark, path_of_plan):
    given = frame(spark, [(1, "n1", 7), (4, "n4", 8)], "id int, a string, c int")
    got = keyed_write(frame(spark, STORED), given, "id", "upsert")
    assert got.columns == ["id", "a", "b", "c"]
    assert rows(got) == sorted(
        [(1, "n1", "b1", 7), (2, "a2", None, None), (3, "a3", "b3", None), (4, "n4", None, 8)], key=repr
    )


def test_compound_keys(spark, path_of_plan):
    schema = "x int, y string, v int"
    stored, given = frame(spark, [(1, "p", 1), (1, "q", 2)], schema), frame(spark, [(1, "q", 5), (2, "p", 6)], schema)
    assert rows(keyed_write(stored, given, "x, y", "upsert")) == [(1, "p", 1), (1, "q", 5), (2, "p", 6)]


def test_unique_by_key_keeps_the_rows(spark):
    assert rows(unique_by_key(frame(spark, STORED), "id")) == rows(frame(spark, STORED))


def test_small_changes_leave_the_target_unshuffled(spark, folder):
    spark.range(0, 1000).selectExpr("id", "cast(id AS string) a").write.parquet(folder)
    target = spark.read.parquet(folder)
    changes = frame(spark, [(1, "x")], "id bigint, a string")
    for mode in ("index", "update", "upsert"):
        plan = keyed_write(target, changes, "id", mode)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_delete_by_selection(spark, path_of_plan):
    selection = frame(spark, [(1, "x", "y"), (1, "x", "y"), (7, "x", "y")])
    assert [r[0] for r in rows(delete_rows(frame(spark, STORED), selection, "id"))] == [2, 3]


def test_documents(spark):
    stored = frame(spark, [(1, "n", "s")], "_id int, name string, segment string")
    given = frame(spark, [(1, "m"), (2, "k")], "_id int, name string")
    assert rows(write_documents(stored, given)) == [(1, "m", None), (2, "k", None)]
    assert rows(write_documents(stored, given, replacedocuments=False)) == [(1, "m", "s"), (2, "k", None)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="unknown keyed mode"):
        keyed_write(frame(spark, STORED), frame(spark, STORED), "id", "sideways")


@pytest.mark.parametrize("fileformat", ["parquet", "orc", "json"])
def test_keyed_files(spark, folder, fileformat):
    write_keyed_files(frame(spark, STORED), folder, fileformat, "id", "create")
    with pytest.raises(Exception, match="exists already: 3"):
        write_keyed_files(frame(spark, [(3, "x", "y")]), folder, fileformat, "id", "create")
    write_keyed_files(frame(spark, [(3, None, "n3")]), folder, fileformat, "id", "update")
    write_keyed_files(frame(spark, [(4, "a4", "b4")]), folder, fileformat, "id", "upsert")
    got = spark.read.format(fileformat).load(folder).select("id", "a", "b")
    assert rows(got) == sorted([(1, "a1", "b1"), (2, "a2", None), (3, "a3", "n3"), (4, "a4", "b4")], key=repr)


def test_keyed_files_refuse_untyped_formats(spark, folder):
    with pytest.raises(ValueError, match="keyed modes need"):
        write_keyed_files(frame(spark, STORED), folder, "csv", "id", "index")


@pytest.mark.parametrize("mode", ["index", "upsert"])
def test_keyed_files_rewrite_touched_partitions_only(spark, folder, path_of_plan, mode):
    schema = "id int, day string, a string"
    stored = [(1, "01", "a1"), (2, "01", "a2"), (3, "02", "a3"), (4, "03", None)]
    write_keyed_files(frame(spark, stored, schema), folder, "parquet", "id", "create", "day")
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/day=0[13]/*.parquet")}
    changes = frame(spark, [(3, "02", "n3"), (9, "02", "a9"), (1, "04", "a1")], schema)
    write_keyed_files(changes, folder, "parquet", "id", mode, "day")
    assert {f: os.stat(f).st_mtime_ns for f in before} == before and len(before) == 2
    got = spark.read.schema(schema).parquet(folder).select("id", "day", "a")
    assert rows(got) == sorted(
        [(1, "01", "a1"), (2, "01", "a2"), (3, "02", "n3"), (9, "02", "a9"), (4, "03", None), (1, "04", "a1")], key=repr
    )
    with pytest.raises(Exception, match="exists already: 02, 9"):
        write_keyed_files(frame(spark, [(9, "02", "x")], schema), folder, "parquet", "id", "create", "day")


@pytest.mark.parametrize("mode", ["index", "create", "update", "upsert"])
def test_both_plans_give_the_same_columns(spark, mode):
    stored = frame(spark, [("s", 1, 1.5)], "a string, id int, v double")
    given = frame(spark, [(7, 1 if mode in ("index", "update", "upsert") else 2, "n")], "v int, id bigint, b string")
    results = []
    for limit in ("10485760", "-1"):
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", limit):
            got = keyed_write(stored, given, "id", mode)
            results.append((got.schema.simpleString(), rows(got)))
    assert results[0] == results[1]
    assert results[0][0] == "struct<a:string,id:int,v:double,b:string>"


def test_values_that_do_not_fit_fail(spark, path_of_plan):
    stored = frame(spark, [(1, 5)], "id int, v int")
    for given in (frame(spark, [(1, "x")], "id int, v string"), frame(spark, [(1, 2.5)], "id int, v double")):
        with pytest.raises(Exception, match="v cannot hold the value"):
            keyed_write(stored, given, "id", "upsert").collect()
    assert rows(keyed_write(stored, frame(spark, [(1, "07")], "id int, v string"), "id", "upsert")) == [(1, 7)]


@pytest.mark.parametrize("mode", ["update", "upsert"])
def test_repeated_target_keys_fail(spark, path_of_plan, mode):
    stored = frame(spark, [(1, "a", "b"), (1, "c", "d"), (2, "e", "f")])
    with pytest.raises(Exception, match="repeated key in the target: 1"):
        keyed_write(stored, frame(spark, [(1, "x", "y")]), "id", mode).collect()


def test_changes_are_computed_once(spark, folder):
    """Partitions that an unstable change names are those that are read and rewritten; no other row is lost."""
    spark.range(4000).selectExpr("id", "id % 20 AS p", "'old' AS v").write.partitionBy("p").parquet(folder)
    changes = spark.range(1).selectExpr("4000 + id AS id", "cast(rand() * 20 AS bigint) AS p", "'new' AS v")
    for attempt in range(3):
        write_keyed_files(changes.withColumn("id", changes.id + attempt), folder, "parquet", "id", "index", "p")
        assert spark.read.parquet(folder).count() == 4001 + attempt


def test_layout_is_kept(spark, folder):
    spark.range(20).selectExpr("id", "cast(id % 3 AS int) AS p", "'old' AS v").write.partitionBy("p").parquet(folder)
    changes = spark.range(2).selectExpr("id", "cast(id % 3 AS int) AS p", "'new' AS v")
    write_keyed_files(changes, folder, "parquet", "id", "upsert")
    assert sorted(os.path.basename(d) for d in glob.glob(f"{folder}/p=*")) == ["p=0", "p=1", "p=2"]
    got = spark.read.parquet(folder)
    assert got.schema["p"].dataType.simpleString() == "int" and got.where("v = 'new'").count() == 2
