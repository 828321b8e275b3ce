from __future__ import annotations

import importlib
import json
import os

import pytest
from pyspark.sql import functions as F

from rowferry import JobsFailed, SpecError, job_session, move, report, run_job, run_jobs, transform
from rowferry.__main__ import main
from rowferry.operators import compare_by_key, join_prefixed, verify
from rowferry.operators.history import latest_status
from rowferry.plans import load_document, parse_job, parse_run, redact
from rowferry.plans.spec import masked
from rowferry.plans.templates import expand_inline, first_row_text
from tests.conftest import rows

HELLO = os.path.join(os.path.dirname(__file__), "fixtures", "hello.csv")


def files(path, fileformat, **options):
    return {"platform": "filesystem", "path": str(path), "fileformat": fileformat, **options}


def hello(**options):
    return files(HELLO, "csv", **options)


def test_csv_to_partitioned_json(spark, tmp_path):
    move(spark, {"source": hello(), "destination": files(tmp_path / "out", "json", groupbyfields="IntField")})
    df = spark.read.json(str(tmp_path / "out"))
    assert rows(df.groupBy("IntField").count()) == [(1, 2), (2, 3)]


def test_many_to_many_join(spark):
    session = job_session(spark)
    food, kind, pair = (str(os.path.join(os.path.dirname(HELLO), n)) for n in ("foods.csv", "kinds.csv", "pairs.csv"))
    sources = [files(food, "csv", alias="f"), files(kind, "csv", alias="k"), files(pair, "csv", alias="p")]
    text = "SELECT food, foodtype FROM f JOIN p ON f.foodid = p.foodid JOIN k ON k.foodtypeid = p.foodtypeid"
    got = rows(transform(session, {"sources": sources, "sql": {"query": text}}))
    assert got == [
        ("apple", "fruit"),
        ("banana", "fruit"),
        ("spinach", "vegetable"),
        ("tomato", "fruit"),
        ("tomato", "vegetable"),
    ]


def test_aliases_are_plain_views(spark):
    """An alias that also occurs as a column, in a string or as a regular expression is left alone."""
    text = "SELECT 'x y' AS x, x.HelloField AS y FROM x WHERE x.WorldField = 'WorldValue4'"
    assert rows(transform(spark, {"source": hello(alias="x"), "sql": {"query": text}})) == [("x y", "HelloValue3")]


def test_views_and_settings_stay_in_the_job(spark):
    job = {"source": hello(alias="mine"), "sql": {"query": "SELECT * FROM mine"}, "properties": {"spark.sql.shuffle.partitions": 3}}
    df = transform(spark, job)
    assert df.sparkSession.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert not spark.catalog.tableExists("mine")
    assert df.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC"


def test_shuffles_are_sized_by_the_sources(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.range(0, 100000, 1, 4).write.parquet(str(tmp_path / "in"))
    document = {"source": files(tmp_path / "in", "parquet", alias="t"), "sql": {"query": "SELECT DISTINCT id % 9 AS r FROM t"}}
    assert transform(spark, document).sparkSession.conf.get(key, None) is None
    sizes = {"spark.rowferry.shufflePartitionBytes": 1000, "spark.rowferry.mostShufflePartitions": 300}
    df = transform(spark, {**document, "properties": sizes})
    assert df.sparkSession.conf.get(key) == "300" and df.count() == 9
    given = transform(spark, {**document, "properties": {key: 12}})
    assert given.sparkSession.conf.get(key) == "12"


@pytest.mark.parametrize(
    ("document", "message"),
    [
        ({"destination": {"platform": "console"}}, "needs a source"),
        ({"source": {"platform": "filesystem"}}, "needs a destination"),
        ({"source": {"platform": "x"}, "destination": {"platform": "console"}}, "unknown platform 'x'"),
        ({"source": {"platform": "hive"}, "destination": {"platform": "x"}}, "unknown platform 'x'"),
        ({"sources": [{"platform": "hive"}] * 2, "destination": {"platform": "console"}}, "several sources"),
        (
            {"source": {"platform": "hive"}, "destination": {"platform": "console"}, "sql": {"query": "x"}},
            "alias of its own",
        ),
        (
            {
                "sources": [{"platform": "hive", "alias": "a"}] * 2,
                "destination": {"platform": "console"},
                "sql": {"query": "x"},
            },
            "alias of its own",
        ),
        ({"source": {"platform": "hive"}, "destination": {"platform": "console"}, "sql": {}}, "query or an inputfile"),
    ],
)
def test_bad_specifications(document, message):
    with pytest.raises(SpecError, match=message):
        parse_job(document)


def test_source_and_sources_add_up():
    a, b = ({"platform": "hive", "alias": n} for n in "ab")
    spec = parse_job({"sources": [a], "source": b, "destination": {"platform": "console"}, "sql": {"query": "q"}})
    assert [s["alias"] for s in spec.sources] == ["a", "b"]


def test_a_document_without_migrations_is_the_job():
    document = {"source": {}, "destination": {}}
    assert parse_run(document).jobs == (document,)
    with pytest.raises(SpecError):
        parse_run({"migrations": []})


def test_pointers_are_followed(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"source": {"platform": "hive"}}))
    (tmp_path / "a.json").write_text(json.dumps({"jsoninputfile": {"path": str(tmp_path / "b.json")}}))
    assert load_document(spark, str(tmp_path / "a.json")) == {"source": {"platform": "hive"}}
    (tmp_path / "loop.json").write_text(json.dumps({"jsoninputfile": {"path": str(tmp_path / "loop.json")}}))
    with pytest.raises(SpecError, match="point at each other"):
        load_document(spark, str(tmp_path / "loop.json"))


def test_pointers_pass_settings_on(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"source": {"platform": "hive"}, "verifymigration": "false"}))
    path = f"inlineexpr{{{{select '{tmp_path}/b.json'}}}}"
    document = {"jsoninputfile": {"path": path}, "precisecounts": True, "verifymigration": "true", "cluster": {}}
    loaded = load_document(spark, document)
    assert loaded == {"source": {"platform": "hive"}, "verifymigration": "false", "precisecounts": True}


@pytest.mark.parametrize("fileformat", ["csv", "json", "parquet", "orc"])
def test_verification_of_any_format(spark, tmp_path, fileformat):
    text = "SELECT *, timestamp'2024-05-06 07:08:09.123' AS at, 1.5D AS d, date'2024-01-01' AS day FROM h"
    document = {
        "source": hello(alias="h"),
        "sql": {"query": text},
        "destination": files(tmp_path / "o", fileformat, groupbyfields="IntField"),
    }
    assert run_job(spark, document, verify_job=True).verified == "succeeded"
    # an append is compared with the files that it added
    assert run_job(spark, document, verify_job=True).verified == "succeeded"
    # the folder holds every row twice, and this write is skipped
    document["destination"] = {**document["destination"], "savemode": "ignore"}
    assert run_job(spark, document, verify_job=True).verified == "failed"


def test_verification_of_tables_and_unreadable_sinks(spark, tmp_path):
    spark.sql(f"CREATE TABLE checked (a STRING, b STRING, c INT) USING parquet LOCATION '{tmp_path}/t'")
    try:
        ddl = "HelloField STRING, WorldField STRING, IntField INT"
        result = run_job(spark, {"source": hello(schema=ddl), "destination": {"platform": "hive", "table": "checked"}}, True, True)
        assert (result.error, result.count, result.verified) == (None, 5, "succeeded")
    finally:
        spark.sql("DROP TABLE checked")
    result = run_job(spark, job(True, tmp_path / "x") | {"destination": {"platform": "console"}}, verify_job=True)
    assert (result.error, result.verified) == (None, "NA")


def test_redaction():
    given = {"sources": [{"server": "s", "password": "p", "Login": "l"}], "destination": {"awssecretaccesskey": "k"}}
    assert redact(given) == {"sources": [{"server": "s"}], "destination": {}}


def test_inline_expressions(spark):
    assert first_row_text(spark, "SELECT 1, 'a', NULL") == "1,a,null"
    assert first_row_text(spark, "SELECT 1 WHERE false") == ""
    text = "a inlineexpr{{select 1}} b inlineexpr{{select 'x'}} c"
    assert expand_inline(spark, {"k": [text, 5]}) == {"k": ["a 1 b x c", 5]}


def job(source, target, **options):
    return {"source": hello() if source else files("/nowhere/at/all", "csv"), "destination": files(target, "json"), **options}


def five(tmp_path):
    return [job(good, tmp_path / str(i)) for i, good in enumerate([True, False, False, False, True])]


@pytest.mark.parametrize(
    ("threshold", "statuses"),
    [
        ("3", ["Completed", "Failed", "Failed", "Failed", "SKIPPED"]),
        ("4", ["Completed", "Failed", "Failed", "Failed", "Completed"]),
        (None, ["Completed", "Failed", "Failed", "Failed", "Completed"]),
    ],
)
def test_failure_threshold(spark, tmp_path, threshold, statuses):
    document = {"migrations": five(tmp_path)}
    if threshold:
        document["migration_failure_threshold"] = threshold
    with pytest.raises(JobsFailed) as failure:
        run_jobs(spark, document)
    assert [r.status for r in failure.value.results] == statuses


def test_parallel_jobs_all_run(spark, tmp_path):
    document = {"migrations": five(tmp_path), "parallelmigrations": True, "migration_failure_threshold": "1"}
    results = run_jobs(spark, document, raise_errors=False)
    assert [r.status for r in results] == ["Completed", "Failed", "Failed", "Failed", "Completed"]
    assert os.path.isdir(tmp_path / "4")


def test_parallel_jobs_may_share_an_alias(spark, tmp_path):
    jobs = [
        {
            "source": hello(alias="t"),
            "sql": {"query": f"SELECT * FROM t WHERE IntField = {n}"},
            "destination": files(tmp_path / str(n), "json"),
        }
        for n in (1, 2)
    ]
    run_jobs(spark, {"migrations": jobs, "parallelmigrations": True})
    assert [spark.read.json(str(tmp_path / str(n))).count() for n in (1, 2)] == [2, 3]


def test_counts_verification_history_and_report(spark, tmp_path):
    document = {
        "migrations": [job(True, tmp_path / "a"), job(False, tmp_path / "b")],
        "precisecounts": True,
        "verifymigration": "true",
        "minexecutiontime": "1",
        "maxexecutiontime": "3600",
    }
    history = str(tmp_path / "history")
    results = run_jobs(spark, document, history_path=history, raise_errors=False)
    assert [(r.count, r.verified) for r in results] == [(5, "succeeded"), (None, "NA")]
    jobs = spark.read.parquet(f"{history}/jobs")
    started = [("Started", None, 0)] * 2
    ended = [("Completed", 5, 1), ("Failed", None, 1)]
    assert rows(jobs.select("Status", "Count", "ElapsedTimeInMinutes")) == ended + started
    assert rows(latest_status(jobs.withColumn("MigrationId", F.concat("JobId", "MigrationId"))).select("Status")) == [
        ("Completed",),
        ("Failed",),
    ]
    assert rows(spark.read.parquet(f"{history}/runs").select("Status")) == [("Failed",), ("Started",)]
    assert spark.read.parquet(f"{history}/alerts").count() == 1
    shown = report(spark, results)
    assert rows(shown.select("status", "verification")) == [("Completed", "succeeded"), ("Failed", "NA")]
    assert shown.where(F.col("error").contains("nowhere")).count() == 1


@pytest.mark.parametrize("fileformat", ["json", "sequencefile"])
def test_count_of_any_file_sink(spark, tmp_path, fileformat):
    result = run_job(spark, {"source": hello(), "destination": files(tmp_path / "o", fileformat)}, precise_counts=True)
    assert (result.error, result.count) == (None, 5)


def test_input_counts(spark, tmp_path):
    document = {
        "sources": [hello(alias="a"), files(os.path.join(os.path.dirname(HELLO), "foods.csv"), "csv", alias="b")],
        "sql": {"query": "SELECT a.* FROM a WHERE a.IntField = 1"},
        "destination": files(tmp_path / "o", "json"),
        "inputcounts": "true",
    }
    (result,) = run_jobs(spark, document)
    assert result.read == {"a": 5, "b": 4}


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "job.json").write_text(json.dumps({"source": hello(), "destination": files(tmp_path / "o", "json")}))
    assert main([str(tmp_path / "job.json"), "--history", str(tmp_path / "h")], spark) == 0
    assert "Completed" in capsys.readouterr().out
    (tmp_path / "bad.json").write_text(json.dumps(job(False, tmp_path / "p")))
    assert main([str(tmp_path / "bad.json")], spark) == 1
    assert spark.read.parquet(str(tmp_path / "h" / "runs")).count() == 2


def test_report_hides_credentials(spark):
    result = run_job(spark, {"source": {"platform": "floppy", "password": "geheim"}, "destination": {"platform": "console"}})
    assert result.status == "Failed" and "geheim" not in result.sources


def test_command_order(spark, folder):
    log = f"INSERT INTO job_log SELECT '{{}}', count(*) FROM job_log"
    spark.sql(f"CREATE TABLE job_log (step STRING, n BIGINT) USING parquet LOCATION '{folder}'")
    try:
        move(
            spark,
            {
                "sources": [
                    hello(alias="a", pre_migrate_command=log.format("a pre"), post_migrate_command=log.format("a post")),
                    hello(alias="b", pre_migrate_commands=[{"query": log.format("b pre")}]),
                ],
                "sql": {"query": "SELECT a.HelloField FROM a JOIN b ON a.WorldField = b.WorldField"},
                "destination": {
                    "platform": "console",
                    "pre_migrate_command": log.format("sink pre"),
                    "post_migrate_command": {"query": log.format("sink post")},
                },
            },
        )
        steps = [r[0] for r in spark.table("job_log").orderBy("n").collect()]
        assert steps == ["a pre", "b pre", "sink pre", "a post", "sink post"]
    finally:
        spark.sql("DROP TABLE job_log")


def test_delete_command(spark, tmp_path):
    spark.range(2).write.json(str(tmp_path / "old"))
    command = {"operation": "delete", "path": str(tmp_path / "old")}
    move(spark, {"source": hello(), "destination": files(tmp_path / "new", "json", pre_migrate_command=command)})
    assert not os.path.exists(tmp_path / "old") and os.path.exists(tmp_path / "new")
    with pytest.raises(ValueError, match="unknown command operation"):
        move(spark, {"source": hello(), "destination": files(tmp_path / "x", "json", pre_migrate_command={"operation": "?"})})


def test_custom_functions_in_sql_and_file(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT validateUUID(HelloField) AS v FROM h")
    by_file = transform(spark, {"source": hello(alias="h"), "sql": {"inputfile": {"path": str(tmp_path / "q.sql")}}})
    assert rows(by_file.distinct()) == [(False,)]


def test_verification_twice_in_one_session(spark):
    df = spark.range(3)
    assert verify(df, df).first()["status"] == "succeeded"
    assert verify(df, spark.range(4)).first()["status"] == "failed"
    assert verify(spark.range(0), spark.range(0)).first()["status"] == "succeeded"
    twice = df.union(df)
    assert verify(twice, twice).first()["status"] == "failed"
    assert verify(twice, twice, "multiset").first()["status"] == "succeeded"
    assert verify(twice, df, "multiset").first()["status"] == "failed"


def test_compare_by_key(spark):
    a = spark.sql("SELECT * FROM VALUES (1, 'x', 1), (2, NULL, 2), (3, 'z', 3) AS t(k, s, n)")
    b = spark.sql("SELECT * FROM VALUES (1, 'x', '1'), (2, 'y', '9'), (4, 'q', '4') AS t(k, s, n)")
    assert rows(compare_by_key(a, b, "k")) == [
        (2, "different", "n", "2", "9"),
        (3, "missing in destination", None, None, None),
        (4, "missing in source", None, None, None),
    ]
    assert rows(compare_by_key(a.select("k"), a.select("k"), "k")) == []
    with pytest.raises(Exception, match="repeated key: 1"):
        compare_by_key(a.union(a.where("k = 1")), b, "k").collect()


def test_join_prefixed_can_be_written(spark, folder):
    df = transform(spark, {"source": hello()})
    joined = join_prefixed({"X": df, "Y": df, "Z": df}, "WorldField")
    joined.write.parquet(folder)
    assert joined.columns[0] == "X_HelloField" and len(set(joined.columns)) == 9
    text = "SELECT X.*, Y.* FROM X JOIN Y ON X.WorldField = Y.WorldField"
    with pytest.raises(ValueError, match="more than once"):
        move(
            spark,
            {
                "sources": [hello(alias="X"), hello(alias="Y")],
                "sql": {"query": text},
                "destination": files(folder + "2", "parquet"),
            },
        )


def test_credentials_stay_hidden():
    options = {
        "spark.cassandra.auth.password": "hidden1",
        "kafka.sasl.jaas.config": "hidden2",
        "es.net.http.auth.pass": "hidden3",
        "sfPassword": "hidden4",
        "pem_private_key": "hidden5",
        "fs.s3a.secret.key": "hidden6",
        "primarykey": "shown1",
        "keyformat": "shown2",
    }
    given = {"source": {"url": "jdbc:x://me:hidden7@h/d?user=a&password=hidden8", "sparkoptions": options}}
    shown = str(redact(given))
    assert "hidden" not in shown and "shown1" in shown and "shown2" in shown
    error = masked("login with hidden3 to jdbc:x://me:hidden7@h failed: password=hidden8;", given)
    assert "hidden" not in error and "failed" in error


@pytest.mark.parametrize("fileformat", ["json", "csv", "parquet"])
def test_an_append_is_verified_by_its_own_files(spark, tmp_path, fileformat):
    document = {"source": hello(), "destination": files(tmp_path / "o", fileformat, savemode="append")}
    for _ in range(2):
        result = run_job(spark, document, verify_job=True)
        assert (result.error, result.verified) == (None, "succeeded")


@pytest.mark.parametrize("name", ["plain", "with space", "per%cent"])
def test_appends_into_odd_paths_are_verified(spark, tmp_path, name):
    """Also with partitions of odd names, and with values that are new in every run."""
    sql = {"query": "SELECT HelloField, uuid() AS u, 'a b%' AS p FROM A"}
    destination = files(tmp_path / name, "parquet", savemode="append", groupbyfields="p")
    document = {"source": {**hello(), "alias": "A"}, "sql": sql, "destination": destination}
    for _ in range(2):
        result = run_job(spark, document, verify_job=True, precise_counts=True)
        assert (result.error, result.verified) == (None, "succeeded") and result.count > 0


def test_a_change_of_what_was_written_fails_verification(spark, tmp_path, monkeypatch):
    from rowferry.plans import job

    real = job.read_back
    monkeypatch.setattr(job, "read_back", lambda *args: real(*args).limit(1).union(real(*args).limit(1)))
    result = run_job(spark, {"source": hello(), "destination": files(tmp_path / "o", "parquet")}, verify_job=True)
    assert result.error is None and result.verified == "failed"


@pytest.mark.parametrize("sink", ["keyed", "sequence", "console", "ignored", "raw"])
def test_counts_need_no_second_run(spark, tmp_path, sink):
    """The rows are counted on their way into any sink: the SQL reads its source once."""
    counter = spark.sparkContext.accumulator(0)
    spark.udf.register("seen", lambda x: counter.add(1) or str(x))
    path = str(tmp_path / "o")
    if sink == "ignored":
        spark.range(1).write.parquet(path)
    destination = {
        "keyed": files(path, "parquet", savemode="upsert", mappingid="id"),
        "sequence": files(path, "sequencefile"),
        "console": {"platform": "console", "numrows": 2},
        "ignored": files(path, "parquet", savemode="ignore"),
        "raw": files(path, "json", rowfromjsonstring=True),
    }[sink]
    spark.range(50).write.parquet(str(tmp_path / "i"))
    source = files(tmp_path / "i", "parquet", alias="A")
    session = job_session(spark)
    session.udf.register("seen", lambda x: counter.add(1) or str(x))
    query = "SELECT to_json(struct(seen(id) AS v)) AS j FROM A" if sink == "raw" else "SELECT id, seen(id) AS v FROM A"
    from rowferry.plans import job

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(job, "prepared_session", lambda *_: session)
        moved = move(spark, {"source": source, "sql": {"query": query}, "destination": destination}, count=True)
    assert moved.count == 50 and counter.value == 50


def test_sums_need_no_exchange_of_rows(spark, tmp_path):
    from rowferry.operators.verify import verify

    spark.range(1000).selectExpr("id", "array(id, null) AS a", "map(id, 'x') AS m").write.parquet(str(tmp_path / "a"))
    df = spark.read.parquet(str(tmp_path / "a"))
    plan = verify(df, df, "sums")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    for other, status in (
        (df.orderBy(F.desc("id")), "succeeded"),
        (df.where("id != 5"), "failed"),
        (df.where("id != 5").union(df.where("id = 6")), "failed"),
        (df.selectExpr("id", "array(null, id) AS a", "m"), "failed"),
        (df.selectExpr("if(id < 2, 1 - id, id) AS id", "a", "m"), "failed"),
    ):
        assert verify(df, other, "sums").first()["status"] == status
        assert verify(df, other, "multiset").first()["status"] == status
    assert verify(df.limit(0), df.limit(0), "sums").first()["status"] == "succeeded"
    nulls = spark.sql("SELECT * FROM VALUES (NULL, 1), (1, NULL) AS t(a, b)")
    assert verify(nulls.limit(1), nulls.offset(1), "sums").first()["status"] == "failed"


@pytest.mark.parametrize("size", [0, 1 << 40])
def test_comparison_by_ranges(spark, tmp_path, monkeypatch, size):
    """Both ways give the same findings; by ranges only rows near a difference are joined."""
    module = importlib.import_module("rowferry.operators.verify")
    monkeypatch.setattr(module, "is_small", lambda df: size > 0)
    a = spark.range(20_000).selectExpr("id AS k", "id % 7 AS v", "if(id % 3 = 0, NULL, id) AS n")
    b = spark.range(20_000).selectExpr("cast(id AS int) AS k", "if(id IN (5, 777), -1, id % 7) AS v", "if(id = 300, 9, id) AS n")
    b = b.where("k != 42").union(spark.sql("SELECT 90000, 0L, 0L"))
    found = rows(compare_by_key(a, b, "k"))
    assert [r[:3] for r in found] == [(42, "missing in destination", None), (5, "different", "v"), (777, "different", "v"), (90000, "missing in source", None)]
    if not size:
        same = a.withColumn("v", F.when(F.col("k") == 11, 99).otherwise(F.col("v")))
        left, right = module._differing(a, same, ["k"], ["v", "n"])
        assert 1 <= left.count() <= 20 and 1 <= right.count() <= 20
        left, right = module._differing(a, a, ["k"], ["v", "n"])
        assert left.count() == right.count() == 0
    with pytest.raises(Exception, match="null or repeated key: 3"):
        compare_by_key(a.union(a.where("k = 3")), b, "k").collect()
    with pytest.raises(Exception, match="null or repeated key: null"):
        compare_by_key(a, a.union(spark.sql("SELECT NULL, 0L, 0L")), "k").collect()
