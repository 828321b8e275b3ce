from __future__ import annotations

import pytest

from rowferry import job_session, scratch_dir
from rowferry.session import JOB_DEFAULTS, settled


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(shared + "/")
    session = job_session(spark)
    assert scratch_dir(session, "x").startswith(f"{shared}/x-") and scratch_dir(session) != scratch_dir(session)


class Elsewhere:
    """A session on a cluster without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Elsewhere)


def test_job_settings(spark):
    session = job_session(spark, {"spark.sql.session.timeZone": "Europe/Paris", "spark.sql.ansi.enabled": True})
    assert session.conf.get("spark.sql.session.timeZone") == "Europe/Paris"
    assert session.conf.get("spark.sql.ansi.enabled") == "true"
    plain = job_session(spark)
    assert {key: plain.conf.get(key) for key in JOB_DEFAULTS} == JOB_DEFAULTS


def test_stream_settings_of_the_cluster_win(spark):
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    given = spark.newSession()
    given.conf.set(key, "true")
    assert job_session(given).conf.get(key) == "true"
    assert job_session(spark).conf.get(key) == "false"


def test_settled_frames_are_computed_once(spark):
    df = settled(spark.range(100).selectExpr("id", "rand() AS r"))
    assert df.collect() == df.collect() and df.columns == ["id", "r"]
