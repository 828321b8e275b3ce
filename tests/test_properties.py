"""Operators against brute force on generated rows."""

from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowferry.operators import compact_changes, keyed_write, latest_per_key, missing_rows, verify

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
VALUES = st.one_of(st.none(), st.integers(0, 3))
TABLE = st.dictionaries(st.integers(0, 6), st.tuples(VALUES, VALUES), max_size=6)
ROWS = st.lists(st.tuples(st.integers(0, 3), VALUES, st.integers(0, 50)), max_size=12)


def table(spark, content):
    return spark.createDataFrame([(k, *v) for k, v in content.items()], "k int, a int, b int")


@SLOW
@given(stored=TABLE, given_rows=TABLE)
def test_upsert_and_index(spark, stored, given_rows):
    target, changes = table(spark, stored), table(spark, given_rows)
    merged = dict(stored)
    for k, new in given_rows.items():
        old = stored.get(k, (None, None))
        merged[k] = tuple(o if n is None else n for n, o in zip(new, old))
    got = {r["k"]: (r["a"], r["b"]) for r in keyed_write(target, changes, "k", "upsert").collect()}
    assert got == merged
    got = {r["k"]: (r["a"], r["b"]) for r in keyed_write(target, changes, "k", "index").collect()}
    assert got == {**stored, **given_rows}


@SLOW
@given(left=ROWS, right=ROWS)
def test_verification(spark, left, right):
    schema = "k int, a int, n int"
    row = verify(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "multiset").first()
    difference = sum((Counter(left) - Counter(right)).values()) + sum((Counter(right) - Counter(left)).values())
    assert row["difference"] == difference
    assert (row["source_count"], row["destination_count"]) == (len(left), len(right))
    assert row["union_count"] == len(set(left) | set(right))
    assert row["status"] == ("failed" if difference else "succeeded")


@SLOW
@given(given_rows=ROWS)
def test_latest(spark, given_rows):
    df = latest_per_key(spark.createDataFrame(given_rows, "k int, a int, n int"), "k", [F.desc("n")])
    expected = {}
    for k, _, n in given_rows:
        expected[k] = max(n, expected.get(k, -1))
    assert {r["k"]: r["n"] for r in df.collect()} == expected


@SLOW
@given(left=ROWS, right=ROWS)
def test_missing(spark, left, right):
    schema = "k int, a int, n int"
    got = missing_rows(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "k,a").collect()
    held = {(k, a) for k, a, _ in right if a is not None}
    assert Counter(tuple(r[c] for c in ("k", "a", "n")) for r in got) == Counter(r for r in left if r[:2] not in held)


@SLOW
@given(
    base=st.dictionaries(st.integers(0, 5), st.tuples(VALUES, st.integers(0, 9)), max_size=6),
    log=st.lists(st.tuples(st.integers(0, 5), VALUES, st.integers(10, 99), st.booleans()), max_size=8, unique_by=lambda r: r[2]),
)
def test_compaction(spark, base, log):
    columns = "k int, part int, n int"
    stored = spark.createDataFrame([(k, p, n) for k, (p, n) in base.items()], columns)
    changes = spark.createDataFrame(log, f"{columns}, gone boolean")
    # numbers stand in for dates, so a deleted row carries no date at all
    got = compact_changes(stored, changes, "k", "part", "n", F.col("gone"), drop_deletes=True)
    touched = {p for _, p, _, _ in log}
    expected = {k: (p, n) for k, (p, n) in base.items() if p in touched}
    for k, p, n, _ in sorted(log, key=lambda r: r[2]):
        expected[k] = (p, n)
    for k, _, _, gone in log:
        if gone:
            expected.pop(k, None)
    assert {r["k"]: (r["part"], r["n"]) for r in got.collect()} == expected
