from collections import defaultdict

import pytest

from rowferry.llm.source_mix import mix_sources, numbered, source_targets
from tests.llm.data import documents, empty


def shares(sizes, weights=(5, 2, 1), share=1.5):
    """Targets by source: what full sources leave is shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, wanted = set(), share * sum(sizes.values())
    while True:
        rest = wanted - sum(2.0 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        target = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free} | {s: 2.0 * sizes[s] for s in full}
        more = {s for s in free if target[s] >= 2 * sizes[s]}
        if not more:
            return target
        full |= more


def test_targets(spark):
    sizes = {"b": 100, "a": 1000, "é": 10, None: 500, "z": 4000, "": 70, "c": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in source_targets(df).collect()}
    assert found == pytest.approx(shares(sizes))


def test_numbers_in_order(spark):
    df = spark.range(1000).repartition(7).selectExpr("id * 37 % 1000 AS v")
    assert all(r["v"] == r["place"] for r in numbered(df, df.v).collect())


def mixture(spark):
    rows = [(i, "w " * (i * 7919 % 400), "abcd"[i % 4] if i % 3 else "a") for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_taken_words_come_near(spark):
    docs = mixture(spark)
    rows = mix_sources(docs, carry=("doc_id", "source")).collect()
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert 0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(shares(dict(size)))
    for source, words in taken.items():
        assert words == pytest.approx(target[source], rel=0.01)
    key = lambda r: (r["doc_id"], r["copies"])
    again = mix_sources(docs.repartition(5), carry=("doc_id", "source")).collect()
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_awkward_rows(spark):
    docs = documents(spark)
    found = mix_sources(docs, carry=("doc_id", "text", "source", "n_words"))
    assert found.count() == docs.count()
    for r in found.collect():
        assert r["size"] == len((r["text"] or "").encode().split()) and r["taken"] <= 2 * r["size"]
    assert mix_sources(empty(spark)).count() == 0
