import numpy as np
import pytest

from rowferry.llm import embedding_graph
from rowferry.llm.embedding_graph import near_copies

SCHEMA = "vec_id long, embedding array<float>, n int"


def vectors():
    """Clusters with near copies, chains of links, equal vectors, and a dense ball."""
    random = np.random.default_rng(1)
    base = random.normal(size=(40, 16))
    rows = [b + random.normal(size=16) * random.choice([0.05, 0.2, 0.5]) for b in base for _ in range(12)]
    ball = random.normal(size=16)
    rows += [ball + random.normal(size=16) * 0.02 for _ in range(150)]
    rows += [rows[3]] * 4 + [rows[0] * 2, -rows[0]]
    return np.array(rows, np.float32)


def truth(matrix):
    unit = matrix.astype(float) / np.linalg.norm(matrix.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    root = np.arange(len(matrix))
    while True:
        new = np.minimum(root, np.where(linked, root, len(matrix)).min(axis=1))
        if (new == root).all():
            return linked.sum(axis=1), root
        root = new


@pytest.mark.parametrize("rows", [2048, 60])
def test_against_all_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(embedding_graph, "SHARD_ROWS", rows)
    matrix = vectors()
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(matrix)], SCHEMA)
    links, root = truth(matrix)
    found = {r["vec_id"]: r for r in near_copies(df).collect()}
    n = np.array([found[i]["n_links"] for i in range(len(matrix))])
    assert (n <= links).all() and n.sum() >= 0.97 * links.sum()
    assert found[0]["recall"] >= 0.95
    same = np.array([found[i]["component_id"] for i in range(len(matrix))]) == root
    assert same.mean() >= 0.97
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def planted(n, d=64, common=0.0, copies=400, seed=3):
    """Unstructured vectors, some with one near copy, and a direction that all may share."""
    random = np.random.default_rng(seed)
    base = random.normal(size=(n, d)) + common * np.ones(d)
    noise = random.normal(size=(copies, d))
    own = base[:copies]
    noise *= 0.3 * np.linalg.norm(own, axis=1, keepdims=True) / np.linalg.norm(noise, axis=1, keepdims=True)
    return np.concatenate([base, own + noise]).astype(np.float32)


@pytest.mark.parametrize("common", [0.0, 2.3])
def test_recall_over_many_shards(spark, monkeypatch, common):
    monkeypatch.setattr(embedding_graph, "SHARD_ROWS", 256)
    compared = []
    blocks = embedding_graph.compared_blocks
    monkeypatch.setattr(embedding_graph, "compared_blocks", lambda members: compared.append(members.count()) or blocks(members))
    matrix = planted(4000, common=common)
    links, root = truth(matrix)
    assert links.sum() >= 300
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(matrix)], SCHEMA)
    found = {r["vec_id"]: r for r in near_copies(df).collect()}
    n = np.array([found[i]["n_links"] for i in range(len(matrix))])
    assert (n <= links).all() and n.sum() >= 0.95 * links.sum()
    assert not sum(compared)


def test_audit_without_links(spark):
    df = spark.createDataFrame([(i, np.eye(8)[i].tolist(), 1) for i in range(8)], SCHEMA)
    assert {r["recall"] for r in near_copies(df).collect()} == {None}


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0])]
    rows += [(7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.01]), (None, [0.0, 1.0]), (10, [1e-30, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in near_copies(df).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]
    near = [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (0, 4, 1, False), (10, 4, 1, False)]
    assert found == sorted([*alone, *near, (0, 0, None, True)], key=repr)
    assert near_copies(df.limit(0)).count() == 0
