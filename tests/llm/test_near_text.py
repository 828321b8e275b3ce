import random

from pyspark.sql import functions as F

import corpus_pipeline
from rowferry.llm import near_text
from rowferry.llm.near_text import SIMILARITY, shingles_of, similar_groups
from rowferry.llm.simhash import simhash_groups


def near_texts():
    """Groups of a text with some words changed, one group large, and texts with a common passage."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    passage = " ".join(word() for _ in range(20))
    texts = ["", None, " \n", "a b c", "A  b c", "a b d"]
    for group in range(60):
        words = [word() for _ in range(draw.randint(60, 400))]
        for _ in range(40 if group == 0 else 3):
            other = list(words)
            for _ in range(draw.randint(0, 6)):
                other[draw.randrange(len(other))] = word()
            texts.append(" ".join(other) + (f" {passage}" if group % 2 else ""))
    return texts


def brute_force(texts):
    sets = [set(shingles_of((t or "").encode()).tolist()) for t in texts]
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            union = len(sets[a] | sets[b])
            if root[a] != root[b] and (not union or len(sets[a] & sets[b]) / union >= SIMILARITY):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return root


def test_groups_are_those_of_brute_force(spark):
    texts = near_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in similar_groups(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_force(texts)


def test_pipeline_takes_one_of_similar_texts(spark):
    texts = near_texts()
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect())
    assert kept == sorted(set(brute_force(texts)))


def test_near_misses_make_few_pairs(spark, monkeypatch):
    """Many edits of one text that is not there: no two are similar, but all share bands; no pair is left out either."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(300)]
    texts = []
    for i in range(150):
        other = list(base)
        for _ in range(5 if i < 140 else 1):
            other[draw.randrange(len(other))] = word()
        texts.append(" ".join(other))
    made = []
    real = near_text.close_pairs
    monkeypatch.setattr(near_text, "close_pairs", lambda *a: made.append(real(*a)) or made[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = []
    real_verified = near_text.verified
    monkeypatch.setattr(near_text, "verified", lambda p, s: counts.append(p.count()) or real_verified(p, s))
    found = {r["doc_id"]: r["component_id"] for r in similar_groups(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_force(texts)
    assert sum(counts) < 150 * 149 // 8


def test_awkward_rows(spark):
    """Very long texts, repeated rows, nulls, an empty table, columns of other names."""
    long = " ".join(f"w{i % 5000}x{i}" for i in range(150_000))
    texts = [long, long + " end", None, "", "a", "a", "A", "b", *["one two three four five six"] * 3]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, root string, n int")
    found = {r["doc_id"]: r["component_id"] for r in similar_groups(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_force(texts)
    assert similar_groups(docs.limit(0)).count() == 0


def test_simhash_gives_candidates_and_similarity_decides(spark, monkeypatch):
    """Without any candidate of the bands: texts of one SimHash component are compared, and linked where they are similar."""
    monkeypatch.setattr(near_text, "alike", lambda a, b: F.lit(False))
    monkeypatch.setattr(near_text, "close_pairs", lambda sets, ids: sets.selectExpr("id AS a", "id AS b").filter("a < 0"))
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    long = " ".join(word() for _ in range(4000))
    # one line so often that it decides the fingerprint, whatever stands after it
    line = " ".join([word() for _ in range(9)] * 1500)
    texts = [long, f"{long} end", f"{line} {word()} {word()}", f"{line} {' '.join(word() for _ in range(20))}"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    groups = {r["doc_id"]: r["component_id"] for r in simhash_groups(docs, 5).collect()}
    assert groups == {0: 0, 1: 0, 2: 2, 3: 2}
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect())
    assert kept == [0, 2, 3]
