import hashlib
import random
from collections import Counter

from rowferry.llm import suffix_dedup
from rowferry.llm.suffix_dedup import remove_repeats
from tests.llm.data import documents, empty, in_many_files, other_splits

LENGTH = suffix_dedup.LENGTH


def brute_force(texts):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + LENGTH] for d in data for i in range(len(d) - LENGTH + 1))
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - LENGTH + 1):
            if count[d[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        yield len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def result(row):
    return row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]


def passages():
    """Shared passages between different neighbours, edited copies, periodic texts, a piece longer than a tile."""
    draw = random.Random(3)
    prose = lambda n: "".join(draw.choice("abcdeé ") for _ in range(n))
    base = [prose(draw.randint(0, 900)) for _ in range(30)]
    texts = list(base)
    for _ in range(30):
        copy = list(draw.choice(base))
        for _ in range(draw.randint(0, 3)):
            if copy:
                copy[draw.randrange(len(copy))] = "x"
        texts.append("".join(copy))
    line = prose(230)
    texts += [f"{i} {line} {i}{i}" for i in range(25)]
    texts += [prose(50) + base[1][:199] + prose(50), base[1][:199], "ab" * 300, "q" * 199, "q" * 200, "z" * 201]
    return texts


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TILE", 1000)
    texts = passages()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: result(r) for r in remove_repeats(df).collect()}
    assert found == dict(enumerate(brute_force(texts)))


def test_long_text_over_tiles(spark):
    draw = random.Random(4)
    tail = "".join(draw.choice("mnop") for _ in range(500))
    texts = ["".join(draw.choice("abcd") for _ in range(suffix_dedup.TILE + 300)) + tail, tail, "short"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in remove_repeats(df).collect()}
    assert found == {0: (500, 1), 1: (500, 1), 2: (0, 0)}


def test_awkward_rows(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    expected = Counter(zip((r["doc_id"] for r in rows), brute_force([r["text"] for r in rows]), strict=True))
    assert Counter((r["doc_id"], result(r)) for r in remove_repeats(docs).collect()) == expected


def test_text_keeps_whole_characters(spark):
    shared = "é" * 150
    df = spark.createDataFrame([(1, "x" + shared), (2, "yy" + shared)], "doc_id long, text string")
    found = {r["doc_id"]: r["kept"] for r in remove_repeats(df, texts=True).collect()}
    assert found == {1: "x", 2: "yy"}


def test_empty_table_and_clashes(spark):
    out = remove_repeats(empty(spark), carry=("doc_id", "n_words", "row", "text"))
    assert out.columns == ["doc_id", "n_words", "row", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert out.count() == 0


def test_splits_may_change_between_passes(spark, tmp_path):
    texts = passages()
    df = in_many_files(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), str(tmp_path / "t"))
    with other_splits(spark, 3):
        out = remove_repeats(df)
    with other_splits(spark, 40):
        found = {r["doc_id"]: result(r) for r in out.collect()}
    assert found == dict(enumerate(brute_force(texts)))
