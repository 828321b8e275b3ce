import random
import math
import os
import sys
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowferry.llm import common, lm_score
from rowferry.llm.common import log_gamma
from rowferry.llm.lm_score import Lookup, score_texts, strings_of
from tests.llm.data import documents, empty, in_many_files, other_splits

DEPTH = 3


def trains(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1


class Tree:
    """Context-tree weighting with all nodes in dictionaries."""

    def __init__(self, texts):
        self.n = {}
        for text in texts:
            for context, node, bit in self.path(text):
                for d in range(DEPTH + 1):
                    self.n.setdefault((context[DEPTH - d :], node), [0, 0])[bit] += 1
        self.weighed, self.own, below = {}, {}, {}
        for key in sorted(self.n, key=lambda k: -len(k[0])):
            a, b = self.n[key]
            kt = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            rest = below.get(key, 0.0)
            last = len(key[0]) == DEPTH
            self.weighed[key] = kt if last else np.logaddexp(kt, rest) - math.log(2)
            self.own[key] = 1.0 if last else 1 / (1 + math.exp(min(rest - kt, 700)))
            if key[0]:
                up = key[0][1:], key[1]
                below[up] = below.get(up, 0.0) + self.weighed[key]

    @staticmethod
    def path(text):
        data = bytes(DEPTH) + text
        for i in range(DEPTH, len(data)):
            for k in range(8):
                yield data[i - DEPTH : i], 1 << k | data[i] >> 8 - k, data[i] >> 7 - k & 1

    def one(self, context, node):
        mixed, rest = 0.0, 1.0
        for d in range(DEPTH + 1):
            key = context[DEPTH - d :], node
            if key not in self.n:
                break
            a, b = self.n[key]
            mixed += rest * self.own[key] * (b + 0.5) / (a + b + 1)
            rest *= 1 - self.own[key]
        return mixed + rest / 2

    def score(self, text):
        return sum(math.log10(p if bit else 1 - p) for c, node, bit in self.path(text) for p in [self.one(c, node)])


def check(docs, found):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    learned = [t for i, t in rows if trains(i)]
    count = Counter(w for t in learned for w in [*t.lower().split(), "end"])
    total, distinct, tree = sum(count.values()), len(count), Tree(learned)
    expected = []
    for i, text in rows:
        tokens = [*text.lower().split(), "end"]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        expected.append((str(i), not trains(i), len(tokens), sum(count[w] > 0 for w in tokens), total, base, tree.score(text)))
    columns = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in found.collect())
    assert len(got) == len(expected)
    for a, b in zip(got, sorted(expected), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("chunk", [1000, 10**9])
def test_against_a_plain_tree(spark, monkeypatch, chunk):
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(lm_score, "TILE", 700)
    docs = documents(spark)
    check(docs, score_texts(docs, DEPTH))


def test_splits_may_change_between_passes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 1000)
    docs = in_many_files(spark, documents(spark), str(tmp_path / "t"))
    with other_splits(spark, 3):
        out = score_texts(docs, DEPTH)
    with other_splits(spark, 40):
        check(docs, out)


def test_without_training_texts(spark):
    docs = spark.createDataFrame([(i, "ab") for i in range(50) if not trains(i)], "doc_id long, text string")
    for r in score_texts(docs, DEPTH).collect():
        assert (r["base_score"], r["n_known"], r["train_tokens"]) == (0.0, 0, 0)
        assert r["score"] == pytest.approx(16 * math.log10(0.5))
    assert score_texts(empty(spark), DEPTH).count() == 0


def test_log_gamma(spark):
    values = [0.5, 1.0, 1.5, 7.25, 1e3, 1e9]
    df = spark.createDataFrame([(v,) for v in values], "z double").select("z", log_gamma(F.col("z")).alias("g"))
    for r in df.collect():
        assert r["g"] == pytest.approx(math.lgamma(r["z"]), rel=1e-11, abs=1e-11)


def test_lookup_and_strings():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000))
    lookup = Lookup(keys, np.arange(len(keys), dtype=float))
    picked = np.random.default_rng(2).integers(0, len(keys), 20000)
    assert (lookup(keys[picked]) == picked).all()
    codes, sizes = strings_of([b"ab", b"", b"c"], 2)
    assert codes.tolist() == [0x61, 0x6162, 0x63] and sizes.tolist() == [2, 0, 1]


def test_default_depth_sees_five_bytes_back(spark):
    """Texts whose byte is that five places before, the first five random."""
    draw = random.Random(4)
    starts = ["".join(draw.choice("ab") for _ in range(5)) for _ in range(120)]
    docs = spark.createDataFrame([(i, s * 40) for i, s in enumerate(starts)], "doc_id long, text string")
    held = [r for r in score_texts(docs).collect() if r["held_out"]]
    assert held and max(r["bits_per_byte"] for r in held) < 0.3


@pytest.mark.parametrize("depth", [0, 1, 2, 4, 5])
def test_other_depths_against_a_plain_tree(spark, monkeypatch, depth):
    monkeypatch.setattr(sys.modules[__name__], "DEPTH", depth)
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 4000)
    docs = documents(spark)
    check(docs, score_texts(docs, depth))


def test_stored_tables_stay_near_the_texts(spark, monkeypatch, tmp_path):
    """All that is stored at one time, to the bytes of the texts' file."""
    draw = random.Random(7)
    words = ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(2, 9))) for _ in range(20_000)]
    rows = [(i, " ".join(draw.choice(words) for _ in range(300))) for i in range(1500)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "t"))

    def size(path):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(str(path).removeprefix("file:")) for f in names)

    live, most = {}, [0]

    def store(df, label):
        out = common.store(df, label)
        live[out.stored_at] = size(out.stored_at)
        most[0] = max(most[0], sum(live.values()))
        return out

    def discard(*stored):
        common.discard(*stored)
        for df in stored:
            live.pop(df.stored_at)

    monkeypatch.setattr(lm_score, "store", store)
    monkeypatch.setattr(lm_score, "discard", discard)
    assert score_texts(spark.read.parquet(str(tmp_path / "t"))).count() == 1500
    assert 0 < most[0] < 3 * size(tmp_path / "t")


def test_packed_numbers_and_log_gamma():
    draw = np.random.default_rng(4)
    for values in (np.sort(draw.integers(-(1 << 62), 1 << 62, 999)), draw.integers(0, 5, 100), np.zeros(0, np.int64)):
        assert (lm_score.unpack(lm_score.pack(values), len(values)) == values).all()
    values = draw.normal(size=50)
    assert (lm_score.unpack(lm_score.pack(values), 50).view(np.float64) == values).all()
    n = np.array([0, 1, 7, 4095, 4096, 10**6, 10**9])
    for half in (True, False):
        want = [math.lgamma(i + (0.5 if half else 1.0)) for i in n.tolist()]
        assert lm_score.log_gamma_of(n, half) == pytest.approx(want, rel=1e-13)


def test_memory_stays_near_a_tile(monkeypatch):
    """What a chunk's counts and a long text's strings hold at once, to the bytes of the texts."""
    monkeypatch.setattr(lm_score, "TILE", 1 << 16)
    monkeypatch.setattr(lm_score, "MERGED_KEYS", 1 << 14)
    draw = random.Random(3)
    words = [bytes(draw.choices(b"etaoinsh", k=5)) for _ in range(500)]
    text = b" ".join(draw.choices(words, k=700_000))
    tracemalloc.start()
    try:
        keys, counts = lm_score.counted([(text, True), (b"zz", False)], 2)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 4 * len(text)
    strings = keys >= 0
    expected = np.unique(strings_of([text], 2)[0], return_counts=True)
    taught = counts > 0
    assert (keys[strings & taught] == expected[0]).all() and (counts[strings & taught] == expected[1]).all()
    count = Counter(text.split())
    names = lm_score.word_keys(list(count))
    assert dict(zip(keys[~strings].tolist(), counts[~strings].tolist(), strict=True)) == {
        **dict(zip(names.tolist(), count.values(), strict=True)),
        int(lm_score.word_keys([b"zz"])[0]): 0,
        -1: 1,
    }


def test_lookup_takes_few_bytes_a_key():
    keys = np.arange(1 << 18, dtype=np.int64) * 7919
    tracemalloc.start()
    try:
        lookup = Lookup(keys, keys.astype(float))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert (lookup(keys) == keys).all() and held < 48 * len(keys)


def test_texts_longer_than_a_tile_are_cut_and_whole(monkeypatch):
    monkeypatch.setattr(lm_score, "TILE", 7)
    texts = [b"", b"one two", b"x" * 30, b"a b  c\td\n" * 9, b"end"]
    for depth in (0, 2, 5):
        found = {i: [] for i in range(len(texts))}
        for before, numbers, parts in lm_score.tiles(enumerate(texts), depth):
            assert len(set(numbers)) == len(numbers)
            codes, sizes = strings_of(parts, depth, before)
            for number, some in zip(numbers, np.split(codes, np.cumsum(sizes)[:-1]), strict=True):
                found[number].extend(some.tolist())
        for i, text in enumerate(texts):
            assert found[i] == strings_of([text], depth)[0].tolist()
    for text in texts:
        assert [w for some in lm_score.word_lists(text.upper()) for w in some] == text.split()
