import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowferry.llm import co_training, toxicity
from tests.llm.data import documents, empty, labels

BAD = ("glorp", "snark")
STEMMED = "quxi"


def corpus(spark, n=1500):
    draw = random.Random(1)
    word = lambda: "".join(draw.choice(("ta", "no", "ri", "me", "lu")) for _ in range(draw.randint(1, 4)))
    rows, marks = [], []
    for i in range(n):
        words = [word() for _ in range(draw.randint(3, 80))]
        bad = i % 5 == 0
        if bad:
            words[draw.randrange(len(words))] = draw.choice(BAD) if i % 2 else STEMMED + word()
        junk = i % 4 == 0
        text = " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words)
        rows.append((i, text, "en" if i % 3 else "fr", "s1" if junk and i % 8 else "s2", len(text)))
        marks.append((i, int(not junk), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, labels(spark, [*marks, (None, 1, 1), (3, None, None)])


def accuracy(found, truth):
    rows = [r for r in found.collect() if r["held_out"]]
    assert len(rows) > 100
    return sum(r["predicted"] == truth[r["doc_id"]] for r in rows) / len(rows)


def test_toxicity(spark):
    docs, marks = corpus(spark)
    truth = {r["doc_id"]: r["toxic"] for r in marks.collect()}
    model = toxicity.train(docs, marks)
    found = toxicity.score_toxicity(docs, model)
    assert accuracy(found, truth) > 0.95
    # language and source are no inputs of the score
    swapped = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source", "n_chars")
    scores = lambda df: sorted((r["doc_id"], r["score"], r["predicted"]) for r in df.collect())
    assert scores(toxicity.score_toxicity(swapped, model)) == scores(found)


def test_toxicity_of_awkward_rows(spark):
    docs = documents(spark)
    model = toxicity.train(docs, labels(spark, [(5, 0, 1), (7, 1, 0), (9, 1, 0), (None, 0, 1), (6, 0, 1), (2, 1, None)]))
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    model = toxicity.train(docs, labels(spark, []))
    assert all(r["predicted"] == 0 for r in toxicity.score_toxicity(docs, model).collect())
    assert toxicity.score_toxicity(empty(spark), toxicity.train(empty(spark), labels(spark, []))).count() == 0


def test_whole_text_counts(spark):
    docs, marks = corpus(spark)
    model = toxicity.train(docs, marks)
    long = "ta no ri " * 40_000
    df = spark.createDataFrame([(1, long, "en"), (2, long + "glorp " + long, "en")], "doc_id long, text string, lang string")
    clean, toxic = (r["score"] for r in sorted(toxicity.score_toxicity(df, model).collect()))
    assert clean < 0.5 <= toxic


def test_co_training(spark):
    docs, marks = corpus(spark)
    truth = {r["doc_id"]: r["quality"] for r in marks.collect()}
    known = marks.filter("doc_id % 7 < 3")
    model = co_training.train(docs, known)
    assert min(model.taught) > 0
    assert accuracy(co_training.score_quality(docs, model), truth) > 0.97


def test_co_training_of_awkward_rows(spark):
    docs = documents(spark)
    for pairs in ([(5, 0, 0), (7, 1, 0), (9, 1, 0), (10, 0, 0), (None, 0, 1), (2, None, 1)], [], [(7, 1, 0)]):
        rows = co_training.score_quality(docs, co_training.train(docs, labels(spark, pairs))).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r["score"] <= 1 and r["kept"] == (r["predicted"] == 1) for r in rows)
    assert co_training.score_quality(empty(spark), co_training.train(empty(spark), labels(spark, []))).count() == 0


@pytest.mark.parametrize("module", [co_training, toxicity])
def test_held_out_rows_do_not_train(spark, module):
    docs, marks = corpus(spark, 400)
    flipped = marks.selectExpr("doc_id", "IF(crc32(string(doc_id)) % 5 = 0, 1 - quality, quality) AS quality", "IF(crc32(string(doc_id)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    score = module.score_quality if module is co_training else module.score_toxicity
    results = [sorted((r["doc_id"], r["score"]) for r in score(docs, module.train(docs, m)).collect()) for m in (marks, flipped)]
    assert results[0] == results[1]


@pytest.mark.parametrize("taught", [5, 10**6])
def test_the_surest_of_all_unlabelled_rows_are_named(spark, monkeypatch, taught):
    """A round against a plain loop over all rows."""
    monkeypatch.setattr(co_training, "TAUGHT", taught)
    docs, marks = corpus(spark, 900)
    model = co_training.train(docs, marks.filter("doc_id % 7 < 3"))
    rows = co_training.inputs_of(docs).withColumn("key", F.col("doc_id"))
    free = co_training.features_of(rows, "key")
    n, good = free.count(), 0.7
    found = co_training.named(free, n, good, model)
    sure = {r["key"]: r["s"] for r in co_training.sure_of(free, model).collect()}
    whole = {r["key"]: (r["x"], r["c"]) for r in free.collect()}
    for key, (x, c) in list(whole.items())[:50]:
        by_view = model.parts(np.array([x]), np.array([c]))
        chance = [v.chance(*p)[0] for v, p in zip((model.content, model.meta), by_view, strict=True)]
        assert sure[key] == pytest.approx([1 - chance[0], chance[0], 1 - chance[1], chance[1]])
    for j in range(4):
        most = max(1, int(co_training.SHARE * n * (good if j % 2 else 1 - good)))
        step = {k: math.floor((s[j] - co_training.SURE) / (1 - co_training.SURE) * co_training.STEPS) for k, s in sure.items()}
        ranked = sorted((s for s in step.values() if s >= 0), reverse=True)
        want = sorted(k for k, s in step.items() if ranked and s >= ranked[: most][-1])[:taught]
        got = found[j // 2][j % 2]
        assert [k for k, _, _ in got] == want and all((x, c) == whole[k] for k, x, c in got)


def test_repeated_ids_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(co_training, "LABELLED_SAMPLE", 30)
    monkeypatch.setattr(toxicity, "TOXIC_SAMPLE", 10)
    monkeypatch.setattr(toxicity, "OTHER_SAMPLE", 10)
    docs, _ = corpus(spark, 40)
    many = docs.crossJoin(spark.range(20)).selectExpr("doc_id % 3 AS doc_id", "concat(text, id) AS text", "lang", "source", "n_chars")
    marks = labels(spark, [(0, 1, 0), (1, 0, 1), (2, 1, 0)])
    fitted = []
    monkeypatch.setattr(co_training.CoTrained, "fit", lambda self, x, m, s: fitted.append(len(m)))
    co_training.train(many, marks)
    monkeypatch.setattr(toxicity.Classifier, "fit", lambda self, t, m: fitted.append(len(t)))
    monkeypatch.setattr(toxicity.Classifier, "calibrate", lambda *a: fitted.append(len(a[1])))
    toxicity.train(many, marks)
    assert 0 < fitted[0] <= 30 and 0 < fitted[1] + fitted[2] <= 20


def test_pooled_filters_against_plain_loops():
    model, draw = toxicity.Classifier(), np.random.default_rng(3)
    texts = [[f"w{i}".encode() for i in draw.integers(0, 30, n)] for n in (1, 2, 3, 9, 40)]
    vocabulary = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
    projected = np.concatenate([np.zeros((1, model.filters.shape[1]), np.float32), model.project(list(vocabulary))])
    ids = np.concatenate([np.append([vocabulary[w] for w in t], (0, 0)) for t in texts]).astype(np.int64)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 2) - 2
    best = model.pooled(projected, ids, ends - sizes, ends)
    for row, text in zip(best, texts, strict=True):
        vectors = [sum(model.embedding[b] for b in toxicity.buckets_of(w)) for w in text]
        at, j = 0, 0
        for width in toxicity.WIDTHS:
            for f in range(toxicity.FILTERS):
                values = []
                for start in range(len(text)):
                    window = vectors[start : start + width]
                    values.append(sum(v @ model.filters[:, at + k * toxicity.FILTERS + f] for k, v in enumerate(window)))
                assert row[j] == pytest.approx(max(values) + model.bias[j], abs=1e-5)
                j += 1
            at += width * toxicity.FILTERS


def test_all_labelled_rows_teach(spark, monkeypatch):
    """Words that no row of the start's sample has, in many shards, long texts too."""
    monkeypatch.setattr(toxicity, "TOXIC_SAMPLE", 20)
    monkeypatch.setattr(toxicity, "OTHER_SAMPLE", 20)
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 300)
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 200_000, raising=False)
    docs, marks = corpus(spark, 3000)
    # two of three toxic texts have a word that comes in long texts alone
    docs = docs.withColumn("text", F.expr("IF(doc_id % 15 > 0 AND doc_id % 5 = 0, concat(repeat('ta no lu ', 40), regexp_replace(text, '(?i)(glorp|snark|quxi)[a-z]*', 'vexed')), text)"))
    truth = {r["doc_id"]: r["toxic"] for r in marks.collect()}
    model = toxicity.train(docs, marks)
    assert accuracy(toxicity.score_toxicity(docs, model), truth) > 0.95
    again = toxicity.train(docs.repartition(5), marks)
    assert accuracy(toxicity.score_toxicity(docs, again), truth) > 0.95


def test_rounds_see_every_row(spark, tmp_path):
    docs, marks = corpus(spark, 300)
    rows = docs.join(marks.filter("toxic IS NOT NULL").dropDuplicates(["doc_id"]), "doc_id").selectExpr("doc_id AS row", "text", "toxic AS mark")
    n = {(r["bucket"], r["mark"]): r["n"] for r in toxicity.class_counts(rows).collect()}
    want = {}
    for r in rows.collect():
        for b in {b for w in toxicity.words_of(r["text"].encode()) for b in toxicity.buckets_of(w)}:
            want[b, r["mark"]] = want.get((b, r["mark"]), 0) + 1
    assert n == want
    # a single shard takes the steps of a plain epoch
    model = toxicity.learn(toxicity.Classifier(), rows)
    plain, taken = toxicity.Classifier(), sorted(rows.collect())
    seen = np.zeros((2, toxicity.BUCKETS), np.float32)
    for (b, mark), k in want.items():
        seen[mark, b] = k
    y = np.array([r["mark"] for r in taken])
    plain.lean(seen, (y == 0).sum(), y.sum())
    texts = [toxicity.words_of(r["text"].encode()) for r in taken]
    words = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
    table = np.array([[0] * 4, *map(toxicity.buckets_of, words)])
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (y == 0).sum()) * len(y)
    for number in range(toxicity.ROUNDS):
        order = np.random.default_rng([toxicity.SEED, number]).permutation(len(y))
        plain.epoch([np.array([words[w] for w in t] or [0]) for t in texts], table, y.astype(np.float32), weight, order)
    assert np.abs(model.embedding - plain.embedding).max() < 1e-3 and np.abs(model.filters - plain.filters).max() < 1e-3


def test_thresholds_from_all_rows(spark):
    docs, marks = corpus(spark, 900)
    model = toxicity.train(docs, marks)
    rows = docs.join(marks.filter("toxic IS NOT NULL"), "doc_id").selectExpr("text", "lang", "toxic AS mark")
    toxicity.calibrate_all(model, rows, 0.2)
    found = rows.collect()
    score = model.score([toxicity.words_of(r["text"].encode()) for r in found], {})
    for lang in ("en", "fr"):
        s = np.array([x for x, r in zip(score, found, strict=True) if r["lang"] == lang])
        t = np.array([r["mark"] for r in found if r["lang"] == lang])
        f1 = lambda c: 2 * ((s >= c) & (t == 1)).sum() / ((s >= c).sum() + t.sum())  # noqa: E731,B023
        # cuts lie at ends of steps of the logits
        assert f1(model.thresholds[lang]) > max(map(f1, s)) - 0.01
