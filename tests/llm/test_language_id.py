import itertools
import math
import zlib
from collections import Counter

import numpy as np

from rowferry.llm import language_id
from rowferry.llm.language_id import Decoder, code_matrix, codes_of, grams, identify, letters, sample, train
from tests.llm.data import documents, empty

LETTER = letters()


def test_code_matrices():
    for n in (2, 3, 4, 5, 6, 7, 30):
        code = code_matrix(n)
        assert len({tuple(c * c[0]) for c in code.T}) == code.shape[1]
        distance = min(int((a != b).sum()) for a, b in itertools.combinations(code, 2))
        assert distance >= (2 ** (n - 2) if n <= 6 else code.shape[1] // 4)


def test_letters_and_grams():
    as_text = lambda t: "".join(chr(int(c)) if c else "_" for c in codes_of(t, LETTER))
    assert as_text(" Été, 12 --x!") == "_été_x_" and as_text("12 \n…") == "" and as_text("") == ""
    codes = codes_of("abcabc de", LETTER)
    whole = [part.tolist() for part in grams(codes)]
    assert [len(p) for p in whole] == [11, 10, 9, 8]
    cut = [[p.tolist() for p in grams(codes, a, a + 4)] for a in range(0, 11, 4)]
    assert [sum((c[n] for c in cut if n < len(c)), []) for n in range(4)] == whole
    assert whole[2][1] == whole[2][4] and len({*whole[0][1:4]}) == 3


def test_margins_and_decoding_against_plain_loops(monkeypatch):
    draw, model = np.random.default_rng(1), Decoder(["a", "b", "c", "d"])
    model.weights[:] = draw.normal(size=model.weights.shape)
    model.offset[:], model.trust[:] = draw.normal(size=7), draw.uniform(0.1, 1, 7)
    monkeypatch.setattr(language_id, "PIECE", 5)
    margins = []
    for text in ("one two three", "x", "Ünïcode text, of more words"):
        codes = codes_of(text, LETTER)
        all_grams = [h for part in grams(codes) for h in part.tolist()]
        plain = [sum(float(model.weights[h, b]) for h in all_grams) / len(all_grams) + model.offset[b] for b in range(7)]
        assert np.allclose(model.margin(codes), plain, atol=1e-6)
        margins.append(plain)
    names, scores, doubt = model.decide(np.array(margins))
    for m, name, score, doubtful in zip(margins, names, scores, doubt, strict=True):
        loss = [sum(t * math.log1p(math.exp(-c * x)) for t, c, x in zip(model.trust, row, m, strict=True)) for row in model.code]
        order = sorted(range(4), key=lambda i: loss[i])
        assert name == "abcd"[order[0]] and doubtful == (loss[order[1]] - loss[order[0]] < 1.0)
        assert math.isclose(score, math.exp(-loss[order[0]]) / sum(math.exp(-x) for x in loss))


def test_wrong_bits_are_corrected():
    model = Decoder(["a", "b", "c", "d"])
    for i, bit in itertools.product(range(4), range(7)):
        margins = model.code[i] * 3.0
        margins[bit] *= -1
        assert model.decide(margins[None])[0] == ["abcd"[i]]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    found = identify(docs, train(docs)).collect()
    assert len(found) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    judged = [r for r in found if r["held_out"] and lang[r["doc_id"]]]
    wrong = [r for r in judged if r["lang_pred"] != lang[r["doc_id"]]]
    print(len(judged), len(wrong), sum(r["ambiguous"] for r in judged), np.quantile([r["score"] for r in judged], [0, 0.1, 0.5]))
    assert len(wrong) <= 0.02 * len(judged)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert sum(r["ambiguous"] for r in judged) < 0.1 * len(judged)


def test_sample_is_bounded_and_held_out_rows_teach_nothing(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE", 20)
    rows = [(i, f"text {i // 4} abc", "en" if i % 2 else "fr") for i in range(400)] + [(9, None, "en"), (10, "12", "en"), (None, "x y", "en"), (11, "w", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taken = sample(docs)
    assert Counter(lang for lang, _ in taken) == {"en": 10, "fr": 10} and len(set(taken)) == 20
    held = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert sample(spark.createDataFrame(held, docs.schema)) == []


def test_awkward_documents(spark):
    for docs in (documents(spark, ["x" * 500_000, "né " * 200_000]), empty(spark)):
        found = identify(docs, train(docs)).collect()
        assert len(found) == docs.count()
        for r, d in zip(sorted(found, key=str), sorted(docs.collect(), key=str), strict=True):
            assert 0 <= r["score"] <= 1
        blank = {d["doc_id"] for d in docs.collect() if not any(c.isalpha() for c in d["text"] or "")}
        assert all((r["lang_pred"] == "und") == (r["doc_id"] in blank) for r in found if r["doc_id"] is not None)
    one = spark.createDataFrame([(1, "abc", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(one, train(one)).collect()}
    assert found == {1: ("en", 1.0), 2: ("und", 0.0)}
