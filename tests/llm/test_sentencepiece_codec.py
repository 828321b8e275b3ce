import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowferry.llm.queries import VOCABULARY
from rowferry.llm.sentencepiece_codec import SPACE, Codec, Vocabulary, decode, encode, piece_digests
from tests.llm.data import documents, empty

BYTES = [f"<{b}>" for b in range(256)]
WORDS = [SPACE, "a", "b", "ab", "aba", SPACE + "a", SPACE + "ab", "ba", "é", SPACE + SPACE]
SMALL = Vocabulary([None, *WORDS, *[None] * 256], [0.0, -3, -2, -2, -2.5, -4, -2.5, -3.5, -2.5, -5, -4.5, *[0.0] * 256], range(11, 267))


def best_path(vocabulary, text):
    """Pieces of the best path, found by trying every piece at every place."""
    if not text:
        return []
    chars = ["\0literal" if c == SPACE else SPACE if c == " " else c for c in " " + text]
    ids = {p: i for i, p in enumerate(vocabulary.pieces) if p}
    fallback = min(s for p, s in zip(vocabulary.pieces, vocabulary.scores, strict=True) if p) - 10
    longest = max(map(len, ids))
    best, back = [0.0] + [float("-inf")] * len(chars), [None] * (len(chars) + 1)
    for end in range(1, len(chars) + 1):
        best[end] = best[end - 1] + fallback
        char = chars[end - 1]
        raw = SPACE if char == "\0literal" else char
        back[end] = end - 1, [vocabulary.byte_ids[b] for b in raw.encode()]
        for start in range(max(0, end - longest), end):
            piece = "".join(chars[start:end])
            if piece in ids and best[start] + vocabulary.scores[ids[piece]] > best[end]:
                best[end] = best[start] + vocabulary.scores[ids[piece]]
                back[end] = start, [ids[piece]]
    out, end = [], len(chars)
    while end:
        start, found = back[end]
        out, end = found + out, start
    return out


def ids_of(codec, text):
    import numpy as np

    return np.frombuffer(codec.encode_all([text], {})[0], "<i4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é" + SPACE + "☃\n", max_size=40))
def test_best_path_and_round_trip(text):
    codec = Codec(SMALL)
    ids = ids_of(codec, text)
    score = lambda path: sum(SMALL.scores[i] if i < 11 else 0 for i in path)
    assert score(ids) == pytest.approx(score(best_path(SMALL, text)))
    assert codec.decode(ids) == text


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_any_text_round_trips(text):
    codec = Codec(SMALL)
    text = text.encode("utf-8", "ignore").decode()
    assert codec.decode(ids_of(codec, text)) == text


def test_pieces_across_units():
    odd = Vocabulary([None, "a" + SPACE + "b", "a", "b", SPACE, *[None] * 256], [0, -1.0, -2, -2, -2, *[0.0] * 256], range(5, 261))
    codec = Codec(odd)
    assert not codec.by_unit and ids_of(codec, "a b") == [4, 1] and codec.decode([4, 1]) == "a b"


def test_real_vocabulary(spark):
    vocabulary = Vocabulary.from_model(VOCABULARY)
    docs = documents(spark)
    encoded = encode(docs, vocabulary)
    assert encoded.columns == [*docs.columns, "piece_ids"]
    both = decode(encoded, vocabulary).collect()
    assert len(both) == docs.count()
    for r in both:
        assert r["decoded"] == (r["text"] or "")
        if len(r["text"] or "") < 500:
            assert r["piece_ids"] == best_path(vocabulary, r["text"] or "")
    digests = piece_digests(docs, vocabulary)
    assert all(r["round_trip"] for r in digests.collect())
    assert sorted(len(r["piece_ids"]) for r in both) == sorted(r["n_pieces"] for r in digests.collect())
    assert piece_digests(empty(spark), vocabulary).count() == 0 and encode(empty(spark), vocabulary).count() == 0
