"""Encoding texts into vocabulary pieces and back.

An Aho-Corasick automaton over the pieces is walked once over the characters; at each position its output links name
the pieces that end there, and each relaxes the best score of that position (Viterbi). Characters without a piece fall
back to byte pieces. The automaton is a set of arrays built once on the driver, as large as the vocabulary, and walks
many units (runs of spaces with what follows them) at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from rowferry.llm.common import bounded_batches, shared

SPACE = "▁"
# stands for a literal U+2581 of the text, which no piece may take for a space
LITERAL = 0x110000
UNKNOWN_PENALTY = 10.0
# cells of one block of units, and units kept with their pieces in a task
BLOCK_CELLS = 1 << 21
CACHE_UNITS = 1_000_000


class Vocabulary:
    """Pieces with scores; `byte_ids` are the ids of the 256 byte pieces. Ids without a text are never produced."""

    def __init__(self, pieces: Sequence[str | None], scores: Sequence[float], byte_ids: Sequence[int], unknown: int = 0):
        self.pieces, self.scores, self.byte_ids, self.unknown = list(pieces), list(scores), list(byte_ids), unknown

    @classmethod
    def from_model(cls, path: str) -> Vocabulary:
        """The normal pieces of a SentencePiece model file; read on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, scores, byte_ids = [], [], {}
        for i in range(model.vocab_size()):
            text = model.id_to_piece(i)
            special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            if model.is_byte(i):
                byte_ids[int(text[3:-1], 16)] = i
            pieces.append(None if special or model.is_byte(i) else text)
            scores.append(model.get_score(i))
        return cls(pieces, scores, [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else [], model.unk_id())


class Codec:
    """The automaton of a vocabulary as arrays, with encoding and decoding of texts."""

    def __init__(self, vocabulary: Vocabulary):
        import numpy as np

        self.byte_ids, self.unknown = vocabulary.byte_ids, vocabulary.unknown
        self.texts = [(p or "").replace(SPACE, " ").encode() for p in vocabulary.pieces]
        for b, i in enumerate(self.byte_ids):
            self.texts[i] = bytes([b])
        # no piece goes on after a space that follows something else, so units can be encoded on their own
        self.by_unit = not any(SPACE in p.lstrip(SPACE) for p in vocabulary.pieces if p)
        goto, ends = [{}], [-1]
        for i, piece in enumerate(vocabulary.pieces):
            state = 0
            for ch in map(ord, piece or ""):
                if ch not in goto[state]:
                    goto[state][ch] = len(goto)
                    goto.append({})
                    ends.append(-1)
                state = goto[state][ch]
            if state and (ends[state] < 0 or vocabulary.scores[i] > vocabulary.scores[ends[state]]):
                ends[state] = i
        fail, link, queue = [0] * len(goto), [-1] * len(goto), deque(goto[0].values())
        while queue:
            state = queue.popleft()
            link[state] = fail[state] if ends[fail[state]] >= 0 else link[fail[state]]
            for ch, child in goto[state].items():
                back = fail[state]
                while back and ch not in goto[back]:
                    back = fail[back]
                fail[child] = goto[back].get(ch, 0)
                queue.append(child)
        edges = sorted((state << 21 | ch, child) for state, row in enumerate(goto) for ch, child in row.items())
        self.keys = np.array([k for k, _ in edges] or [-1], np.int64)
        self.children = np.array([c for _, c in edges] or [0], np.int32)
        self.fail, self.link, self.ends = (np.array(x, np.int64) for x in (fail, link, ends))
        lengths = [len(p or "") for p in vocabulary.pieces]
        self.length = np.array([lengths[e] if e >= 0 else 0 for e in ends], np.int64)
        self.score = np.array([vocabulary.scores[e] if e >= 0 else 0.0 for e in ends], np.float64)
        known = [s for p, s in zip(vocabulary.pieces, vocabulary.scores, strict=True) if p]
        self.fallback = min(known, default=0.0) - UNKNOWN_PENALTY

    def step(self, state, ch):
        """The automaton's next states, following failure links where a state has no edge for its character."""
        import numpy as np

        out = np.zeros(len(state), np.int64)
        rows = np.arange(len(state))
        while len(rows):
            key = state << 21 | ch
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[rows[hit]] = self.children[at[hit]]
            left = np.flatnonzero(~hit & (state != 0))
            rows, ch, state = rows[left], ch[left], self.fail[state[left]]
        return out

    def block(self, chars, lengths) -> list[bytes]:
        """The ids, as little-endian 32-bit integers, of units of falling length.

        chars: code points, a row per place and a column per unit, so that each place is one run of memory.
        """
        import numpy as np

        width, n = chars.shape
        best, came, piece = np.zeros((width + 1) * n), np.zeros((width + 1, n), np.int32), np.zeros((width + 1, n), np.int32)
        state = np.zeros(n, np.int64)
        for t in range(width):
            m = int(np.searchsorted(-lengths, -t, "left"))  # the units longer than t come first
            state = self.step(state[:m], chars[t, :m])
            # a character without a piece is what remains if no piece that ends here is better
            top = best[t * n : t * n + m] + self.fallback
            where, which = came[t + 1], piece[t + 1]
            where[:m], which[:m] = t, -1
            node = np.where(self.ends[state] >= 0, state, self.link[state])
            rows = np.flatnonzero(node > 0)
            node = node[rows]
            while len(rows):
                start = t + 1 - self.length[node]
                score = best[start * n + rows] + self.score[node]
                better = np.flatnonzero(score > top[rows])
                won = rows[better]
                top[won], where[won], which[won] = score[better], start[better], self.ends[node[better]]
                node = self.link[node]
                live = np.flatnonzero(node > 0)
                rows, node = rows[live], node[live]
            best[(t + 1) * n : (t + 1) * n + m] = top
        counts = np.zeros(n, np.int64)
        path = np.zeros((width, n), np.int32)  # from the last piece to the first
        rows, at, step = np.arange(n), lengths.astype(np.int64), 0
        rows, at = rows[at > 0], at[at > 0]
        fallen = np.zeros(n, bool)
        while len(rows):
            got, before = piece[at, rows], came[at, rows]
            lone = np.flatnonzero(got < 0)
            if len(lone):
                fallen[rows[lone]] = True
                got[lone] = -1 - chars[before[lone], rows[lone]]
            path[step, rows] = got
            counts[rows] += 1
            step += 1
            more = np.flatnonzero(before > 0)
            rows, at = rows[more], before[more]
        ids = np.ascontiguousarray(path[:step][::-1].T, dtype="<i4")
        flat = ids[np.arange(step)[None, :] >= (step - counts)[:, None]]
        ends = np.cumsum(counts) * 4
        data = flat.tobytes()
        out = [data[e - 4 * c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
        for i in np.flatnonzero(fallen).tolist():
            out[i] = np.array([x for y in np.frombuffer(out[i], "<i4").tolist() for x in self.single(y)], "<i4").tobytes()
        return out

    def single(self, y: int) -> list[int]:
        """The ids of an entry of a path: itself, or the bytes of a character without a piece."""
        if y >= 0:
            return [y]
        ch = -1 - y
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in (SPACE if ch == LITERAL else chr(ch)).encode()]

    def units(self, text: str) -> list[str]:
        """The text cut before every run of spaces, each unit without the first of its spaces; nothing for no text.

        As a space is put before the whole text, every unit starts with one.
        """
        if not text:
            return []
        if not self.by_unit:
            return [text]
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [unit[1:] for unit in re.findall(r" +[^ ]*", " " + text)]

    def encode_units(self, units: Sequence[str]) -> list[bytes]:
        import numpy as np

        sizes = np.fromiter(map(len, units), np.int64, len(units)) + 1
        order = np.argsort(-sizes, kind="stable")
        out: list[bytes] = [b""] * len(units)
        start = 0
        while start < len(order):
            width = int(sizes[order[start]])
            picked = order[start : start + max(1, BLOCK_CELLS // width)]
            start += len(picked)
            lengths = sizes[picked]
            joined = "".join([" " + units[i] for i in picked.tolist()])
            points = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.int64)
            points[points == ord(SPACE)] = LITERAL
            points[points == 32] = ord(SPACE)
            chars = np.zeros((len(picked), width), np.int64)
            chars[np.arange(width)[None, :] < lengths[:, None]] = points
            for i, ids in zip(picked.tolist(), self.block(np.ascontiguousarray(chars.T), lengths), strict=True):
                out[i] = ids
        return out

    def encode_all(self, texts: Sequence[str], cache: dict[str, bytes]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers; units that were met before come from the cache."""
        if len(cache) > CACHE_UNITS:
            cache.clear()
        cut = [self.units(text) for text in texts]
        new = list(set().union(*cut) - cache.keys())
        cache.update(zip(new, self.encode_units(new), strict=True))
        return [b"".join(map(cache.__getitem__, units)) for units in cut]

    def decode(self, ids: Sequence[int]) -> str:
        data = b"".join([self.texts[i] for i in ids])
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def shared_codec(df: DataFrame, vocabulary: Vocabulary):
    """The automaton on every executor; its size is that of the vocabulary file, whatever the data."""
    bounded_batches(df.sparkSession)
    return shared(df.sparkSession, Codec(vocabulary))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", into: str = "piece_ids") -> DataFrame:
    """The frame with the array of piece ids of a text column in `into`, replacing a column of that name.

    A space is put before the text, spaces are part of the pieces, nothing is normalised. Null and empty texts have no
    ids. Of equally good ways the one whose last piece is longest is taken, piece by piece from the end. Every
    other column is carried as it is; repeated rows are encoded alike.
    """
    import pyarrow as pa
    import numpy as np

    sent = shared_codec(docs, vocabulary)
    rest = [c for c in docs.columns if c != into]
    place = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, cache = sent(), {}
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            found = codec.encode_all(texts, cache)
            offsets = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*rest, into])

    frame = docs.select(*(docs[f"`{c}`"] for c in rest))
    return frame.mapInArrow(run, StructType([*frame.schema, StructField(into, ArrayType(IntegerType()))]))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "piece_ids", into: str = "decoded") -> DataFrame:
    """The frame with the text of an array of ids in `into`; a null array gives an empty text. Inverse of `encode`."""
    import pyarrow as pa

    sent = shared_codec(encoded, vocabulary)
    rest = [c for c in encoded.columns if c != into]
    place = rest.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sent()
        for batch in batches:
            texts = [codec.decode(x or ()) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*rest, into])

    frame = encoded.select(*(encoded[f"`{c}`"] for c in rest))
    return frame.mapInArrow(run, StructType([*frame.schema, StructField(into, StringType())]))


def piece_digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids_sha256 (ids as little-endian 32-bit integers) and round_trip of every row.

    round_trip: decoding the ids gives the text again. Encoding and decoding in one pass, for callers that need no ids.
    """
    import numpy as np
    import pyarrow as pa

    sent = shared_codec(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, cache = sent(), {}
        is_byte = np.zeros(len(codec.texts), bool)
        is_byte[codec.byte_ids] = True
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes, n_bytes, digests, same = [], [], [], []
            for text, found in zip(texts, codec.encode_all(texts, cache), strict=True):
                ids = np.frombuffer(found, "<i4")
                sizes.append(len(ids))
                n_bytes.append(int(is_byte[ids].sum()))
                digests.append(hashlib.sha256(found).hexdigest())
                same.append(codec.decode(ids.tolist()) == text)
            columns = [pa.array(sizes, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(digests, pa.string())]
            columns = [batch.column(0), *columns, pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "n_byte_pieces", "ids_sha256", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, n_byte_pieces long, ids_sha256 string, round_trip boolean")
