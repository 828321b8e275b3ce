"""Removal of byte strings that occur twice, by distributed prefix doubling over sampled positions.

Prefix doubling ranks all positions by their first byte, then by pairs of ranks at growing offsets. Over every byte that
takes one sorted row per position and round. Here the doubling rounds up to 64 bytes, whose pairs never leave a
document, name byte strings by hashes within a task, and only sampled positions go through Spark:

* A string of `length` bytes stands for the position in it where the name of the next SHORT bytes is least (the first of
  equals). That depends on its bytes alone, so equal strings choose the same place. About one position in 60 is chosen
  at all; each has the run of strings that chose it.
* Round 1 groups the chosen positions by the names of their SHORT bytes. A position with a name of its own has no
  repeat and leaves.
* Round 2 pairs that name with names at larger offsets, up to the end of the position's last string. Positions that
  agree there are past the threshold with all their strings.
* Round 3 takes, for what is left, the strings one by one, as pairs of names that reach to `length` bytes.

Every round is an aggregation by names of 64 bits; the wider names go with those of round 1, so two have to agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rowferry.llm.common import bounded_batches, discard, numbered, store, utf8

# bytes of a string; 128 to 256
LENGTH = 200
# bytes of the first names that Spark ranks; 64 to 128
SHORT = 80
# bytes that are ranked at a time in a task
TILE = 1 << 18


def mix(x, y):
    """A name of 64 bits for each pair of names."""
    import numpy as np

    y = y ^ (y >> np.uint64(29))
    y *= np.uint64(0xBF58476D1CE4E5B9)
    z = x * np.uint64(0x9E3779B97F4A7C15)
    z += y
    z ^= z >> np.uint64(32)
    return z


def names64(data):
    """The names of the 64 bytes from each position on: six doublings."""
    import numpy as np

    table = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    table ^= table >> np.uint64(31)
    names = table[data]
    for step in (1, 2, 4, 8, 16, 32):
        names = mix(names[:-step], names[step:])
    return names


def long_names(names, at, length: int):
    """The names of the `length` (128 to 256) bytes from the given positions on, from those of 64 bytes."""
    import numpy as np

    def doubled(at):
        return mix(names[at], names[at + 64])

    return mix(doubled(at), doubled(at + np.int64(length - 128)))


def tiles(texts: list[bytes], length: int) -> Iterator[tuple[object, object, object, object]]:
    """Texts of at least `length` bytes, laid end to end in tiles: bytes, and by piece of text its text's number, its
    place in the tile and its place in the text. A long text is cut into overlapping pieces, each string in one."""
    import numpy as np

    parts, size = [], 0

    def tile():
        data = np.frombuffer(b"".join(p for _, p, _ in parts), np.uint8)
        sizes = np.array([len(p) for _, p, _ in parts], np.int64)
        return data, np.array([i for i, _, _ in parts]), np.cumsum(sizes) - sizes, np.array([s for _, _, s in parts])

    for i, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, TILE):
            piece = text[start : start + TILE + length - 1]
            parts.append((i, piece, start))
            size += len(piece)
            if size >= TILE:
                yield tile()
                parts, size = [], 0
    if parts:
        yield tile()


def anchors_of(texts: list[bytes], length: int = LENGTH):
    """The chosen positions of texts as arrays: text, first string's start, strings less one, name, wider name."""
    import numpy as np

    out = []
    for data, text, begins, starts in tiles(texts, length):
        ends = np.append(begins[1:], len(data))
        names = names64(data)
        small = mix(names[: len(names) + 64 - SHORT], names[SHORT - 64 :])
        place = np.arange(len(small), dtype=np.uint64)
        # the least name with the first place: 44 bits of the name over 20 of the place
        least = (small & np.uint64(0xFFFFFFFFFFF00000)) | place
        width, reach = length - SHORT + 1, 1
        while reach * 2 <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: reach - width], least[width - reach :])
        chosen = (least & np.uint64(0xFFFFF)).astype(np.int64)
        piece = np.repeat(np.arange(len(begins)), ends - begins)[: len(chosen)]
        strings = np.flatnonzero(np.arange(len(chosen)) + length <= ends[piece])  # those inside one text
        chosen, piece = chosen[strings], piece[strings]
        new = np.ones(len(strings), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (piece[1:] != piece[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(strings)) - 1
        low, high, at, piece = strings[first], strings[last], chosen[first], piece[first]
        wide = mix(long_names(names, low, length), long_names(names, high, length))
        wide = mix(wide, ((at - low) << 32 | (high - low)).astype(np.uint64))
        out.append((text[piece], low - begins[piece] + starts[piece], high - low, small[at].view(np.int64), wide.view(np.int64)))
    kinds = (np.int64, np.int64, np.int64, np.int64, np.int64)
    return [np.concatenate([x[j] for x in out]) if out else np.zeros(0, kinds[j]) for j in range(5)]


def flat_runs(column):
    """The runs of an Arrow list column of structs: the rows they belong to, then their fields, as arrays."""
    import numpy as np

    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    fields = column.flatten().flatten()
    return [np.repeat(np.arange(len(column)), sizes), *(f.to_numpy(zero_copy_only=False) for f in fields)]


def string_names(texts: list[bytes], owner, low, more, length: int = LENGTH) -> Iterator[tuple[object, object, object]]:
    """The names of all strings of runs (text, first start, strings less one): run, start, name."""
    import numpy as np

    first = 0
    while first < len(low):
        last, size = first, 0
        while last < len(low) and size < TILE:
            size += int(more[last]) + length
            last += 1
        cut = zip(owner[first:last].tolist(), low[first:last].tolist(), more[first:last].tolist(), strict=True)
        data = np.frombuffer(b"".join([texts[i][a : a + n + length] for i, a, n in cut]), np.uint8)
        strings = more[first:last] + 1
        begins = np.cumsum(strings + length - 1) - (strings + length - 1)
        run = np.repeat(np.arange(last - first), strings)
        step = np.arange(len(run)) - np.repeat(np.cumsum(strings) - strings, strings)
        names = long_names(names64(data), begins[run] + step, length)
        yield run + first, low[first:last][run] + step, names
        first = last


def merged(owner, low, more, length: int = LENGTH):
    """Maximal byte ranges that runs of strings cover, by text number: owner, start, end, in order."""
    import numpy as np

    if not len(low):
        return owner, low, low
    # texts lie apart on one line
    base = owner.astype(np.int64) << 40
    order = np.argsort(base + low, kind="stable")
    start = (base + low)[order]
    end = np.maximum.accumulate(start + more[order] + length)
    first = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    last = np.append(first[1:], len(start)) - 1
    which = start[first] >> 40
    return which, start[first] - (which << 40), end[last] - (which << 40)


def repeated_runs(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """row and runs, an array of (low, more): the repeated strings of `texts` (row long, text) as runs of starts."""
    import numpy as np
    import pyarrow as pa

    spark = texts.sparkSession
    bounded_batches(spark)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, low, more, name, wide = anchors_of(list(utf8(batch.column(1))), length)
            rows = batch.column(0).to_numpy(zero_copy_only=False)[text]
            columns = [pa.array(rows, pa.int64()), pa.array(low, pa.int64()), pa.array(more.astype("i4")), pa.array(name), pa.array(wide)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "low", "more", "name", "wide"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = batch.column(0).to_numpy(zero_copy_only=False), list(utf8(batch.column(1)))
            owner, low, more, name, alone = flat_runs(batch.column(2))
            for run, at, names in string_names(texts, owner, low, more, length):
                # the name of a string goes with the name its position had in round 1
                names = mix(name.view(np.uint64)[run], names).view(np.int64)
                columns = [pa.array(rows[owner[run]]), pa.array(at), pa.array(names), pa.array(alone[run])]
                for from_ in range(0, len(run), 1 << 17):
                    part = [c.slice(from_, 1 << 17) for c in columns]
                    yield pa.RecordBatch.from_arrays(part, ["row", "low", "string", "alone"])

    chosen = store(texts.mapInArrow(choose, "row long, low long, more int, name long, wide long"), "anchors")
    # round 1: names that occur once leave
    groups = chosen.groupBy("name").agg(F.count("*").alias("n"), F.min("wide").alias("a"), F.max("wide").alias("b"))
    # stored, so that the join below reads nothing but shuffles, which can be split where a name is frequent
    groups = store(groups.filter("n > 1").select("name", (F.col("a") != F.col("b")).alias("mixed")), "names")
    left = store(chosen.join(groups, "name"), "anchors")
    discard(chosen, groups)
    # round 2: positions that agree with another one up to the end of their last string
    rep = F.min(F.struct("row", "low", "more")).alias("first")
    wider = store(left.filter("mixed").groupBy("name", "wide").agg(F.count("*").alias("n"), rep), "anchors")
    full = left.filter("NOT mixed").select("row", "low", "more")
    many = wider.filter("n > 1").select("name", "wide")
    full = full.unionByName(left.filter("mixed").join(many, ["name", "wide"]).select("row", "low", "more"))
    # round 3: the strings of one position per wider name
    one = wider.select("first.*", "name", (F.col("n") == 1).alias("alone"))
    listed = one.groupBy("row").agg(F.collect_list(F.struct("low", "more", "name", "alone")).alias("runs"))
    spelled = texts.join(listed, "row").select("row", "text", "runs")
    strings = store(spelled.mapInArrow(spell, "row long, low long, string long, alone boolean"), "strings")
    twice = store(strings.groupBy("string").agg(F.count("*").alias("n")).filter("n > 1").select("string"), "names")
    single = store(strings.filter("alone").join(twice, "string").select("row", "low"), "strings")
    discard(strings, twice)
    found = full.unionByName(single.select("row", "low", F.lit(0).alias("more")))
    return found.groupBy("row").agg(F.collect_list(F.struct("low", "more")).alias("runs"))


def remove_repeats(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), length: int = LENGTH, texts: bool = False) -> DataFrame:
    """Every row of `docs` (text) without the bytes that a repeated string of `length` bytes covers.

    Strings start anywhere in the UTF-8 bytes of a text (null: empty), never cross documents, and are judged on the
    input; a string is repeated if it starts anywhere else, in the same document too. Beside the columns named in
    `carry`: n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 of the remaining bytes, and with `texts` kept,
    the remaining bytes as text, where a character goes if any of its bytes does. Texts shorter than `length` stay as
    they are. Repeated rows are documents of their own, and so repeats of each other. Carried columns that clash with
    an output column are replaced by it. Rows are numbered alike in every pass.
    """
    import pyarrow as pa

    bounded_batches(docs.sparkSession)
    out = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if texts else [])]
    carry = tuple(c for c in dict.fromkeys(carry) if c not in out)
    rows = numbered(docs, F.col("text").cast("string"), F.struct(*carry).alias("rest"))
    runs = repeated_runs(rows.select("row", "text"), length)
    joined = rows.join(runs, "row", "left").select("rest", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, low, more = flat_runs(batch.column(2))
            owner, low, high = (x.tolist() for x in merged(owner, low, more, length))
            rows, at = [], 0
            for i, text in enumerate(utf8(batch.column(1))):
                parts, end, first = [], 0, at
                while at < len(owner) and owner[at] == i:
                    parts.append(text[end : low[at]])
                    end = high[at]
                    at += 1
                parts.append(text[end:])
                kept = b"".join(parts)
                row = [len(text), len(text) - len(kept), at - first, hashlib.sha256(kept).hexdigest()]
                rows.append(row + ["".join(p.decode("utf-8", "ignore") for p in parts)] * texts)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array([r[j] for r in rows], kinds[j]) for j in range(len(out))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["rest", *out])

    kinds = [StructField(name, StringType() if name.startswith("kept") else LongType()) for name in out]
    schema = StructType([*rows.select("rest").schema, *kinds])
    return joined.mapInArrow(cut, schema).select("rest.*", *out)
