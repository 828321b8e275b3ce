"""Language-model scores of texts by context-tree weighting over bytes, beside a unigram score of words.

A byte is eight binary decisions in the contexts of the 0 to `depth` bytes before it. Every context and decision is a node
with a Krichevsky-Trofimov estimate of its counts; a node weighs its own estimate against the mixture of the longer
contexts below it by the probabilities that both gave the training bytes. The trained tree gives every string of
`depth` + 1 bytes a fixed probability for its last byte, so a text's score is a sum over its strings.

The corpus is worked on in chunks of texts of bounded size. A chunk counts its words and byte strings and gives them out in
buckets by the bytes before the last one, packed. A bucket has whole subtrees: it adds its counts up, weighs two levels of the tree and
hands the sums of the level above on, where the next two are weighed in the same way. Then the estimates come down
again, and a bucket gives every chunk the values of just those words and strings that the chunk holds. No task or
driver ever holds the whole model. Strings that are not trained on have nodes without counts, which change nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import SPACES, bounded_batches, discard, numbered, store, utf8

DEPTH = 5
# bytes of text that share one dictionary in a task, about
CHUNK_BYTES = 32_000_000
# bytes whose words or strings are counted or looked up at a time
TILE = 1 << 20
# bytes of text for which there is one more bucket, and the least number of buckets
BUCKET_BYTES, BUCKETS_LEAST = 32_000_000, 24
# keys that are added up at a time, at least
MERGED_KEYS = 500_000
# logarithms of the gamma function that are looked up
TABLE = 1 << 12
SPACE = re.compile(f"[{SPACES}]".encode())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def texts_of(rows):
    """The texts of a group as bytes, those of one Arrow batch at a time."""
    for batch in rows.column("text").chunks:
        yield from utf8(batch)


def word_keys(words):
    """Negative 64-bit names of words; byte strings have names from 0 on. The end of a text is -1."""
    import numpy as np
    from xxhash import xxh64_intdigest

    return np.fromiter((-2 - (xxh64_intdigest(word) >> 2) for word in words), np.int64, len(words))


def word_lists(text: bytes):
    """The words of a text in lists for about TILE bytes each, so that a very long text never has all its words at once."""
    at = 0
    while at < len(text):
        space = SPACE.search(text, at + TILE)
        end = space.start() if space else len(text)
        yield text[at:end].lower().split()
        at = end


def tiles(texts, depth: int):
    """Numbered texts in lists of about TILE bytes, longer texts cut: the bytes before the first part, numbers, parts."""
    before, numbers, parts, size = bytes(depth), [], [], 0
    for number, text in texts:
        for at in range(0, len(text) or 1, TILE):
            if not parts:
                before = text[max(at - depth, 0) : at].rjust(depth, b"\0")
            part = text[at : at + TILE]
            numbers.append(number)
            parts.append(part)
            size += len(part)
            if size >= TILE or at + TILE < len(text):
                yield before, numbers, parts
                numbers, parts, size = [], [], 0
    if parts:
        yield before, numbers, parts


def strings_of(texts: list[bytes], depth: int, before: bytes | None = None):
    """The codes of the `depth` + 1 bytes that end at each byte of the texts, zeros standing before a text's start.

    `before` stands before the first text instead, where that goes on with a longer one.
    """
    import numpy as np

    pad = bytes(depth)
    data = np.frombuffer((pad if before is None else before) + pad.join(texts), np.uint8)
    code = np.zeros(len(data) - depth, np.int64)
    for i in range(depth + 1):
        code <<= 8
        code |= data[i : i + len(code)]
    sizes = np.array([len(t) for t in texts], np.int64)
    real = np.ones(len(code), bool)
    starts = np.cumsum(sizes + depth)[:-1] - depth if len(texts) > 1 else np.zeros(0, np.int64)
    for k in range(depth):
        real[starts + k] = False
    return code[real], sizes


class Sums:
    """Counts by integer key, added up when as many wait as are known: about twice the known keys are held."""

    def __init__(self):
        import numpy as np

        self.known, self.waiting, self.size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0

    def add(self, keys, counts) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size >= max(MERGED_KEYS, len(self.known[0])):
            self.total()

    def total(self):
        """Sorted keys and their counts."""
        import numpy as np

        if self.waiting:
            parts = [self.known, *self.waiting]
            self.known, self.waiting, self.size = None, [], 0
            keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            del parts
            # a stable sort finds the runs of the parts
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
            self.known = keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts
        return self.known


def counted(texts, depth: int):
    """Sorted keys and counts of the words and strings of (text, trains): what training texts have, zero for what others add."""
    import numpy as np

    sums, ends = Sums(), 0
    words, waiting = (Counter(), Counter()), 0

    def add_words() -> None:
        for trains, found in enumerate(words):
            keys = word_keys(found)
            order = np.argsort(keys)
            sums.add(keys[order], np.fromiter(found.values(), np.int64, len(found))[order] * trains)
            found.clear()

    def kept():
        nonlocal ends, waiting
        for text, trains in texts:
            ends += trains
            for some in word_lists(text):
                words[trains].update(some)
                waiting += len(some)
                if waiting >= TILE // 4:
                    add_words()
                    waiting = 0
            yield trains, text

    for before, trains, parts in tiles(kept(), depth):
        codes, sizes = strings_of(parts, depth, before)
        teaches = np.repeat(np.array(trains, bool), sizes)
        for learned in (True, False):
            keys, n = np.unique(codes[teaches == learned], return_counts=True)
            sums.add(keys, n * learned)
    add_words()
    sums.add(np.array([-1]), np.array([ends]))
    return sums.total()


class Lookup:
    """Values by integer key: hash tables of places, of falling size, each for the keys that found their slot taken."""

    def __init__(self, keys, values):
        import numpy as np

        self.keys, self.values, self.levels = keys, values, []
        seed, left = 0x9E3779B97F4A7C15, np.arange(len(keys), dtype=np.int32)
        while len(left):
            bits = max(int(len(left) * 3).bit_length(), 4)
            slots = self.slot(keys[left], seed, bits)
            at = np.zeros(1 << bits, np.int32)
            at[slots] = left
            self.levels.append((seed, bits, at))
            left, seed = left[at[slots] != left], seed * 3 % (1 << 64) | 1

    @staticmethod
    def slot(keys, seed: int, bits: int):
        import numpy as np

        slots = keys.view(np.uint64) * np.uint64(seed)
        slots >>= np.uint64(64 - bits)
        return slots.view(np.int64)

    def __call__(self, keys):
        """The values of keys that are all known."""
        import numpy as np

        out, left = np.zeros(len(keys), np.float64), None
        for seed, bits, at in self.levels:
            now = keys if left is None else keys[left]
            places = at[self.slot(now, seed, bits)]
            hit = self.keys[places] == now
            if left is None:
                out = self.values[places]
                left = np.flatnonzero(~hit)
            else:
                out[left[hit]] = self.values[places[hit]]
                left = left[~hit]
            if not len(left):
                break
        return out


def pack(values) -> bytes:
    """Numbers of eight bytes as compressed planes of their differences' bytes."""
    import numpy as np
    import pyarrow as pa

    steps = np.diff(values.view(np.int64), prepend=0)
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True)


def unpack(data: bytes, size: int):
    import numpy as np
    import pyarrow as pa

    planes = np.frombuffer(pa.decompress(data, size * 8, codec="zstd", asbytes=True), np.uint8).reshape(8, size)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def cut_below(depth: int) -> int:
    """The level whose contexts deal the level `depth` to buckets: two shorter, and one byte before none."""
    return depth - 2 if depth > 2 else int(depth > 1)


def bucket_of(context, buckets: int):
    """Of a context of at most four bytes, as a number or column."""
    return context * 0x5851F42D % 0x7FFFFFFF % buckets


def reversed_contexts(codes, depth: int):
    """The contexts of strings with the last byte highest, so that a shorter context is a beginning."""
    out = codes * 0
    for i in range(1, depth + 1):
        out = out << 8 | (codes >> 8 * i & 255)
    return out


def buckets_of(keys, depth: int, buckets: int):
    """Buckets of strings and words."""
    import numpy as np

    context = reversed_contexts(keys, depth) >> 8 * (depth - cut_below(depth))
    return bucket_of(np.where(keys < 0, -keys & 0xFFFFFF, context), buckets)


def chunk_counts(docs: DataFrame, depth: int, buckets: int) -> DataFrame:
    """bucket, chunk, size, keys, counts: the words and byte strings of every chunk of `docs` (chunk, text, trains), packed."""
    import pyarrow as pa

    def run(rows: pa.Table) -> pa.Table:
        import numpy as np

        keys, n = counted(zip(texts_of(rows), rows.column("trains").to_pylist(), strict=True), depth)
        at = buckets_of(keys, depth, buckets)
        order = np.argsort(at, kind="stable")
        keys, n, at = keys[order], n[order], at[order]
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        parts = [slice(a, b) for a, b in zip(starts, [*starts[1:], len(at)], strict=True)]
        number = rows.column("chunk")[0].as_py()
        out = [(int(at[p.start]), number, p.stop - p.start, pack(keys[p]), pack(n[p])) for p in parts]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.Table.from_arrays(columns, ["bucket", "chunk", "size", "keys", "counts"])

    return docs.groupBy("chunk").applyInArrow(run, "bucket long, chunk long, size long, keys binary, counts binary")


def sums_of(rows):
    """Sorted keys of a bucket and their counts in all chunks, from packed rows."""
    sums = Sums()
    for n, keys, counts in zip(*(rows.column(c).to_pylist() for c in ("size", "keys", "counts")), strict=True):
        sums.add(unpack(keys, n), unpack(counts, n))
    return sums.total()


def log_gamma_of(n, half: bool):
    """ln of the gamma function at n + 1/2 or n + 1 for whole n from 0 on."""
    import numpy as np

    add = 0.5 if half else 1.0
    table = np.array([math.lgamma(i + add) for i in range(min(TABLE, int(n.max()) + 1))])
    z = np.maximum(n, TABLE) + add
    series = (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3)
    return np.where(n < TABLE, table[np.minimum(n, len(table) - 1)], series)


def rise(key, n0, n1, below, deep: int, cut: int):
    """The levels from `deep` to above `cut`, and the nodes of the level `cut`: key, n0, n1 and below.

    Sorted keys: the node, then the context with its last byte first. A level has for each node its weight, its estimate and the place
    of its node on the next level. below: what the longer contexts gave, minus infinity where there are none.
    """
    import numpy as np

    levels = []
    for d in range(deep, cut, -1):
        # the Krichevsky-Trofimov probability of n0 zeros and n1 ones, whatever their order
        kt = log_gamma_of(n0, True) + log_gamma_of(n1, True) - log_gamma_of(n0 + n1, False) - math.log(math.pi)
        weighed = np.where(np.isinf(below), kt, np.logaddexp(kt, below) - math.log(2))
        own = 1 / (1 + np.exp(np.minimum(below - kt, 700.0)))
        up = key >> 8 if d else key
        first = np.diff(up, prepend=-1) != 0
        starts = np.flatnonzero(first)
        levels.append((own, (n1 + 0.5) / (n0 + n1 + 1), np.cumsum(first) - 1))
        key, n0, n1, below = up[starts], np.add.reduceat(n0, starts), np.add.reduceat(n1, starts), np.add.reduceat(weighed, starts)
    return levels, (key, n0, n1, below)


def fall(levels, mixed, rest):
    """The mixture so far and the weight that longer contexts share, carried down from the level above the levels."""
    for own, estimate, parent in reversed(levels):
        share = rest[parent]
        mixed, rest = mixed[parent] + share * own * estimate, share * (1 - own)
    return mixed, rest


def decisions(codes, counts, depth: int):
    """For each of the eight bits: the strings' bits, their places among its nodes, and the nodes as `rise` takes them."""
    import numpy as np

    context, byte = reversed_contexts(codes, depth), codes & 255
    for j in range(8):
        key = (1 << j | byte >> 8 - j) << 8 * depth | context
        bit = byte >> 7 - j & 1
        order = np.argsort(key, kind="stable")
        first = np.diff(key[order], prepend=-1) != 0
        starts = np.flatnonzero(first)
        place = np.empty(len(key), np.int64)
        place[order] = np.cumsum(first) - 1
        ones, both = np.add.reduceat((counts * bit)[order], starts), np.add.reduceat(counts[order], starts)
        yield bit, place, (key[order[starts]], both - ones, ones, np.full(len(starts), -np.inf))


NODES = "key long, n0 long, n1 long, below double"
ESTIMATES = "key long, mixed double, rest double"


def node_table(parts):
    import numpy as np
    import pyarrow as pa

    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    return pa.Table.from_arrays([pa.array(x) for x in columns], ["key", "n0", "n1", "below"])


def columns_of(table, *names: str):
    """Columns sorted by the first one."""
    import numpy as np

    columns = [table.column(n).to_numpy() for n in names]
    order = np.argsort(columns[0], kind="stable")
    return [c[order] for c in columns]


def dealt(nodes: DataFrame, level: int, by: int, buckets: int) -> DataFrame:
    """Nodes of a level with the bucket of the last `by` bytes of their contexts."""
    context = F.shiftright(F.col("key").bitwiseAND(F.lit((1 << 8 * level) - 1).cast("long")), 8 * (level - by))
    return nodes.withColumn("bucket", bucket_of(context, buckets))


def first_nodes(counts: DataFrame, depth: int) -> DataFrame:
    """The nodes of the level below the strings' two, and under key 0 in n0 and n1 the words' counts and number."""
    import pyarrow as pa

    cut = cut_below(depth)

    def run(rows: pa.Table) -> pa.Table:
        import numpy as np

        keys, n = sums_of(rows)
        word = keys < 0
        totals = [np.array([x]) for x in (0, n[word].sum(), (n[word] > 0).sum(), 0.0)]
        parts = [totals]
        if not word.all():
            parts += [rise(*nodes, depth, cut)[1] for _, _, nodes in decisions(keys[~word], n[~word], depth)]
        return node_table(parts)

    return counts.groupBy("bucket").applyInArrow(run, NODES)


def next_nodes(nodes: DataFrame, level: int, buckets: int) -> DataFrame:
    """The nodes two levels up, from those of a level."""
    import pyarrow as pa

    cut = cut_below(level)

    def run(rows: pa.Table) -> pa.Table:
        return node_table([rise(*columns_of(rows, "key", "n0", "n1", "below"), level, cut)[1]])

    return dealt(nodes, level, cut, buckets).groupBy("bucket").applyInArrow(run, NODES)


def estimates(nodes: DataFrame, above: DataFrame, level: int, buckets: int) -> DataFrame:
    """ESTIMATES of a level's nodes from those two levels up."""
    import pyarrow as pa

    cut = cut_below(level)

    def run(rows: pa.Table, higher: pa.Table) -> pa.Table:
        key, *rest = columns_of(rows, "key", "n0", "n1", "below")
        levels, _ = rise(key, *rest, level, cut)
        # both sides have the same nodes of the level above
        _, mixed, share = columns_of(higher, "key", "mixed", "rest")
        return pa.Table.from_arrays([pa.array(x) for x in (key, *fall(levels, mixed, share))], ["key", "mixed", "rest"])

    mine, higher = dealt(nodes, level, cut, buckets), dealt(above, cut, cut, buckets)
    return mine.groupBy("bucket").cogroup(higher.groupBy("bucket")).applyInArrow(run, ESTIMATES)


def top_estimates(nodes, level: int):
    """ESTIMATES of the nodes of contexts of one byte or none, at most 65 280 of them."""
    import numpy as np
    import pyarrow as pa

    key, n0, n1, below = columns_of(nodes, "key", "n0", "n1", "below")
    mixed = rest = np.zeros(0)
    if len(key):
        levels, (first, *_) = rise(key, n0, n1, below, level, -1)
        mixed, rest = fall(levels, np.zeros(len(first)), np.ones(len(first)))
    return pa.Table.from_arrays([pa.array(x) for x in (key, mixed, rest)], ["key", "mixed", "rest"])


def chunk_values(counts: DataFrame, above: DataFrame, depth: int, buckets: int) -> DataFrame:
    """chunk, size, keys, found: the value of every key of a chunk: a word's count, log10 of the probability of a string's last byte."""
    import pyarrow as pa

    cut = cut_below(depth)

    def run(rows: pa.Table, higher: pa.Table) -> pa.Table:
        import numpy as np

        keys, n = sums_of(rows)
        values, word = n.astype(np.float64), keys < 0
        if not word.all():
            key, mixed, share = columns_of(higher, "key", "mixed", "rest")
            total = np.zeros(len(keys) - word.sum())
            for bit, place, nodes in decisions(keys[~word], n[~word], depth):
                levels, (first, *_) = rise(*nodes, depth, cut)
                at = np.searchsorted(key, first)
                low, rest = fall(levels, mixed[at], share[at])
                one = (low + 0.5 * rest)[place]
                total += np.log10(np.where(bit == 1, one, 1 - one))
            values[~word] = total
        sizes, packed = rows.column("size").to_pylist(), rows.column("keys").to_pylist()
        found = [pack(values[np.searchsorted(keys, unpack(k, size))]) for k, size in zip(packed, sizes, strict=True)]
        columns = [rows.column("chunk"), rows.column("size"), pa.array(packed, pa.binary()), pa.array(found, pa.binary())]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], ["chunk", "size", "keys", "found"])

    higher = dealt(above, cut, cut, buckets)
    return counts.groupBy("bucket").cogroup(higher.groupBy("bucket")).applyInArrow(run, "chunk long, size long, keys binary, found binary")


def score_texts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The scores of every row of `docs` (doc_id long, text).

    Texts of rows whose crc32(doc_id as text) mod 5 is 1 are held out, all others train. Columns: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score (unigram words, add one half), score (log10 of the text's probability
    in the tree), n_bytes and bits_per_byte (null for an empty text). Null texts are empty, an empty text is one end
    token and has score 0. Rows with a null doc_id train; repeated rows count as often as they stand; without training
    texts every bit has probability one half. Other columns are ignored. Texts are dealt to chunks by their rows' numbers.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    bounded_batches(spark)
    rows = numbered(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    chunks, buckets = size // CHUNK_BYTES + 1, size // BUCKET_BYTES + BUCKETS_LEAST
    placed = rows.select(F.pmod(F.xxhash64("row"), F.lit(chunks)).alias("chunk"), "doc_id", "text")
    marked = placed.select("chunk", "text", (~held_out(F.col("doc_id"))).alias("trains"))
    counts = store(chunk_counts(marked, depth, buckets), "counts")
    levels, ups = [cut_below(depth)], [store(first_nodes(counts, depth), "tree")]
    words = ups[0].filter("key = 0").agg(F.sum("n0").alias("n"), F.sum("n1").alias("v")).first()
    n, v = words["n"] or 0, words["v"] or 0
    while levels[-1] > 1:
        ups.append(store(next_nodes(ups[-1].filter("key > 0"), levels[-1], buckets), "tree"))
        levels.append(cut_below(levels[-1]))
    above = spark.createDataFrame(top_estimates(ups[-1].filter("key > 0").toArrow(), levels[-1]), ESTIMATES)
    stored = []
    for nodes, level in reversed(list(zip(ups[:-1], levels[:-1], strict=True))):
        above = store(estimates(nodes.filter("key > 0"), above, level, buckets), "tree")
        stored.append(above)
    dictionary = store(chunk_values(counts, above, depth, buckets), "dictionary")
    discard(counts, *ups, *stored)

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        import numpy as np

        sizes = known.column("size").to_pylist()
        keys = np.concatenate([unpack(k, m) for k, m in zip(known.column("keys").to_pylist(), sizes, strict=True)])
        found = np.concatenate([unpack(k, m) for k, m in zip(known.column("found").to_pylist(), sizes, strict=True)]).view(np.float64)
        of_word = keys < 0
        order = np.argsort(keys[of_word])
        names, counts = keys[of_word][order], found[of_word][order]
        lookup = Lookup(keys[~of_word], found[~of_word])
        below = n + 0.5 * (v + 1)
        end = counts[-1]
        columns = [np.full(texts.num_rows, x) for x in (1, int(end > 0), math.log10((end + 0.5) / below), 0.0, 0)]
        n_tokens, n_known, base_score, in_tree, n_bytes = columns
        lists, waiting = [], 0

        def add_words() -> None:
            distinct = list(set().union(*(words for _, words in lists)))
            c = counts[np.searchsorted(names, word_keys(distinct))]
            base = dict(zip(distinct, np.log10((c + 0.5) / below).tolist(), strict=True))
            unknown = {distinct[i] for i in np.flatnonzero(c == 0)}
            for number, words in lists:
                n_tokens[number] += len(words)
                n_known[number] += len(words) - sum(map(unknown.__contains__, words))
                base_score[number] += sum(map(base.__getitem__, words))
            lists.clear()

        def kept():
            nonlocal waiting
            for number, text in enumerate(texts_of(texts)):
                for some in word_lists(text):
                    lists.append((number, some))
                    waiting += len(some)
                    if waiting >= TILE // 4:
                        add_words()
                        waiting = 0
                yield number, text

        for before, numbers, parts in tiles(kept(), depth):
            codes, sizes = strings_of(parts, depth, before)
            total = np.concatenate([[0.0], np.cumsum(lookup(codes))])
            ends = np.cumsum(sizes)
            # a text has one part in a tile
            in_tree[numbers] += total[ends] - total[ends - sizes]
            n_bytes[numbers] += sizes
        add_words()
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        arrays = [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)]
        arrays = [texts.column("doc_id"), *arrays]
        return pa.Table.from_arrays(arrays, ["doc_id", "n_tokens", "n_known", "base_score", "score", "n_bytes"])

    scored = placed.groupBy("chunk").cogroup(dictionary.groupBy("chunk")).applyInArrow(
        score, "doc_id long, n_tokens long, n_known long, base_score double, score double, n_bytes long"
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "n_bytes",
        (-F.col("score") * math.log2(10) / F.nullif(F.col("n_bytes"), F.lit(0))).alias("bits_per_byte"),
    )
