"""Groups of near copies among texts: MinHash bands find candidates, exact Jaccard similarity of word shingles decides."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import bounded_batches, components, discard, store, utf8

SHINGLE = 5
SIMILARITY = 0.8
# a pair at SIMILARITY shares no band with a probability of (1 - 0.8 ** ROWS) ** BANDS, 5e-9
ROWS, BANDS = 5, 48
# of the BANDS * ROWS last bits of the minima a pair at SIMILARITY shares 0.9, with a standard deviation of 4.6 bits
LEAST_BITS = 186
SEED = 5


def shingles_of(text: bytes, shingle: int = SHINGLE):
    """The sorted distinct 64-bit hashes of a text's word shingles; of all its words if they are fewer; none without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) > shingle else [words]
    return np.unique(np.array([xxh64_intdigest(b" ".join(p), SEED) for p in parts], np.uint64))


def minima(hashes):
    """The least value of the hashes under each of BANDS * ROWS random orders."""
    import numpy as np

    draw = np.random.default_rng(SEED)
    factor = draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    plus = draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for low in range(0, len(hashes), 256):
        least = np.minimum(least, (hashes[None, low : low + 256] * factor[:, None] + plus[:, None]).min(axis=1))
    return least


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, name (of the set of shingles, two hashes), n (its size), buckets and bits for every row (doc_id long, text)."""
    import pyarrow as pa

    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from xxhash import xxh64_intdigest

        signed = lambda n: n - (1 << 64) if n >> 63 else n
        for batch in batches:
            rows = []
            for text in utf8(batch.column(1)):
                hashes = shingles_of(text)
                data, least = hashes.tobytes(), minima(hashes)
                # the middle bits stand for a value, as the last ones of a product follow those of its factors
                bits = np.packbits((least >> np.uint64(32) & np.uint64(1)).astype(np.uint8))
                bits = np.concatenate([bits, np.zeros(32 - len(bits), np.uint8)]).view("<i8").tolist()
                bands = [signed(xxh64_intdigest(band.tobytes(), i)) for i, band in enumerate(least.reshape(BANDS, ROWS))]
                name = [signed(xxh64_intdigest(data, seed)) for seed in (1, 2)]
                rows.append((name[0], name[1], len(hashes), bands if len(hashes) else [], *bits))
            fields = [pa.int64()] * 3 + [pa.list_(pa.int64())] + [pa.int64()] * 4
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], NAMES)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, x long, y long, n long, buckets array<long>, b0 long, b1 long, b2 long, b3 long")


NAMES = ["doc_id", "x", "y", "n", "buckets", "b0", "b1", "b2", "b3"]


def alike(a: str, b: str):
    """Whether sizes and bits of two rows (struct columns) leave a similarity of SIMILARITY possible."""
    large, small = F.greatest(f"{a}.n", f"{b}.n"), F.least(f"{a}.n", f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.b{i}").bitwiseXOR(F.col(f"{b}.b{i}"))) for i in range(4)), F.lit(0))
    return (small >= SIMILARITY * large) & (differ <= BANDS * ROWS - LEAST_BITS)


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id and set, the sorted shingle hashes, of the rows (doc_id, text) whose doc_id is among `ids` (id)."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            sets = [shingles_of(text).view(np.int64) for text in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "set"])

    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string"))
    texts = texts.join(ids.select("id").distinct(), "id", "left_semi")
    return store(texts.mapInArrow(run, "id long, set array<long>"), "sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those distinct pairs (a, b) whose sets of shingles have a Jaccard similarity of SIMILARITY or more."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("s")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("set").alias("t")), "b")
    shared = F.size(F.array_intersect("s", "t"))
    return store(both.filter(shared / (F.size("s") + F.size("t") - shared) >= SIMILARITY).select("a", "b"), "links")


def close_pairs(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of different roots that may be similar: an exact set join by prefixes of rare shingles.

    sets: id, set; ids: id, root and marks m. With the shingles of every set ordered from rare to frequent, two similar sets
    share one among the first fifth of the larger set and the first ninth of the smaller one: what both have in common
    makes up so much of each that it cannot lie in what is left. Shingles of one set alone come first and meet nothing.
    Of a shingle's sets those of its commonest root are not paired with each other.
    """
    n = F.size("set").alias("n")
    shingles = sets.select("id", F.explode("set").alias("h"))
    counts = store(shingles.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1"), "counts")
    ordered = shingles.join(counts, "h").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("k", "h"))).alias("s"))
    placed = ordered.join(sets.select("id", n), "id")
    alone = F.col("n") - F.size("s")
    # positions from 0: the last one that a common shingle may have in the larger and in the smaller set
    larger = F.col("n") - F.ceil(F.col("n") * SIMILARITY - 1e-9) - alone
    smaller = F.col("n") - F.ceil(F.col("n") * (2 * SIMILARITY / (1 + SIMILARITY)) - 1e-9) - alone
    prefix = F.slice("s", F.lit(1), F.greatest(larger + 1, F.lit(0)).cast("int"))
    entries = placed.select("id", "n", smaller.alias("last"), F.posexplode(prefix).alias("at", "e"))
    entries = entries.select("id", "n", (F.col("at") <= F.col("last")).alias("near"), F.col("e.h").alias("h"))
    entries = store(entries.join(ids, "id"), "prefixes")
    sizes = entries.groupBy("h", "root").agg(F.count("*").alias("k"))
    most = sizes.groupBy("h").agg(F.count("*").alias("roots"), F.max(F.struct("k", "root")).alias("most"))
    most = store(most.filter("roots > 1").select("h", F.col("most.root").alias("most")), "roots")
    apart = store(entries.join(most, "h"), "prefixes")
    left = apart.filter("root != most").select("h", "most", "id", "root", "m", "n", "near")
    names = {"id": "other", "root": "end", "m": "w", "n": "o", "near": "close"}
    right = apart.select("h", *[F.col(c).alias(to) for c, to in names.items()])
    once = (F.col("root") != F.col("end")) & ((F.col("end") == F.col("most")) | (F.col("id") < F.col("other")))
    fits = F.when(F.col("n") < F.col("o"), F.col("near")).when(F.col("n") > F.col("o"), F.col("close")).otherwise(F.col("near") & F.col("close"))
    pairs = left.join(right, "h").filter(once & fits & alike("m", "w"))
    pairs = pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
    pairs = store(pairs.distinct(), "pairs")
    discard(counts, entries, most, apart)
    return pairs


def similar_groups(docs: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """doc_id and component_id for every row of `docs` (doc_id long, unique and not null, text), read several times.

    Rows are linked whose sets of SHINGLE-word shingles (A to Z lower-cased) have a Jaccard similarity of SIMILARITY or
    more; shorter texts are one shingle, and those without words, null or empty, are equal. component_id is the smallest
    doc_id that links can reach. A very long text is one set, held by one task at a time. An empty table gives no rows.

    Equal sets are one class. Classes that share a band are candidates, and so are the pairs (a, b) of doc_ids that the
    caller found. First these are compared, and each class meets two others of its bucket; what that links is one component. Classes of buckets whose components are still apart are then joined with each other by
    prefixes of rare shingles, so that neither a large group of near copies nor many texts with a passage in common make
    all their pairs, and no pair is left out.
    """
    rows = store(signatures(docs), "signatures")
    classes = rows.groupBy("x", "y").agg(F.min(F.struct(*NAMES)).alias("r"))
    classes = store(classes.select("r.*"), "classes")
    places = classes.select(F.col("doc_id").alias("id"), F.explode("buckets").alias("bucket"))
    full = places.groupBy("bucket").agg(F.count("*").alias("k"), F.min("id").alias("p"), F.max("id").alias("q"))
    full = full.filter("k > 1")
    met = store(places.join(full, "bucket").select("bucket", "id", "p", "q"), "buckets")
    # from here on classes go without their buckets
    marks = F.struct("n", "b0", "b1", "b2", "b3").alias("m")
    names = store(rows.select("doc_id", "x", "y"), "names")
    marked = store(classes.select("x", "y", F.col("doc_id").alias("id"), marks), "marks")
    discard(rows, classes)
    tried = met.select("id", F.explode(F.array("p", "q")).alias("other")).filter("id != other")
    tried = tried.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    tried = tried.join(marked.select(F.col("id").alias("a"), "m"), "a")
    tried = tried.join(marked.select(F.col("id").alias("b"), F.col("m").alias("w")), "b")
    tried = tried.filter(alike("m", "w")).select("a", "b")
    if candidates is not None:
        class_of = names.join(marked.select("x", "y", "id"), ["x", "y"])
        given = candidates.join(class_of.select(F.col("doc_id").alias("a"), F.col("id").alias("p")), "a")
        given = given.join(class_of.select(F.col("doc_id").alias("b"), F.col("id").alias("q")), "b").filter("p != q")
        tried = tried.unionByName(given.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))).distinct()
    tried = store(tried, "pairs")
    sets = shingle_sets(docs, tried.select(F.explode(F.array("a", "b")).alias("id")))
    links = verified(tried, sets)
    discard(sets, tried)
    roots = store(components(links).withColumnRenamed("node", "id"), "roots")
    root = F.coalesce("root", "id").alias("root")
    found = met.select("bucket", "id").join(roots, "id", "left").select("bucket", "id", root)
    split = found.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    unsettled = found.join(split.select("bucket"), "bucket").select("id", "root").distinct()
    unsettled = store(unsettled.join(marked.select("id", "m"), "id"), "unsettled")
    discard(met)
    if not unsettled.isEmpty():
        sets = shingle_sets(docs, unsettled)
        pairs = close_pairs(sets, unsettled)
        more = verified(pairs, sets)
        discard(sets, pairs)
        if not more.isEmpty():
            discard(roots)
            roots = store(components(links.unionByName(more)).withColumnRenamed("node", "id"), "roots")
        discard(more)
    discard(links, unsettled)
    named = marked.select("x", "y", "id").join(roots, "id", "left").select("x", "y", root)
    return names.join(named, ["x", "y"]).select("doc_id", F.col("root").alias("component_id"))
