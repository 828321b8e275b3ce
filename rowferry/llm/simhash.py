"""SimHash fingerprints and the components of fingerprints at a small Hamming distance, by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import bounded_batches, components, store, utf8

SEED = 42
RADIUS = 2
HALF = 32
# a bucket of more fingerprints than this is searched by enumerating neighbours, of which there are no more
HOT_BUCKET = 1 + 32 + 32 * 31 // 2


def fingerprint_of(text: bytes, shingle: int = 3) -> int:
    """The 64 majority bits over the hashes of a text's word shingles, repeats included; zero without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        hashes = [xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)), strict=False)]
    table = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(table), 1 << 16):
        ones += np.unpackbits(table[start : start + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, for every row of `docs` (doc_id long, text)."""
    import pyarrow as pa

    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint_of(text, shingle) for text in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, HALF)


def low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit((1 << HALF) - 1))


def shifted(value: Column, by: int = HALF) -> Column:
    return F.shiftleft(value.cast("long"), by)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def ball(value: Column, radius: Column | int) -> Column:
    """All values that differ from the 32-bit value in at most `radius` (0 to 2) bits."""
    one = [1 << i for i in range(HALF)]
    two = [x | y for i, x in enumerate(one) for y in one[:i]]
    radius = F.lit(radius) if isinstance(radius, int) else radius
    masks = F.when(radius == 2, F.array(*map(F.lit, [0, *one, *two]))).otherwise(
        F.when(radius == 1, F.array(*map(F.lit, [0, *one]))).otherwise(F.array(F.lit(0)))
    )
    return F.transform(masks.cast("array<bigint>"), lambda mask: value.bitwiseXOR(mask))


def hamming_links(prints: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """Pairs a < b of the distinct fingerprints (column fp) that differ in at most two bits, each pair once.

    The upper halves differ in at most one bit, or the lower halves are equal. For the first case a fingerprint looks up
    its upper half and those with one more bit set; for the second its lower half; matches are verified on all bits.
    A bucket that holds more than `hot` fingerprints is not read as a whole: there the other half's Hamming ball, of
    at most 529 values, is enumerated too and whole fingerprints are looked up. So work per fingerprint is bounded.
    """
    table = prints.select("fp", high(F.col("fp")).alias("hi"), low(F.col("fp")).alias("lo"))
    crowded = lambda half: store(table.groupBy(half).count().filter(F.col("count") > hot).select(half))
    hot_hi, hot_lo = crowded("hi"), crowded("lo")
    whole = table.select(F.col("fp").alias("b"))
    flips = F.array(*(F.lit(1 << i) for i in range(HALF))).cast("array<bigint>")
    up = F.filter(flips, lambda m: F.col("hi").bitwiseAND(m) == 0)
    flip = F.explode(F.concat(F.array(F.lit(0).cast("long")), up))
    probes = table.select("fp", "lo", flip.alias("flip"), "hi")
    used, key = (F.col("flip") != 0).cast("int").alias("used"), F.col("hi").bitwiseOR(F.col("flip")).alias("key")
    probes = probes.select("fp", "lo", used, key)
    target = table.select(F.col("fp").alias("b"), F.col("hi").alias("key"), F.col("lo").alias("lo_b"))
    quiet = target.join(hot_hi.withColumnRenamed("hi", "key"), "key", "left_anti") if not hot_hi.isEmpty() else target
    near = probes.join(quiet, "key").filter(distance(F.col("lo"), F.col("lo_b")) <= RADIUS - F.col("used"))
    near = near.filter((F.col("used") == 1) | (F.col("fp") < F.col("b"))).select(F.col("fp").alias("a"), "b")
    pairs = [near]
    if not hot_hi.isEmpty():
        busy = probes.join(hot_hi.withColumnRenamed("hi", "key"), "key", "left_semi")
        busy = busy.withColumn("lo_b", F.explode(ball(F.col("lo"), RADIUS - F.col("used"))))
        busy = busy.withColumn("b", shifted(F.col("key")).bitwiseOR(F.col("lo_b")))
        busy = busy.filter((F.col("used") == 1) | (F.col("fp") < F.col("b"))).select(F.col("fp").alias("a"), "b")
        pairs.append(busy.join(whole, "b").select("a", "b"))
    left = table.select(F.col("fp").alias("a"), "lo", F.col("hi").alias("hi_a"))
    right = table.select(F.col("fp").alias("b"), "lo", F.col("hi").alias("hi_b"))
    if not hot_lo.isEmpty():
        busy = left.join(hot_lo, "lo", "left_semi").withColumn("hi_b", F.explode(ball(F.col("hi_a"), RADIUS)))
        busy = busy.filter(distance(F.col("hi_a"), F.col("hi_b")) == RADIUS)
        busy = busy.withColumn("b", shifted(F.col("hi_b")).bitwiseOR(F.col("lo"))).filter("a < b")
        pairs.append(busy.select("a", "b").join(whole, "b").select("a", "b"))
        left = left.join(hot_lo, "lo", "left_anti")
    far = left.join(right, "lo").filter(distance(F.col("hi_a"), F.col("hi_b")) == RADIUS).filter("a < b")
    pairs.append(far.select("a", "b"))
    found = pairs[0]
    for more in pairs[1:]:
        found = found.unionByName(more)
    ordered = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered


def simhash_groups(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of `docs` (doc_id long, text).

    Only A to Z are lower-cased. Texts of fewer words than a shingle hash the whole sequence; null, empty and blank
    texts have fingerprint zero and are linked like others. Equal fingerprints are one class, whose copies meet only in
    aggregations. The component is the smallest doc_id that links can reach; rows with a null doc_id get the
    component of their fingerprint, null if nothing reachable has an id. Repeated rows stay repeated. Other
    columns are ignored.
    """
    rows = store(fingerprints(docs, shingle), "simhash")
    classes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    links = store(hamming_links(classes))
    roots = store(components(links))
    placed = classes.join(roots, classes.fp == roots.node, "left")
    placed = store(placed.select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    joined = rows.join(placed.join(least, "root").select("fp", "component_id"), "fp")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return joined.select("doc_id", text.alias("fingerprint"), "component_id")
