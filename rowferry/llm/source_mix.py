"""Mixing sources to target weights by systematic sampling of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import store

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
SEED = 17
# documents that are numbered together in one task, about
RUN_ROWS = 50_000


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """The rows with `place`, their place from 0 in the given order, numbered without one global task."""
    placed = store(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sort
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    joined = placed.withColumn("part", part).join(offsets, "part")
    return joined.withColumn("place", F.col("offset") + inside).drop("part", "offset", "__id")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """source, source_size, target: the shares of `share` times all words by weight, each at most `most` times its source.

    The weights repeat over the sources in code point order, null last. What a full source leaves over is shared among
    the others by weight; only sums of the sources come to the driver, once per round.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = numbered(sizes, F.col("source").asc_nulls_last()).withColumn("weight", weight)
    table = store(table.withColumn("most", F.col("source_size") * float(most)))
    all_words = table.agg(F.sum("source_size")).first()[0] or 0
    wanted, level, full = share * all_words, 0.0, -1
    while True:
        # sums start empty, so the first round has no full source
        is_full = (F.lit(level) * F.col("weight") >= F.col("most")) & F.lit(full >= 0)
        row = table.agg(
            F.count_if(is_full).alias("full"),
            F.sum(F.when(is_full, F.col("most")).otherwise(0.0)).alias("given"),
            F.sum(F.when(~is_full, F.col("weight")).otherwise(0)).alias("weight"),
        ).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (wanted - row["given"]) / row["weight"]
    target = F.least(F.lit(level) * F.col("weight"), F.col("most"))
    return table.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Every row of `docs` with size, source_size, target, copies and taken, beside the columns named in `carry`.

    docs: doc_id, source, text. A source's documents, ordered by size class and then by a hash of the seed and doc_id,
    stand one after the other on a line, each as long as its expected copies, the target over the source's size. One
    offset per source, drawn from the seed, is added; a document is taken once per whole number that its stretch
    crosses. So copies are the expected number rounded up or down, at most two, and the order by size keeps the words
    taken near the target. Places on the line come from counts per class and hash range, so no task sees a whole
    source. Null and empty texts have size 0 and count as copies without words; the null source is a source; a
    null doc_id hashes like an empty one; repeated rows are documents of their own. Reruns agree. A carried column
    that clashes with an output column is replaced by it.
    """
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    rows = docs.select(*dict.fromkeys([*carry, "doc_id", "source", "text"])).withColumn("size", size)
    seeded = F.concat_ws("/", F.lit(str(seed)), F.col("doc_id").cast("string"))
    rows = rows.withColumn("__key", F.md5(seeded.cast("binary")))
    rows = rows.withColumn("__class", F.floor(F.sqrt("size")))
    # a source as a text that is never null
    rows = rows.withColumn("__source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    needed = ["doc_id", "source", "size", "__key", "__class", "__source"]
    if set(carry) <= set(needed):
        # without texts the rows are small, and words are counted once
        rows = store(rows.select(*needed, F.lit(0).alias("__text")), "mix")
    else:
        rows = rows.withColumn("__text", F.xxhash64("text"))
    thin = rows.select(*needed)
    by_class = thin.groupBy("__source", "source", "__class")
    by_class = store(by_class.agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    sizes = by_class.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = store(source_targets(sizes, weights, share))
    runs = max(1, -(-(by_class.agg(F.sum("n")).first()[0] or 0) // RUN_ROWS))
    run = F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("long") * runs / (1 << 32))
    counts = store(thin.groupBy("__source", "__class", run.alias("__run")).agg(F.count("*").alias("n")))
    up_to = Window.unboundedPreceding, -1
    in_class = Window.partitionBy("__source", "__class").orderBy("__run").rowsBetween(*up_to)
    in_source = Window.partitionBy("__source").orderBy("__class").rowsBetween(*up_to)
    nothing = F.lit(0).cast("long")
    before_run = F.coalesce(F.sum("n").over(in_class), nothing).alias("__a")
    before_class = F.coalesce(F.sum("n").over(in_source), nothing).alias("__b")
    run_starts = counts.select("__source", "__class", "__run", before_run)
    class_starts = by_class.select("__source", "__class", before_class)
    known = targets.withColumn("__source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source")
    starts = run_starts.join(class_starts, ["__source", "__class"]).join(known, "__source")
    starts = starts.withColumn("__start", F.col("__a") + F.col("__b")).drop("__a", "__b")
    joined = rows.drop("source_size", "target").withColumn("__run", run).join(starts, ["__source", "__class", "__run"])
    order = Window.partitionBy("__source", "__class", "__run").orderBy("__key", "size", "doc_id", "__text")
    place = F.col("__start") + F.row_number().over(order)
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("__source")).cast("binary"))
    offset = F.conv(F.substring(digest, 1, 5), 16, 10).cast("double") / (1 << 20)
    placed = joined.withColumns({"__place": place, "__rate": rate, "__offset": offset})
    crossed = F.floor(F.col("__offset") + F.col("__rate") * F.col("__place"))
    crossed = crossed - F.floor(F.col("__offset") + F.col("__rate") * (F.col("__place") - 1))
    out = dict.fromkeys([*carry, "size", "source_size", "target", "copies", "taken"])
    copies = crossed.cast("long")
    return placed.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).select(*out)
