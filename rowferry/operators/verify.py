"""Verification of a move: whole-set checks and a comparison row by row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from rowferry.names import column_names
from rowferry.operators.keyed import unique_by_key
from rowferry.session import is_small, settled

# ranges of keys on each of two levels of a comparison
RANGES = 4096


def digests(schema: StructType, names: Sequence[str] | None = None) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row's columns. Nulls count, as the hash function itself would skip them."""
    values, nulls = [], []
    for field in schema.fields:
        if names is None or field.name in names:
            column = F.col(f"`{field.name}`")
            nulls.append(column.isNull())
            if isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
                # with the nulls inside
                column = F.to_json(F.struct(column), {"ignoreNullFields": "false"})
            values.append(column)
    return F.xxhash64(*values, *nulls), F.xxhash64(F.lit("second"), *nulls, *values)


def digest_sums(schema: StructType) -> list[Column]:
    """Aggregates that are equal for two frames of this schema with the same rows, each as often, in any order."""
    first, second = digests(schema)
    total = lambda h: F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string")
    return [F.count(F.lit(1)).alias("rows"), total(first).alias("first"), total(second).alias("second")]


def verify(source: DataFrame, destination: DataFrame, mode: str = "union") -> DataFrame:
    """One row with the counts of both sides and `status`, `succeeded` or `failed`.

    union     both counts equal the count of the distinct union; any repeated row fails
    multiset  both sides hold every row equally often; `difference` tells how many copies have no counterpart
    sums      the same decision from sums of row digests: one scan a side and no exchange of rows, without
              `union_count` and `difference`

    Rows are told apart by two 64-bit digests. Union and multiset exchange those alone, added up in each task first.
    """
    if mode not in ("union", "multiset", "sums"):
        raise ValueError(f"unknown verification mode {mode!r}; use union, multiset or sums")
    tagged = source.select("*", F.lit(1).alias("__s"), F.lit(0).alias("__d")).unionByName(
        destination.select("*", F.lit(0).alias("__s"), F.lit(1).alias("__d"))
    )
    given = [f"`{c}`" for c in source.columns]
    first, second = digests(tagged.select(*given).schema)
    rows = tagged.select("__s", "__d", first.alias("__a"), second.alias("__b"))
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counts = [whole("__s").alias("source_count"), whole("__d").alias("destination_count")]
    if mode == "sums":
        apart = [
            whole(F.when(F.col("__s") == 1, F.col(h)).otherwise(-F.col(h).cast("decimal(38,0)"))).alias(h)
            for h in ("__a", "__b")
        ]
        sums = rows.agg(*counts, *apart)
        good = (F.col("source_count") == F.col("destination_count")) & (F.col("__a") == 0) & (F.col("__b") == 0)
        return sums.select("source_count", "destination_count", F.when(good, "succeeded").otherwise("failed").alias("status"))
    copies = rows.groupBy("__a", "__b").agg(F.sum("__s").alias("__s"), F.sum("__d").alias("__d"))
    difference = whole(F.abs(F.col("__s") - F.col("__d"))).alias("difference")
    counted = copies.agg(*counts, F.count(F.lit(1)).alias("union_count"), difference)
    if mode == "union":
        good = (F.col("source_count") == F.col("destination_count")) & (
            F.col("destination_count") == F.col("union_count")
        )
    else:
        good = F.col("difference") == 0
    return counted.withColumn("status", F.when(good, "succeeded").otherwise("failed"))


def _differs(column: str) -> Column:
    stored = F.col(f"__d.`{column}`").cast("string")
    given = F.col(f"__s.`{column}`")
    return given.isNotNull() & ~given.cast("string").eqNullSafe(stored)


def _finding(kind: str, column: str | None, source: Column, destination: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("finding"),
        F.lit(column).cast("string").alias("column"),
        source.cast("string").alias("source_value"),
        destination.cast("string").alias("destination_value"),
    )


def compare_by_key(source: DataFrame, destination: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Differences by key: a row without counterpart, or a column whose text differs.

    Source columns that are null, or that the destination does not have, are not compared. A key that is null or
    occurs twice on one side fails the comparison. Large sides are compared by digests of key ranges first, in two
    levels, and only rows in ranges that differ are joined; that takes aggregations when this function is called.
    """
    keys = column_names(keys)
    compared = [c for c in source.columns if c not in keys and c in destination.columns]
    if not (is_small(source) and is_small(destination)):
        source, destination = _differing(source, destination, keys, compared)
    source, destination = unique_by_key(source, keys), unique_by_key(destination, keys)
    left = source.select(*keys, F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("__s"))
    right = destination.select(*keys, F.struct(*[F.col(f"`{c}`") for c in destination.columns]).alias("__d"))

    findings = [
        F.when(_differs(c), _finding("different", c, F.col(f"__s.`{c}`"), F.col(f"__d.`{c}`"))) for c in compared
    ]
    nothing = F.lit(None).cast("string")
    found = (
        F.when(F.col("__d").isNull(), F.array(_finding("missing in destination", None, nothing, nothing)))
        .when(F.col("__s").isNull(), F.array(_finding("missing in source", None, nothing, nothing)))
        .otherwise(F.filter(F.array(*findings), lambda x: x.isNotNull()) if findings else F.lit(None))
    )
    joined = left.join(right, keys, "full_outer")
    return joined.select(*keys, F.explode(found).alias("__f")).select(*keys, "__f.*")


def _differing(
    source: DataFrame, destination: DataFrame, keys: list[str], compared: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Both sides without the key ranges whose rows have the same digests on both.

    A key falls into one of RANGES ranges by its hash, and into one of as many finer ones within it. All digests of keys
    are looked through for a repeated or null key, which fails the comparison wherever it is.
    """
    # keys in the type that a join compares them in, other columns as text
    kinds = source.select(*keys).union(destination.select(*keys)).schema
    typed = [F.col(f"`{k}`").cast(f.dataType) for k, f in zip(keys, kinds, strict=True)]
    mark = F.xxhash64(*typed)
    coarse = mark.bitwiseAND(F.lit(RANGES - 1)).alias("__coarse")
    fine = F.shiftright(mark, RANGES.bit_length() - 1).bitwiseAND(F.lit(RANGES - 1)).alias("__fine")

    def digested(df: DataFrame, sign: int) -> DataFrame:
        row = [k.alias(f"k{i}") for i, k in enumerate(typed)]
        row += [F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(compared)]
        rows = df.select(coarse, fine, *row)
        key = digests(rows.schema, [f"k{i}" for i in range(len(keys))])
        first, second = (h.cast("decimal(38,0)") * sign for h in digests(rows.schema, rows.columns[2:]))
        null = F.greatest(*[F.col(f"k{i}").isNull() for i in range(len(keys))], F.lit(False))
        columns = [key[0].alias("x"), key[1].alias("y"), null.alias("null"), first.alias("a"), second.alias("b")]
        return rows.select("__coarse", "__fine", *columns, F.lit(sign).alias("n"))

    def broken(rows: DataFrame) -> bool:
        held = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("m"), F.max("null").alias("null"))
        return not held.filter("m > 1 OR null").isEmpty()

    def apart(rows: DataFrame, *by: str) -> DataFrame:
        sums = rows.groupBy(*by).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("n").alias("n"))
        return sums.filter("a != 0 OR b != 0 OR n != 0").select(*by)

    given, held = digested(source, 1), digested(destination, -1)
    if broken(given) or broken(held):
        # the join finds the key and names it
        return source, destination
    both = given.unionByName(held)
    ranges = [r["__coarse"] for r in apart(both, "__coarse").collect()]
    finer = settled(apart(both.filter(F.col("__coarse").isin(ranges)), "__coarse", "__fine"))

    def within(df: DataFrame) -> DataFrame:
        placed = df.select("*", coarse, fine).filter(F.col("__coarse").isin(ranges))
        return placed.join(finer, ["__coarse", "__fine"], "left_semi").select(*[f"`{c}`" for c in df.columns])

    return within(source), within(destination)
