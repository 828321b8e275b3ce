"""Writes by key into a stored set of rows: index, create, update, upsert, document replace and merge, delete.

Every function returns the new content as a lazy frame. Changes small enough for Catalyst to broadcast leave the
target unshuffled; beyond that limit target and changes are joined by one full outer join. Checks sit in the plan
as filters that raise, so a broken rule fails the write before anything is committed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rowferry.names import column_names
from rowferry.operators.changes import compact_changes
from rowferry.operators.datasets import (
    file_name,
    files_of,
    partition_columns,
    read_partitioned,
    refuse_other_layout,
    refuse_stream_output,
    rewrite_dataset,
    setting,
    with_file,
    write_dataset,
)
from rowferry.operators.delta import LISTABLE, rows_in_scope
from rowferry.operators.swap import recover, replace_files, writing
from rowferry.session import Files, discard, is_small, settled

MODES = ("index", "create", "update", "upsert")
# formats that keep column types, so that a stored row can be merged with a new one
TYPED_FORMATS = ("parquet", "orc", "json", "avro")

# size of a scan from which Spark filters it by a Bloom filter of the other side's keys
BLOOM_SCAN = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"

_IN_TARGET, _IN_CHANGES = "__in_target", "__in_changes"


def guard(df: DataFrame, rule: Column, message: Column) -> DataFrame:
    """The frame unchanged, or a failing job as soon as one row breaks the rule."""
    return df.where(F.when(rule, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def _key_text(keys: list[str]) -> Column:
    return F.concat_ws(", ", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("null")) for k in keys])


def unique_by_key(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The frame, failing on a null key or a key that occurs twice; hash-partitioned by the keys."""
    keys = column_names(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.first(F.struct(*[F.col(f"`{c}`") for c in rest])) if rest else F.lit(None)
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), row.alias("__row"))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()
    rows = guard(rows, known & (F.col("__n") == 1), F.concat(F.lit("null or repeated key: "), _key_text(keys)))
    # the grouping keys themselves, so that joins by them need no other shuffle
    return rows.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`") for c in df.columns])


def keyed_write(
    target: DataFrame,
    changes: DataFrame,
    keys: str | Sequence[str],
    mode: str = "index",
    ignore_nulls: bool = True,
) -> DataFrame:
    """The target after the changes.

    index   a change replaces the whole row of its key, or is inserted
    create  every change is inserted; a key that exists already fails the write
    update  every change is merged field by field; a key that does not exist fails the write
    upsert  a change is merged field by field, or inserted

    In a merge a null leaves the stored value unless `ignore_nulls` is off. A key that changes name must be unique in
    the target too. The result has the target's columns in their order and types, then what the changes add; a
    value that the target's type cannot hold fails the write.
    """
    if mode not in MODES:
        raise ValueError(f"unknown keyed mode {mode!r}; use one of {', '.join(MODES)}")
    keys = column_names(keys)
    small = is_small(changes)
    changes = unique_by_key(fitted(changes, target), keys)
    if mode == "index":
        result = _replace(target, changes, keys, small)
    elif small:
        result = _merge_small(target, changes, keys, mode, ignore_nulls)
    else:
        result = _merge_large(target, changes, keys, mode, ignore_nulls)
    added = [c for c in changes.columns if c not in target.columns]
    return result.select(*[F.col(f"`{c}`") for c in [*target.columns, *added]])


def fitted(changes: DataFrame, target: DataFrame) -> DataFrame:
    """The changes in the target's column types; a value that a cast would lose or alter fails the write."""
    columns = []
    for name, given in [(f.name, f.dataType) for f in changes.schema]:
        value = F.col(f"`{name}`")
        if name in target.columns and target.schema[name].dataType != given:
            wanted = target.schema[name].dataType
            cast = value.try_cast(wanted)
            # text may write a number in several ways, so there it is enough that it can be read
            kept = cast.isNotNull() if isinstance(given, StringType) else cast.try_cast(given).eqNullSafe(value)
            message = F.concat(F.lit(f"{name} cannot hold the value "), value.cast("string"))
            value = F.when(value.isNull() | kept, cast).otherwise(F.raise_error(message).cast(wanted)).alias(name)
        columns.append(value)
    return changes.select(*columns)


def _sized(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _replace(target: DataFrame, changes: DataFrame, keys: list[str], small: bool) -> DataFrame:
    kept = target.join(_sized(changes.select(*keys), small), keys, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def _merge_small(
    target: DataFrame, changes: DataFrame, keys: list[str], mode: str, ignore_nulls: bool
) -> DataFrame:
    # at most one row per change, so as small as the changes themselves
    known = F.broadcast(_known(target, F.broadcast(changes.select(*keys)), keys))
    checked = _check(changes.join(known, keys, "left"), keys, mode)
    if mode == "create":
        # no filter on the flag here: it would spare the rows that the check is for
        return target.unionByName(checked.drop(_IN_TARGET), allowMissingColumns=True)
    # for an update none, but without this branch a mere count would spare the check
    fresh = checked.where(F.col(_IN_TARGET).isNull()).drop(_IN_TARGET)
    flagged = checked.drop(_IN_TARGET).withColumn(_IN_CHANGES, F.lit(True))
    joined = target.alias("t").join(F.broadcast(flagged).alias("c"), keys, "left")
    merged = joined.select(*_merged_columns(target, changes, keys, ignore_nulls))
    return merged.unionByName(fresh, allowMissingColumns=True)


def _merge_large(
    target: DataFrame, changes: DataFrame, keys: list[str], mode: str, ignore_nulls: bool
) -> DataFrame:
    left = _unique_target(target, keys).withColumn(_IN_TARGET, F.lit(True)).alias("t")
    right = changes.withColumn(_IN_CHANGES, F.lit(True)).alias("c")
    joined = left.join(right, keys, "full_outer")
    touched = F.col(_IN_CHANGES).isNotNull()
    if mode != "upsert":
        known = F.col(_IN_TARGET).isNotNull()
        rule = known if mode == "update" else ~(known & touched)
        joined = guard(joined, ~touched | rule, _rule_message(keys, mode))
    return joined.select(*_merged_columns(target, changes, keys, ignore_nulls))


def _known(target: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """The changed keys that the target holds, once each."""
    found = target.select(*keys).join(changed, keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    found = guard(found, F.col("__n") == 1, F.concat(F.lit("repeated key in the target: "), _key_text(keys)))
    return found.select(*keys, F.lit(True).alias(_IN_TARGET))


def _unique_target(target: DataFrame, keys: list[str]) -> DataFrame:
    """The target, failing on a key that occurs twice; counted by a window over the shuffle that the join needs."""
    counted = target.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    known = F.lit(False)
    for k in keys:
        known = known | F.col(f"`{k}`").isNull()
    message = F.concat(F.lit("repeated key in the target: "), _key_text(keys))
    return guard(counted, known | (F.col("__n") == 1), message).drop("__n")


def _rule_message(keys: list[str], mode: str) -> Column:
    text = "key to update does not exist: " if mode == "update" else "key to create exists already: "
    return F.concat(F.lit(text), _key_text(keys))


def _check(flagged: DataFrame, keys: list[str], mode: str) -> DataFrame:
    if mode == "upsert":
        return flagged
    known = F.col(_IN_TARGET).isNotNull()
    return guard(flagged, known if mode == "update" else ~known, _rule_message(keys, mode))


def _merged_columns(target: DataFrame, changes: DataFrame, keys: list[str], ignore_nulls: bool) -> list[Column]:
    columns = [F.col(f"`{k}`") for k in keys]
    for name in [c for c in target.columns if c not in keys]:
        stored = F.col(f"t.`{name}`")
        if name in changes.columns:
            new = F.col(f"c.`{name}`")
            stored = F.coalesce(new, stored) if ignore_nulls else F.when(F.col(_IN_CHANGES), new).otherwise(stored)
        columns.append(stored.alias(name))
    columns += [F.col(f"c.`{c}`") for c in changes.columns if c not in target.columns]
    return columns


def delete_rows(target: DataFrame, selection: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The target without the rows whose key occurs in the selection."""
    keys = column_names(keys)
    small = is_small(selection)
    return target.join(_sized(selection.select(*keys).distinct(), small), keys, "left_anti")


def write_documents(
    target: DataFrame, documents: DataFrame, key: str = "_id", replacedocuments: bool = True
) -> DataFrame:
    """Document sets: replace whole documents by id, or merge the given fields into them."""
    return keyed_write(target, documents, key, "index" if replacedocuments else "upsert")


def touched_files(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> list[str]:
    """The files (`__file` of the target's rows) that hold a key of the changes.

    Only the key columns are scanned. The range of the first key reaches the scan, so that files and row groups outside
    it are not read, and lets Spark build a Bloom filter of the changed keys where the join is shuffled.
    """
    spark, first = target.sparkSession, keys[0]
    changed = fitted(changes.select(*[F.col(f"`{k}`") for k in keys]), target)
    held = target.select(*[F.col(f"`{k}`") for k in keys], "__file")
    if isinstance(target.schema[first].dataType, LISTABLE):
        low, high = changed.agg(F.min(f"`{first}`"), F.max(f"`{first}`")).first()
        if low is None:
            return []
        kind = target.schema[first].dataType
        inside = F.col(f"`{first}`").between(F.lit(low).cast(kind), F.lit(high).cast(kind))
        held, changed = held.where(inside), changed.where(inside)
    with setting(spark, BLOOM_SCAN, "0"):
        found = held.join(changed, list(keys), "left_semi").select("__file").distinct()
        return [row["__file"] for row in found.toLocalIterator()]


def _replace_rows(
    target: DataFrame,
    path: str,
    fileformat: str,
    touched: Sequence[str] | None,
    content: Callable[[DataFrame], DataFrame],
    layout: Sequence[str],
    options: Mapping[str, str] | None = None,
) -> None:
    """Rewrite the touched files (None: all) with what `content` makes of their rows; the other files stay as they are."""
    spark = target.sparkSession
    if touched is None:
        rewrite_dataset(content(target), path, fileformat, layout, options)
        return
    rows = content(files_of(target, touched))
    names = [file_name(spark, path, uri) for uri in touched]
    replace_files(spark, path, lambda staged: write_dataset(rows, staged, fileformat, layout, options), lambda _: names)


def write_keyed_files(
    changes: DataFrame,
    path: str,
    fileformat: str,
    keys: str | Sequence[str],
    mode: str,
    partition_by: str | Sequence[str] = (),
) -> None:
    """Apply a keyed write to a file dataset by rewriting the files that hold a changed key, and no others.

    The changes are computed once, into the scratch folder. A dataset partitioned by `partition_by` looks for a key
    within the partition of its change, as if the partition columns were part of the key. Without `partition_by` the
    dataset keeps the layout it has. Changes that bring a new column rewrite all files, so that every file has it. The new
    files are complete before they take the old ones' place, and a lost run is finished or undone by the next one.
    """
    if fileformat not in TYPED_FORMATS:
        raise ValueError(f"keyed modes need one of {', '.join(TYPED_FORMATS)}, not {fileformat!r}")
    spark, layout = changes.sparkSession, column_names(partition_by)
    all_keys = [*layout, *(k for k in column_names(keys) if k not in layout)]
    with writing(spark, path):
        recover(spark, path)
        changes = settled(changes)
        n_files = len(Files(spark).walk(path))
        if not n_files:
            content = keyed_write(spark.createDataFrame([], changes.schema), changes, all_keys, mode)
            rewrite_dataset(content, path, fileformat, layout)
        else:
            refuse_stream_output(Files(spark), path)
            columns = partition_columns(spark, path)
            if layout:
                refuse_other_layout(spark, path, layout)
            target = read_partitioned(spark, path, fileformat)
            for name in layout:
                target = target.withColumn(name, F.col(name).cast(changes.schema[name].dataType))
            part = with_file(target)
            part = rows_in_scope(part, changes, layout) if layout else part
            whole = n_files == 1 or any(c not in target.columns for c in changes.columns)
            touched = None if whole else touched_files(part, changes, all_keys)
            _replace_rows(target, path, fileformat, touched, lambda rows: keyed_write(rows, changes, all_keys, mode), columns)
        discard(changes)


def delete_keyed_files(
    selection: DataFrame,
    path: str,
    fileformat: str,
    keys: str | Sequence[str],
    options: Mapping[str, str] | None = None,
) -> None:
    """Delete the rows of a file dataset whose key occurs in the selection; only files that hold one are rewritten."""
    spark, keys = selection.sparkSession, column_names(keys)
    with writing(spark, path):
        recover(spark, path)
        refuse_stream_output(Files(spark), path)
        selection = settled(selection.select(*keys).distinct())
        target = read_partitioned(spark, path, fileformat, options)
        touched = touched_files(with_file(target), selection, keys)
        if touched:
            columns = partition_columns(spark, path)
            _replace_rows(target, path, fileformat, touched, lambda rows: delete_rows(rows, selection, keys), columns, options)
        discard(selection)


def compact_keyed_files(
    changes: DataFrame,
    path: str,
    fileformat: str,
    keys: str | Sequence[str],
    scope: str | Sequence[str],
    updated_at: str,
    deleted: str,
    drop_deletes: bool = False,
    tie_break: Sequence[str] = (),
) -> None:
    """Merge a change log into a file dataset, see `compact_changes`; files without a row in its scope stay as they are.

    `deleted` is a SQL condition on the log. The log's columns are brought to the dataset's types, and a value that does not
    fit fails the move. Where the scope are the partition columns, exactly the partitions that the log names are rewritten.
    Of rows that are equally new, `tie_break` decides: column names, the greatest value first.
    """
    spark, scope = changes.sparkSession, column_names(scope)
    with writing(spark, path):
        recover(spark, path)
        refuse_stream_output(Files(spark), path)
        changes = settled(changes.withColumn("__gone", F.expr(deleted).cast("boolean")))
        base = read_partitioned(spark, path, fileformat)
        log = fitted(changes, base)
        found = rows_in_scope(with_file(base), log, scope).select("__file").distinct()
        touched = [row["__file"] for row in found.toLocalIterator()]

        def content(rows: DataFrame) -> DataFrame:
            order = [F.desc(name) for name in tie_break]
            merged = compact_changes(rows, log, keys, scope, updated_at, F.col("__gone"), drop_deletes, order)
            return rows_in_scope(rows, log, scope, "left_anti").select(*rows.columns).unionByName(merged)

        _replace_rows(base, path, fileformat, touched, content, partition_columns(spark, path))
        discard(changes)
