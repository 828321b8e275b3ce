"""Documents: one JSON text per row for collections without a common schema, and parsed documents."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType, VariantType

# Fixed value: documents per staged group.
GROUP_SIZE = 20000


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """One unparsed document per line as `jsonfield`."""
    return spark.read.text(path).withColumnRenamed("value", "jsonfield")


def to_json_documents(df: DataFrame) -> DataFrame:
    """Any frame as one JSON text per row, whatever its columns."""
    return df.select(F.to_json(F.struct("*")).alias("jsonfield"))


def stage_documents(documents: DataFrame, path: str, group_size: int = GROUP_SIZE) -> DataFrame:
    """Stage JSON documents in `partition=N` groups of at most `group_size` per task and read them back.

    Each task numbers its own groups, so the numbering needs no shuffle and no driver cursor. Every call writes to a
    folder of its own below `path`, named by `stored_at` of the result, so that a second try does not add to the first.
    """
    path = f"{path.rstrip('/')}/staged-{uuid.uuid4().hex[:12]}"
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    grouped = documents.select(
        F.col("jsonfield"), (F.floor(row_in_task / group_size) + 1).cast("int").alias("partition")
    )
    grouped.write.partitionBy("partition").option("maxRecordsPerFile", group_size).json(path)
    staged = documents.sparkSession.read.schema("jsonfield string, partition int").json(path)
    staged.stored_at = path
    return staged


def parse_documents(
    documents: DataFrame, schema: str | None = None, jsonfield: str = "jsonfield", samplesize: int | None = None
) -> DataFrame:
    """Columns from a JSON text column.

    Without a DDL `schema` Spark infers one from all documents. `samplesize` is accepted and has no effect: a schema of
    some documents would lose the fields of others, see `parse_mixed_documents` for a way that keeps them. A text that is no JSON document fails the job.
    """
    if schema is None:
        schema = infer_document_schema(documents.select(F.col(jsonfield).cast("string")))
    parsed = F.from_json(F.col(jsonfield), schema, {"mode": "FAILFAST"})
    return documents.select(parsed.alias("doc")).select("doc.*")


def infer_document_schema(texts: DataFrame) -> StructType:
    """Common schema of the JSON texts in a one-column frame, found on the executors."""
    spark = texts.sparkSession
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(spark._jsparkSession.read().json(strings), spark).schema


RESCUED = "_rescued"


def variant_schema(documents: DataFrame, jsonfield: str = "jsonfield", samplesize: int | None = None) -> StructType | None:
    """The common schema of JSON documents, by one aggregation; fields whose types clash are variants.

    None where some document is no object. With `samplesize` so many documents are looked at.
    """
    rows = documents.select(F.col(jsonfield))
    if samplesize:
        rows = rows.limit(int(samplesize))
    found = rows.agg(F.schema_of_variant_agg(F.parse_json(F.col(jsonfield)))).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return None
    # names stand in backticks where they hold anything but letters, so these words are types
    quoted = re.split(r"(`(?:[^`]|``)*`)", found)
    text = "".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<").replace("VOID", "VARIANT") for p in quoted)
    return DataType.fromDDL(text)


def _type_text(kind: DataType) -> str:
    """A type as SQL writes it, with any field names."""
    if isinstance(kind, StructType):
        names = ["`" + f.name.replace("`", "``") + "`" for f in kind.fields]
        return f"struct<{', '.join(f'{n}: {_type_text(f.dataType)}' for n, f in zip(names, kind.fields, strict=True))}>"
    return f"array<{_type_text(kind.elementType)}>" if isinstance(kind, ArrayType) else kind.simpleString()


def parse_mixed_documents(
    documents: DataFrame, jsonfield: str = "jsonfield", samplesize: int | None = None
) -> DataFrame:
    """Columns from a JSON text column whose documents do not agree in types; no field and no value is lost.

    The schema is that of all documents, or of `samplesize` of them. A field whose types clash is a variant column. What
    a column does not hold as it is, such as a field that only later documents have, stands in `_rescued` by its name, null
    if there is nothing. Documents that are no objects give one variant column, `value`. A text that is no JSON fails the job.
    """
    schema = variant_schema(documents, jsonfield, samplesize)
    parsed = documents.select(F.parse_json(F.col(jsonfield)).alias("v"))
    if schema is None:
        return parsed.select(F.col("v").alias("value"), F.lit(None).cast("variant").alias(RESCUED))
    field = F.col("v").cast("map<string,variant>")

    def typed(value: Column, kind: DataType) -> Column:
        return value if isinstance(kind, VariantType) else F.try_variant_get(value, "$", _type_text(kind))

    def held(f: StructField, value: Column) -> Column:
        if isinstance(f.dataType, VariantType):
            return F.lit(True)
        same = F.to_json(F.struct(typed(value, f.dataType).alias("x"))) == F.to_json(F.struct(value.alias("x")))
        return F.is_variant_null(value) | F.coalesce(same, F.lit(False))

    fields = parsed.select("v", field.alias("fields"))
    columns = [typed(F.col("fields")[f.name], f.dataType).alias(f.name) for f in schema.fields]

    def lost(name: Column, value: Column) -> Column:
        kept = F.lit(False)
        for f in schema.fields:
            kept = kept | ((name == f.name) & held(f, value))
        return ~kept

    rest = F.map_filter("fields", lost)
    return fields.select(*columns, F.when(F.size(rest) > 0, F.to_variant_object(rest)).alias(RESCUED))
