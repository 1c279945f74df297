"""CSV scan that keeps going: rows that fit the declared table, and a table of those that don't with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from exportlens.sources.schemas import SCHEMAS

CORRUPT = "_corrupt_line"


def _reasons(field: StructField) -> Column:
    """What is wrong with the text of a field, or null: missing, not of its type, does not fit, too long."""
    text = F.col(field.name)
    checks = None

    def add(pred: Column, reason: str):
        nonlocal checks
        checks = (F if checks is None else checks).when(pred, F.lit(f"{field.name}: {reason}"))

    if not field.nullable:
        add(text.isNull(), "missing")
    if isinstance(field.dataType, StringType):
        if "max_length" in field.metadata:
            add(F.length(text) > field.metadata["max_length"], "too long")
    elif isinstance(field.dataType, DecimalType):
        # Read with room for any declared number and more digits than it may have.
        wide = text.try_cast("decimal(38,12)")
        fits = (F.abs(wide) < F.lit(10 ** (field.dataType.precision - field.dataType.scale)).cast("decimal(38,0)")) & (
            F.round(wide, field.dataType.scale) == wide)
        add(text.isNotNull() & wide.isNull(), f"not a {field.dataType.typeName()}")
        add(~fits, "does not fit")
    else:
        add(text.isNotNull() & text.try_cast(field.dataType).isNull(), f"not a {field.dataType.typeName()}")
    return checks if checks is not None else F.lit(None).cast("string")


def scan_with_rejects(
    spark: SparkSession, path: str, name: str, *, null_values: str | None = None, fields: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV with header, in one pass over the texts each.

    ``rows`` are those that fit the declared schema of table ``name``, typed. ``rejects`` has a row per bad
    line: ``line``, the line as it is in the file, and ``reasons``, one for each bad field. A line with
    fewer or more fields than the header is rejected with the reason "fields". ``fields`` names the columns in the file
    where these are not all of the table's, in the header's order. No line is lost: every one is in one of the two.
    """
    declared = SCHEMAS[name]
    columns = [declared[c] for c in (fields or declared.fieldNames())]
    texts = StructType([StructField(f.name, StringType()) for f in columns] + [StructField(CORRUPT, StringType())])
    reader = (
        spark.read.schema(texts).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if null_values is not None:
        reader = reader.option("nullValue", null_values)
    # Only good lines have no corrupt text; the file's line is written anew from the fields where it could be parsed.
    read = reader.csv(path)
    found = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("fields"))).otherwise(F.array_compact(F.array(*[_reasons(f) for f in columns])))
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *[F.coalesce(F.col(f.name), F.lit("")) for f in columns]))
    judged = read.select("*", found.alias("_reasons"), line.alias("_line"))
    rows = judged.where(F.size("_reasons") == 0).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name, metadata=f.metadata) for f in columns])
    rejects = judged.where(F.size("_reasons") > 0).select(F.col("_line").alias("line"), F.col("_reasons").alias("reasons"))
    return rows, rejects


def reject_report(rejects: DataFrame) -> DataFrame:
    """(reason, row_count): how many lines have each reason."""
    return rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))
