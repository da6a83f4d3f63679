"""JSON records that cannot be parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CORRUPT = "_corrupt_record"


def with_corrupt(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool
) -> DataFrame:
    """Rows of ``schema``, with the text of those that are no JSON object beside them."""
    wider = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(wider).option("multiLine", multi_line)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def _reads(schema: T.StructType) -> Column:
    """True; names a column, as Spark does not parse for the corrupt record alone, and looks at
    nothing in it: spelling it out takes longer than parsing it."""
    return F.abs(F.col(schema[0].name).isNull().cast("int")) >= 0


def good_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.filter(F.col(CORRUPT).isNull() & _reads(schema)).drop(CORRUPT)


def corrupt_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """(file, record): what a JSON source holds besides rows of ``schema``, to be counted or
    looked at. Of a file read whole, ``multi_line``, the record is the whole file."""
    rows = with_corrupt(spark, path, schema, multi_line)
    bad = rows.select("*", F.col("_metadata.file_path").alias("file"))
    bad = bad.filter(F.col(CORRUPT).isNotNull() & _reads(schema))
    return bad.select("file", F.col(CORRUPT).alias("record"))
