"""Expressions and small helpers that several operators of this folder use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; one that comes as fewer splits than there are cores is dealt out."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def with_outputs(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns; an input column of the same name, in any case, gives way."""
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


def private(name: str) -> str:
    """A column name that no input has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def row_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller pieces, so that long texts are not held many at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, after limiting the session's Arrow batches to 4 MB.

    By default a batch is 10,000 rows or 64 MB, of which JVM and Python each hold a copy or
    two per running task; whole texts fill that.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return df
