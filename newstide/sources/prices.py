"""Price series from JSON and CSV."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from newstide.functions.numbers import double_or_zero, long_or_zero, plain_numbers
from newstide.schemas import RAW_TICKS
from newstide.sources.corrupt import good_rows, with_corrupt
from newstide.sources.json_arrays import split_json_rows
from newstide.sources.optional import or_none

SERIES = ["timestamp", "open", "close", "volume", "high", "low"]
_KINDS = {s: "bigint" if s in ("timestamp", "volume") else "double" for s in SERIES}


@dataclass(frozen=True)
class PriceLayout:
    """Where symbol, time stamps and quotes sit; ``results`` and ``quotes`` are arrays."""

    results: str = "chart.result"
    symbol: str = "meta.symbol"
    timestamps: str = "timestamp"
    quotes: str = "indicators.quote"


_NUMBERS = T.ArrayType(T.StringType())  # text first, so that odd values become 0, not errors


def _nested(path: str, leaf: T.DataType) -> T.DataType:
    for name in reversed(path.split(".")):
        leaf = T.StructType([T.StructField(name, leaf)])
    return leaf


def _merge(left: T.DataType, right: T.DataType) -> T.DataType:
    if not (isinstance(left, T.StructType) and isinstance(right, T.StructType)):
        return right
    fields = {f.name: f.dataType for f in left.fields}
    for field in right.fields:
        known = fields.get(field.name)
        fields[field.name] = _merge(known, field.dataType) if known else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def price_schema(layout: PriceLayout = PriceLayout()) -> T.StructType:
    quote = T.StructType([T.StructField(s, _NUMBERS) for s in SERIES[1:]])
    result = _merge(
        _merge(
            _nested(layout.symbol, T.StringType()), _nested(layout.timestamps, _NUMBERS)
        ),
        _nested(layout.quotes, T.ArrayType(quote)),
    )
    return _nested(layout.results, T.ArrayType(result))


def ticks_from_json_rows(rows: DataFrame, layout: PriceLayout = PriceLayout()) -> DataFrame:
    """One tick per time stamp from rows of :func:`price_schema`.

    Values that are missing or no numbers become 0. A series without ``low`` is
    incomplete and yields nothing, nor do values beyond the last time stamp.
    """
    result = rows.select(F.explode(F.col(layout.results)).alias("r"))
    quote = F.try_element_at(F.col(f"r.{layout.quotes}"), F.lit(1))
    parts = result.select(
        F.col(f"r.{layout.symbol}").alias("stockname"),
        F.col(f"r.{layout.timestamps}").alias("timestamp"),
        *[quote[s].alias(s) for s in SERIES[1:]],
    ).filter(F.col("low").isNotNull() & (F.size("timestamp") > 0))
    # A series that is absent altogether must not turn the zipped array into NULL.
    empty = F.array().cast(_NUMBERS)
    zipped = F.arrays_zip(*[F.coalesce(F.col(s), empty).alias(s) for s in SERIES])
    # A pattern per value takes longer than parsing it, so each series is tested as a whole.
    plain = [plain_numbers(F.col(s), _KINDS[s]).alias(f"_plain_{s}") for s in SERIES]
    ticks = parts.select("stockname", *plain, zipped.alias("_zipped"), F.size("timestamp").alias("_n"))
    # There is a tick at least; the outer form spares the optimizer's size test, which would zip twice.
    counted = F.slice("_zipped", F.lit(1), F.col("_n"))
    ticks = ticks.select("stockname", *[f"_plain_{s}" for s in SERIES], F.inline_outer(counted))
    read = {"bigint": long_or_zero, "double": double_or_zero}
    value = {s: read[_KINDS[s]](F.col(s), F.col(f"_plain_{s}")).alias(s) for s in SERIES}
    return ticks.select(
        value["timestamp"],
        F.coalesce("stockname", F.lit("")).alias("stockname"),
        *[value[s] for s in SERIES[1:]],
    )


def read_prices_json(
    spark: SparkSession,
    path: str | list[str],
    layout: PriceLayout = PriceLayout(),
    multi_line: bool = True,
) -> DataFrame:
    """Ticks of JSON price documents: one per file, or one per line if not ``multi_line``.

    Documents that cannot be parsed give no ticks; ``corrupt_records`` with
    :func:`price_schema` gives them.
    """
    schema = price_schema(layout)
    rows = with_corrupt(spark, path, schema, multi_line)
    return ticks_from_json_rows(good_rows(rows, schema), layout)


def read_prices_array(
    spark: SparkSession, path: str | list[str], layout: PriceLayout = PriceLayout()
) -> DataFrame:
    """:func:`read_prices_json` for large files, each an array of price documents or one of
    them, read by many tasks."""
    schema = price_schema(layout)
    return ticks_from_json_rows(good_rows(split_json_rows(spark, path, schema), schema), layout)


def read_prices_csv(spark: SparkSession, path: str | list[str]) -> DataFrame | None:
    """Headerless CSV of ticks, or None when the path does not exist."""
    return or_none(lambda: spark.read.schema(RAW_TICKS).csv(path, header=False))
