"""First, last and relative change over price arrays kept in one row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _pairs(prices: Column, stamps: Column) -> Column:
    return F.zip_with(prices, stamps, lambda p, t: F.struct(p.alias("price"), t.alias("ts")))


def _tail(values: Column) -> Column:
    # The search for the last value never looks at the first element.
    return F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0)))


def _several(*arrays: Column) -> Column:
    tests = [F.size(a) > 1 for a in arrays]
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def first_value(prices: Column) -> Column:
    """First price that is not 0; 0 for fewer than two prices or none such."""
    found = F.try_element_at(F.filter(prices, lambda p: p != 0), F.lit(1))
    return F.when(
        prices.isNotNull(), F.when(_several(prices), F.coalesce(found, F.lit(0.0))).otherwise(0.0)
    )


def last_value(prices: Column) -> Column:
    """Last price after the first element that is not 0; 0 when there is none."""
    found = F.try_element_at(F.filter(_tail(prices), lambda p: p != 0), F.lit(-1))
    return F.when(
        prices.isNotNull(), F.when(_several(prices), F.coalesce(found, F.lit(0.0))).otherwise(0.0)
    )


def first_date(prices: Column, stamps: Column) -> Column:
    """Stamp of the first price that is not 0, else the first stamp."""
    hit = F.try_element_at(F.filter(_pairs(prices, stamps), lambda x: x["price"] != 0), F.lit(1))
    return F.when(
        _several(prices, stamps), F.coalesce(hit["ts"], F.try_element_at(stamps, F.lit(1)))
    )


def last_date(prices: Column, stamps: Column) -> Column:
    """Stamp of the last price after the first that is not 0, else the last stamp."""
    hit = F.try_element_at(
        F.filter(_tail(_pairs(prices, stamps)), lambda x: x["price"] != 0), F.lit(-1)
    )
    return F.when(
        _several(prices, stamps), F.coalesce(hit["ts"], F.try_element_at(stamps, F.lit(-1)))
    )


def price_change(prices: Column) -> Column:
    """Relative change from the first to the last price that is not 0.

    0 for fewer than two prices or when both ends are 0. The end falls back to the
    last element, so ``[5, 0, 0]`` gives -1.
    """
    nonzero = F.filter(prices, lambda p: p != 0)
    start = F.coalesce(F.try_element_at(nonzero, F.lit(1)), F.try_element_at(prices, F.lit(1)))
    end = F.coalesce(
        F.try_element_at(F.filter(_tail(prices), lambda p: p != 0), F.lit(-1)),
        F.try_element_at(prices, F.lit(-1)),
    )
    change = F.when((start == 0) & (end == 0), 0.0).otherwise(F.try_divide(end - start, start))
    return F.when(prices.isNotNull(), F.when(_several(prices), change).otherwise(0.0))
