"""Numbers out of text, and small arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A failing cast raises and catches an exception per value, and the JVM takes a type
# suffix as in '1.0d' for part of a number; the patterns keep both away from the cast.
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|nan|inf|infinity)\s*$"


# Characters of which every text that the cast takes also fits the pattern, and the reverse.
_PLAIN = {"bigint": r"\A[0-9,+-]*+\z", "double": r"\A[0-9.,E+-]*+\z"}


def plain_numbers(texts: Column, kind: str) -> Column:
    """Whether an array of texts is made of characters that need no pattern before the cast to
    ``bigint`` or ``double``: one test of all of them instead of one for each."""
    return F.coalesce(F.array_join(texts, ",").rlike(_PLAIN[kind]), F.lit(False))


def long_or_zero(text: Column, plain: Column | None = None) -> Column:
    """Whole number in ``text``, else 0; ``'1.5'`` counts as no whole number.

    ``plain`` tells for which rows :func:`plain_numbers` holds."""
    text = text.cast("string")
    fits = text.rlike(_WHOLE) if plain is None else plain | text.rlike(_WHOLE)
    return F.coalesce(F.when(fits, text.try_cast("bigint")), F.lit(0).cast("bigint"))


def double_or_zero(text: Column, plain: Column | None = None) -> Column:
    """Decimal number in ``text``, else 0.0; ``'nan'`` parses as NaN. ``plain`` as above."""
    text = text.cast("string")
    fits = text.rlike(_DECIMAL) if plain is None else plain | text.rlike(_DECIMAL)
    return F.coalesce(F.when(fits, text.try_cast("double")), F.lit(0.0))


def relative_change(first: Column, last: Column) -> Column:
    """(last - first) / first as a fraction; NULL when ``first`` is 0."""
    return F.try_divide(last - first, first)
