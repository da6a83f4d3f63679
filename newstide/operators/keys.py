"""Row digests, and one row per key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from newstide.workspace import stage


def _spelled(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        value = value.cast("double") + F.lit(0.0)  # -0.0 and 0.0 are the same value
    value = value.cast("string")
    # The length in front keeps ('ab', 'c') and ('a', 'bc') apart; NULL has no length.
    return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of the given columns, NULL-safe.

    Joining or grouping on the 32 bytes stands in for comparing whole articles, so
    the text of stored rows is never shuffled.
    """
    digest = F.unhex(F.sha2(F.concat(*[_spelled(df, c) for c in columns]), 256))
    # Never NULL, which the optimizer cannot know by itself: it would hash twice to test it.
    return F.coalesce(digest, F.lit(b""))


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The smallest row of every key, comparing the other columns left to right.

    An aggregate rather than a window: copies collapse before the shuffle, so a key
    holding a third of the rows is no burden to one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    smallest = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return smallest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


_DIGEST = "_digest"


def digests(df: DataFrame, columns: list[str]) -> DataFrame:
    """The digest of every row, as one column."""
    return df.select(row_digest(df, columns).alias(_DIGEST))


@dataclass(frozen=True)
class FilterLimits:
    """Bits per arriving digest, and bytes the bits may take; more digests share them."""

    bits_per_row: int = 32
    most_bytes: int = 64 << 20


_BLOCK = 1 << 15  # bits per row of the filter
_PROBES = 2


def _probe(digest: Column, which: int, bits: int) -> tuple[Column, Column]:
    """(row of the filter, bit in it) of four bytes of the digest."""
    number = F.conv(F.hex(F.substring(digest, 1 + 4 * which, 4)), 16, 10).cast("long")
    place = F.pmod(number, F.lit(bits))
    return F.floor(place / _BLOCK).cast("int"), place % _BLOCK


def possibly_among(known: DataFrame, arriving: DataFrame, limits: FilterLimits = FilterLimits()) -> DataFrame:
    """Rows of ``known`` whose digest may be among the ``arriving`` ones.

    A Bloom filter of the arriving digests, made by partial bitmaps, is broadcast to where the
    known ones are read; of the others 1 in 250 passes. Its size follows the batch up to
    ``most_bytes``; beyond that it lets more pass and is still right.
    """
    arriving = stage(arriving.select(_DIGEST).distinct(), "arriving-digests")
    bits = _BLOCK
    while bits < limits.bits_per_row * arriving.count() and bits < 8 * limits.most_bytes:
        bits *= 2
    places = [F.struct(*[c.alias(n) for c, n in zip(_probe(F.col(_DIGEST), i, bits), ("row", "bit"))]) for i in range(_PROBES)]
    rows = arriving.select(F.inline(F.array(*places))).groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits"))
    rows = stage(rows, "digest-filter")
    for i in range(_PROBES):
        row, bit = _probe(F.col(_DIGEST), i, bits)
        probed = known.join(F.broadcast(rows), row == F.col("row"))
        byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        known = probed.filter(F.getbit(byte, (bit % 8).cast("int")) == 1).drop("row", "bits")
    return known


def rows_not_among(batch: DataFrame, known: DataFrame, columns: list[str], prefilter: bool = False) -> DataFrame:
    """Rows of ``batch`` whose digest of ``columns`` is not ``known``, one per digest.

    Copies within the batch collapse before the shuffle; the batch then moves once,
    and the join finds it already partitioned by digest. With ``prefilter``, for a long
    history, of the known digests only those that may be in the batch are moved.
    """
    digested = batch.withColumn(_DIGEST, row_digest(batch, columns))
    if prefilter:
        known = possibly_among(known, digested)
    return one_per_key(digested, [_DIGEST]).join(known, _DIGEST, "left_anti").select(*batch.columns)


def new_rows(batch: DataFrame, stored: DataFrame, columns: list[str], prefilter: bool = False) -> DataFrame:
    """Rows of ``batch`` whose ``columns`` occur in no stored row, one per value.

    NULL equals NULL. With all columns this is ``EXCEPT DISTINCT``.
    """
    return rows_not_among(batch, digests(stored, columns), columns, prefilter)


def new_articles(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct articles of the batch that are not stored yet, comparing every column."""
    return new_rows(batch, stored, batch.columns, prefilter=True)
