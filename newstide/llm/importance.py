"""Importance resampling of documents towards a target text collection, with bit-sliced sums.

Features are the word n-grams of a text, hashed into buckets. A bucket's gain is the log ratio
of its smoothed shares in the target and in the documents, a whole number; a document's weight
is the sum of gains over its features. The bucket counts of a document become bit planes, plane
j holding bit j of every count; the gains become planes of their positive and negative
magnitudes. AND of a count plane and a gain plane, its population count and a power of two give
one term of the exact weight, so no rounding enters. Weights plus Gumbel noise are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from newstide.llm.common import bounded_batches, private, row_batches, with_outputs
from newstide.workspace import stage

# A-Z are lower-cased; ASCII letters, digits and all bytes above 127 are words, the rest is space.
_PLAIN = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else 32 for b in bytes(range(256)).lower())


@dataclass(frozen=True)
class ImportanceLimits:
    """Buckets, longest n-gram, words a document needs to be drawn, percentage drawn, and the
    bytes of a text whose words are held at a time."""

    buckets: int = 10_000
    words: int = 3
    least_words: int = 20
    percent: int = 5
    scale: int = 1000
    seed: str = "42"
    piece: int = 1 << 20


def bucket_counts(data: bytes, limits: ImportanceLimits) -> tuple[int, np.ndarray]:
    """Number of words, and of features per bucket.

    The checksum of "a b" is that of " b" continued from that of "a", so an n-gram costs one
    call whatever its length.
    """
    plain, start, n_words = data.translate(_PLAIN), 0, 0
    counts = np.zeros(limits.buckets, np.int64)
    before: list[bytes] = []  # the last words of the previous piece
    while start < len(plain):
        stop = plain.find(b" ", start + limits.piece)
        stop = len(plain) if stop < 0 else stop
        fresh = plain[start:stop].split()
        words, known = before + fresh, len(before)
        spaced = [b" " + w for w in words]
        sums = list(map(crc32, words))
        found = sums[known:]
        for k in range(1, limits.words):
            sums = list(map(crc32, spaced[k:], sums))
            found += sums[max(0, known - k) :]
        counts += np.bincount(np.array(found, np.int64) % limits.buckets, minlength=limits.buckets)
        n_words += len(fresh)
        before = words[max(0, len(words) - limits.words + 1) :] if limits.words > 1 else []
        start = stop
    return n_words, counts


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Row k holds bit k of every value, 64 values to a word; values are not negative."""
    planes = int(values.max(initial=0)).bit_length()
    width = -(-len(values) // 64) * 8
    packed = np.zeros((planes, width), np.uint8)
    for k in range(planes):
        bits = np.packbits((values >> k & 1).astype(np.uint8))
        packed[k, : len(bits)] = bits
    return packed.view(np.uint64)


@dataclass(frozen=True)
class GainPlanes:
    """Bit planes of the positive gains and of the magnitudes of the negative ones."""

    above: np.ndarray
    below: np.ndarray

    @classmethod
    def of(cls, gains: list[int]) -> GainPlanes:
        values = np.array(gains, np.int64)
        return cls(bit_planes(np.maximum(values, 0)), bit_planes(np.maximum(-values, 0)))

    def weight(self, counts: np.ndarray) -> int:
        """Sum of count times gain over all buckets."""
        sliced = bit_planes(counts)

        def total(side: np.ndarray) -> int:
            hits = np.bitwise_count(sliced[:, None, :] & side[None, :, :]).sum(axis=2, dtype=np.int64)
            powers = np.arange(len(sliced))[:, None] + np.arange(len(side))[None, :]
            return int((hits << powers).sum())

        return total(self.above) - total(self.below)


def _texts(batch: pa.RecordBatch, at: int) -> list[bytes]:
    column = batch.column(at).cast(pa.string()).cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


def _tally(texts: DataFrame, text: str, name: str, limits: ImportanceLimits) -> DataFrame:
    """(bucket, name): features per bucket; a task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(limits.buckets, np.int64)
        for batch in row_batches(batches):
            for data in _texts(batch, 0):
                counts += bucket_counts(data, limits)[1]
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], ["bucket", name])

    return bounded_batches(texts).select(text).mapInArrow(run, f"bucket long, {name} long")


def bucket_gains(
    docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text",
    limits: ImportanceLimits = ImportanceLimits(),
) -> list[int]:
    """Gain of every bucket, from all texts of both tables. As many numbers as buckets reach
    the driver, whatever the tables hold."""
    source = _tally(docs, text, "s", limits).withColumn("t", F.lit(0).cast("long"))
    aim = _tally(target, target_text, "t", limits).withColumn("s", F.lit(0).cast("long"))
    both = source.unionByName(aim).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    s, t = [0] * limits.buckets, [0] * limits.buckets
    for row in both.collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"], row["t"]
    all_s, all_t = float(sum(s) + limits.buckets), float(sum(t) + limits.buckets)
    return [
        math.floor(limits.scale * math.log(float(b + 1) * all_s / (float(a + 1) * all_t))) for a, b in zip(s, t)
    ]


def _noise(key: Column, limits: ImportanceLimits) -> Column:
    """Gumbel noise from the key's digest, scaled like the gains; the same for each run."""
    digest = F.sha2(F.concat(F.lit(f"{limits.seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(limits.scale)) * F.log(-F.log(u)))


def importance_scores(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    limits: ImportanceLimits = ImportanceLimits(),
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features``, ``weight`` and ``score``; all long.

    NULL is the empty text, which has no features and weight 0. Every row is scored by itself,
    repeated ones too; rows of one key share their noise, a NULL key counts as an empty one.
    An empty table of documents gives no rows, an empty target gains against it alone. Input
    columns named like the new ones give way. Texts are read twice and never moved; memory
    holds the words of one piece of a text.
    """
    planes = GainPlanes.of(bucket_gains(docs, target, text, target_text, limits))
    held = private("text")
    outputs = ["n_words", "n_features", "weight"]
    clear = docs.drop(*[c for c in docs.columns if c.lower() in (*outputs, "score") and c not in (key, text)])
    wide = clear.withColumn(held, F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            rows = []
            for data in _texts(batch, batch.num_columns - 1):
                n_words, counts = bucket_counts(data, limits)
                rows.append((n_words, int(counts.sum()), planes.weight(counts)))
            new = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + new, batch.schema.names[:-1] + outputs)

    schema = clear.schema
    for name in outputs:
        schema = schema.add(name, "long")
    scored = bounded_batches(wide).mapInArrow(run, schema)
    return with_outputs(scored, score=F.col("weight") + _noise(F.col(key), limits))


def ranked(scored: DataFrame, key: str = "doc_id", limits: ImportanceLimits = ImportanceLimits()) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the rows drawn, highest score first, else NULL.

    Of the rows with enough words, the given percentage is drawn; ties go to the smaller key,
    NULL keys last, then to the smaller values of the other numbers. Rows are dealt out by
    ranges of that order; a row's rank is its place in its range plus the rows of the ranges
    before, so no task sees more than a range.
    """
    fit = F.col("n_words") >= limits.least_words
    order = [
        F.col("_fit").desc(), F.col("score").desc(), F.col(key).asc_nulls_last(), F.col("weight"), F.col("n_features"),
    ]
    kept = stage(scored.withColumn("_fit", fit), "scored")
    parts = max(1, int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = kept.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    dealt = stage(dealt, "score-ranges")
    per_part = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.count_if("_fit").alias("_fits"))
    starts, drawn, before = [], 0, 0
    for row in sorted(per_part.collect()):  # a row per range
        starts.append((row["_part"], before))
        before += row["_rows"]
        drawn += row["_fits"]
    drawn = limits.percent * drawn // 100
    offsets = scored.sparkSession.createDataFrame(starts, "_part int, _before long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    numbered = dealt.join(F.broadcast(offsets), "_part").withColumn("_place", place.cast("long"))
    rank = F.when(F.col("_fit") & (F.col("_place") <= drawn), F.col("_place"))
    return with_outputs(numbered, rank=rank).drop("_part", "_before", "_place", "_fit")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    limits: ImportanceLimits = ImportanceLimits(),
) -> DataFrame:
    """The documents drawn, whole rows with ``n_features``, ``weight``, ``score`` and ``rank``.

    Ranks are found on the numbers alone; then only rows as good as the last one drawn move
    with their texts and are ranked among themselves.
    """
    scored = importance_scores(docs, target, key, text, target_text, limits)
    narrow = ranked(scored.select(key, "n_words", "n_features", "weight", "score"), key, limits)
    last = narrow.agg(F.max("rank").alias("n"), F.min(F.when(F.col("rank").isNotNull(), F.col("score"))).alias("s")).first()
    if not last["n"]:
        return with_outputs(scored.limit(0), rank=F.lit(None).cast("long"))
    near = scored.filter((F.col("n_words") >= limits.least_words) & (F.col("score") >= last["s"]))
    every = ImportanceLimits(**{**limits.__dict__, "percent": 100})
    return ranked(near, key, every).filter(F.col("rank") <= last["n"])


def resample_digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    scored = importance_scores(docs.select("doc_id", "text"), target)
    return ranked(scored.select("doc_id", "n_words", "n_features", "weight", "score")).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )
