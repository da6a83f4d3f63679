"""Files that hold one large JSON array of objects, read by many tasks.

Spark splits a text file at any one character, here the closing brace. Where an object ends
depends on what stands before: a brace may lie inside a string or inside another object. Both
are sums: quotes before a place modulo two, and brackets opened less brackets closed outside
strings. A first pass adds them up per block of the file, for either state the block may start
in; sums over the few blocks tell how each starts; a second pass finds the objects that end in
a block. Both read a block's text in order in the task that reads it, in Arrow batches, so no
text is sorted or moved; only what crosses the border of two blocks is written and put together
from both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from newstide.sources.corrupt import CORRUPT
from newstide.workspace import stage

_PLACE = ["file", "block"]
_QUOTE, _OPEN, _CLOSE, _ESCAPE = 1, 2, 3, 4
_KINDS = np.zeros(256, np.uint8)
for _characters, _kind in ((b'"', _QUOTE), (b"{[", _OPEN), (b"]", _CLOSE), (b"\\", _ESCAPE)):
    _KINDS[list(_characters)] = _kind


def _records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text up to and with each closing brace, with its file and block, in order."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.concat("value", F.lit("}")).alias("value"),
    )


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and kinds of quotes and brackets, without escaped ones and but for closing braces."""
    kinds = _KINDS[data]
    at = np.flatnonzero(kinds)
    kinds = kinds[at]
    slashes = at[kinds == _ESCAPE]
    if len(slashes):
        at, kinds = at[kinds != _ESCAPE], kinds[kinds != _ESCAPE]
        begins = np.maximum.accumulate(np.where(np.diff(slashes, prepend=-2) != 1, slashes, 0))
        before = np.searchsorted(slashes, at) - 1
        after_slash = (before >= 0) & (slashes[before] == at - 1)
        escaped = after_slash & ((at - begins[before]) % 2 == 1)
        at, kinds = at[~escaped], kinds[~escaped]
    return at, kinds


class _Run:
    """Records of one block that stand in one batch: after each, the quotes so far, and what it
    and those before it open less what they close, outside strings (0) and inside (1) if the run
    starts outside."""

    def __init__(self, data: np.ndarray, at: np.ndarray, kinds: np.ndarray, begin: int, ends: np.ndarray):
        low, high = np.searchsorted(at, [begin, ends[-1]])
        at, kinds = at[low:high], kinds[low:high]
        quotes = np.cumsum(kinds == _QUOTE)
        upto = np.searchsorted(at, ends)
        self.begin, self.ends, self.data = begin, ends, data
        self.quotes = np.concatenate([[0], quotes])[upto]
        step = (kinds == _OPEN).astype(np.int64) - (kinds == _CLOSE)
        self.depth = []
        for inside in (0, 1):
            opened = np.concatenate([[0], np.cumsum(np.where(quotes % 2 == inside, step, 0))])[upto]
            self.depth.append(opened - np.cumsum(self.quotes % 2 == inside))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], _Run]]:
    files, blocks, values = batch.columns
    ends = np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False)).astype(np.int64)
    width = np.int64 if pa.types.is_large_string(values.type) else np.int32
    first = int(np.frombuffer(values.buffers()[1], width)[values.offset])
    data = np.frombuffer(values.buffers()[2], np.uint8)[first : first + int(ends[-1])]
    at, kinds = _marks(data)
    changed = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
    edges = [0, *(np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        begin = int(ends[a - 1]) if a else 0
        yield (files[a].as_py(), blocks[a].as_py()), _Run(data, at, kinds, begin, ends[a:b])


_SUMS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("q", pa.int64()), ("d0", pa.int64()), ("d1", pa.int64()), ("head", pa.string())])
_PIECES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("nth", pa.int64()), ("value", pa.string()), ("whole", pa.bool_())])


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the quotes, what it opens less what it closes if it starts outside (``d0``) or
    inside (``d1``) a string, and its first character."""
    sums: dict[tuple[str, int], list] = {}
    for batch in batches:
        for place, run in _runs(batch) if batch.num_rows else ():
            if place not in sums:
                text = run.data[run.begin : run.ends[0] - 1].tobytes().decode(errors="replace")
                sums[place] = [0, 0, 0, text.lstrip(" \t\n\x0b\f\r\ufeff")[:1]]
            total = sums[place]
            swapped = total[0] % 2
            total[0] += int(run.quotes[-1])
            total[1] += int(run.depth[swapped][-1])
            total[2] += int(run.depth[1 - swapped][-1])
    rows = [dict(zip(_SUMS.names, (*place, *total))) for place, total in sums.items()]
    yield from pa.Table.from_pylist(rows, _SUMS).to_batches()


def _block_starts(spark: SparkSession, records: DataFrame) -> dict[tuple[str, int], tuple[int, int, int]]:
    """Of every (file, block) whether it starts inside a string, at what depth, and how deep the
    objects of its file lie: 1 in an array, 0 in a file of one object."""
    blocks = records.mapInArrow(_block_sums, "file string, block long, q long, d0 long, d1 long, head string")
    starts, last = {}, None
    for row in sorted(blocks.collect()):  # as many as the files have splits
        if row.file != last:
            last, inside, depth, base = row.file, 0, 0, int(row.head == "[")
        starts[row.file, row.block] = (inside, depth, base)
        depth += row.d1 if inside else row.d0
        inside = (inside + row.q) % 2
    return starts


def _pieces(records: DataFrame, starts, edges: bool) -> DataFrame:
    """(file, block, nth, value, whole) of the texts that end with an object, without its last
    brace, and of what a block holds after the last. With ``edges`` the first and the last of
    each block, which may belong together with its neighbours', otherwise the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rest, nth, inside, depth, base = None, [], 0, 0, 0, 0

        def piece(text: bytes, whole: bool) -> list[dict]:
            if edges != (nth == 0 or not whole):
                return []
            return [dict(zip(_PIECES.names, (*place, nth, text.decode(errors="replace"), whole)))]

        def left() -> list[dict]:
            return piece(b"".join(rest)[:-1], False) if rest else []

        for batch in batches:
            rows = []
            for here, part in _runs(batch) if batch.num_rows else ():
                if here != place:
                    rows += left()
                    place, rest, nth = here, [], 0
                    inside, depth, base = starts.value[here]
                after, quotes = depth + part.depth[inside], inside + part.quotes
                begin = part.begin
                for end in part.ends[(after == base) & (quotes % 2 == 0)].tolist():
                    rows += piece(b"".join([*rest, part.data[begin:end].tobytes()])[:-1], True)
                    begin, rest, nth = end, [], nth + 1
                if begin < part.ends[-1]:
                    rest.append(part.data[begin : part.ends[-1]].tobytes())
                inside, depth = int(quotes[-1]) % 2, int(after[-1])
            yield from pa.Table.from_pylist(rows, _PIECES).to_batches()
        yield from pa.Table.from_pylist(left(), _PIECES).to_batches()

    return records.mapInArrow(run, "file string, block long, nth long, value string, whole boolean")


def _joined(order: list[str]) -> Column:
    """Texts in order, with the braces that stood between them."""
    listed = F.array_sort(F.collect_list(F.struct(*order, "value")))
    return F.array_join(F.transform(listed, lambda x: x["value"]), "}").alias("value")


def json_objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, record, whole): the text of every object of JSON arrays, or of files of one object.

    What stands in a file outside its objects comes with ``whole`` false, if it is more than
    brackets, commas and white space. Texts are read three times and stay where they are.
    """
    records = _records(spark, path)
    starts = spark.sparkContext.broadcast(_block_starts(spark, records))
    inner = _pieces(records, starts, False).select("file", "value", "whole")
    edges = stage(_pieces(records, starts, True), "object-edges")
    along = Window.partitionBy("file").orderBy("block", "nth")
    closed = F.when(F.col("whole"), 1).otherwise(0)
    edges = edges.withColumn("object", F.sum(closed).over(along) - closed)
    edges = edges.groupBy("file", "object").agg(_joined(["block", "nth"]), F.max("whole").alias("whole"))
    every = inner.unionByName(edges.select("file", "value", "whole"))
    text = F.regexp_replace("value", r"\A[\s,\[\uFEFF]+", "")
    bare = F.regexp_replace(text, r"[\s,\]]+\z", "")
    return every.select(
        "file", F.when(F.col("whole"), F.concat(text, F.lit("}"))).otherwise(bare).alias("record"), "whole"
    ).filter("record <> ''")


def split_json_rows(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Rows of ``schema`` with the corrupt-record column, from objects found as above."""
    wider = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    found = json_objects(spark, path)
    row = F.when(F.col("whole"), F.from_json("record", wider, {"columnNameOfCorruptRecord": CORRUPT}))
    # Out of an array of one, so that the optimizer does not parse anew for every use of the row.
    parsed = found.select(F.explode_outer(F.array(row)).alias("row"), "record")
    broken = F.when(F.col("row").isNull(), F.col("record")).otherwise(F.col(f"row.{CORRUPT}"))
    return parsed.select(*[F.col(f"row.{f.name}") for f in schema.fields], broken.alias(CORRUPT))
