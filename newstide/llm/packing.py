"""Packing tokenized documents into sequences of fixed size with next to no padding.

Of a document, whole sequences are cut off first; the rest, shorter than a sequence, is a
piece of some length. How many pieces there are of each length is a histogram, and filling
sequences with them is a cutting-stock problem: see :mod:`newstide.llm.cutting_stock`. A
pattern takes so many pieces of each length; pieces of one length are ranked, and a rank says
by arithmetic which copy of which pattern, and which place in it, is the piece's. Pieces that
no pattern takes lie end to end in a stream that is cut every ``size`` tokens; its last part is
cut into powers of two. So every sequence is full or a power of two long.

Texts are tokenized once and never moved; ranks are counted where rows are read, and what a
task must add to its own counts is one number per length.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from tokenizers import Tokenizer

from newstide.llm.common import bounded_batches, private, row_batches
from newstide.llm.cutting_stock import Pattern, plan_patterns
from newstide.workspace import stage

# Tokenizers split at Unicode's white space; Python also counts four separators.
_BREAK = re.compile(r"(?<=[\S\x1c-\x1f])(?=[^\S\x1c-\x1f])")


@dataclass(frozen=True)
class PackingLimits:
    """Tokens per sequence, the id that ends a document, characters tokenized at a time, and
    bytes of offsets to broadcast."""

    size: int = 1024
    end: int = 0
    piece: int = 1 << 20
    broadcast_bytes: int = 32 << 20


# Fixed value: how byte-level tokenizers of this kind cut texts before they merge bytes.
_WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def merge_ranks(file: str) -> dict[bytes, int] | None:
    """Bytes to id of a tokenizer file's vocabulary, or None if its ids do not follow the order
    of its merges, so that the least id is not the next merge."""
    with open(file, encoding="utf-8") as opened:
        whole = json.load(opened)
    vocabulary = whole["model"]["vocab"]
    merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in whole["model"]["merges"]]
    if any(b <= a for a, b in zip(merged, merged[1:])):
        return None
    # Bytes that are no visible letter are written as letters from 256 on.
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in seen]
    as_byte = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {added["content"] for added in whole["added_tokens"]}
    return {bytes(map(as_byte.__getitem__, token)): i for token, i in vocabulary.items() if token not in special}


class TextEncoder:
    """Token ids, as little-endian 32-bit numbers, of texts.

    They are the ids of the tokenizer in the file. Where that is a byte-level one whose ids
    follow its merges, ``tiktoken`` finds them from the same vocabulary in a quarter of the
    time; pieces with a special string, and other files, go to ``tokenizers`` itself.
    """

    def __init__(self, file: str, limits: PackingLimits):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        self.tokenizer, self.piece = Tokenizer.from_file(file), limits.piece
        ranks = merge_ranks(file)
        self.quick = None
        if ranks is not None:
            self.quick = tiktoken.Encoding("texts", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, text: str) -> bytes:
        if self.quick is None or any(s in text for s in self.special):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            found = self.quick.encode_ordinary(text)
        return np.array(found, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """Long texts are cut before white space, which nothing before it is joined with."""
        parts, start = [], 0
        while start < len(text):
            cut = _BREAK.search(text, start + self.piece) if len(text) - start > self.piece else None
            stop = cut.start() if cut else len(text)
            parts.append(self._ids(text[start:stop]))
            start = stop
        return b"".join(parts)


def tokenized(docs: DataFrame, text: str, tokenizer: str, names: dict[str, str], limits: PackingLimits) -> DataFrame:
    """``docs`` with the columns ``names`` gives for: token ids, the task, whole sequences cut
    off, what is left, and how many sequences and rests of that length the task met before."""
    held = private("text")
    wide = docs.withColumn(held, F.coalesce(F.col(text), F.lit("")))
    order = ["ids", "task", "full", "rest", "full_at", "rest_at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = TextEncoder(tokenizer, limits), np.array([limits.end], "<u4").tobytes()
        task, full_at, rests = TaskContext.get().partitionId(), 0, Counter()
        for batch in row_batches(batches):
            rows = []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                ids = encoder.ids(value) + end
                full, rest = divmod(len(ids) // 4, limits.size)
                rows.append((ids, task, full, rest, full_at, rests[rest]))
                full_at += full
                rests[rest] += 1
            kinds = [pa.binary()] + [pa.int64()] * 5
            new = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            columns = batch.columns[:-1] + new
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1] + [names[n] for n in order])

    schema = docs.schema
    for name in order:
        schema = schema.add(names[name], "binary" if name == "ids" else "long")
    return bounded_batches(wide).mapInArrow(run, schema)


def _stream(total: int, size: int) -> list[int]:
    """Starts of the last, shorter sequences of a stream, and its end."""
    left = total % size
    powers = [1 << k for k in reversed(range(left.bit_length())) if left >> k & 1]
    return list(accumulate(powers, initial=total - left))


def packed_pieces(
    docs: DataFrame, tokenizer: str, text: str = "text", limits: PackingLimits = PackingLimits()
) -> DataFrame:
    """A row per piece: the columns of ``docs`` but its text, and ``start`` (ids of the document
    before the piece), ``length``, ``ids`` (binary, little-endian 32-bit), ``doc_tokens`` (with
    the id that ends it), ``sequence_id`` (from 0 without gaps) and ``offset`` in the sequence.

    ``tokenizer`` is a byte-level tokenizer file every executor can read. NULL is the empty
    text: a document of one id. Rows are packed one by one, repeated ones, ties in length and
    rows of equal or NULL keys too; an empty table gives no rows. Input columns named like the
    new ones give way. The order of documents in sequences follows the table's partitions. A
    task holds the ids of an Arrow batch; the driver a number per length and a few thousand patterns.
    """
    size = limits.size
    names = {n: private(n) for n in ("ids", "task", "full", "rest", "full_at", "rest_at")}
    outputs = {"start", "length", "ids", "doc_tokens", "sequence_id", "offset"}
    clear = docs.drop(*[c for c in docs.columns if c.lower() in outputs and c != text])
    kept = [c for c in clear.columns if c != text]
    coded = tokenized(clear.select(*kept, text), text, tokenizer, names, limits).drop(text)
    coded = stage(coded, "token-ids")
    ids, task, full, rest = (F.col(names[n]) for n in ("ids", "task", "full", "rest"))

    # Per task and length the pieces of the tasks before; whole sequences count as length 0,
    # as a rest of 0 is no piece.
    counted = (
        coded.groupBy(task.alias("task"), rest.alias("len"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(full).alias("full"))
    )
    counted = stage(counted, "piece-counts")
    wholes = counted.groupBy("task").agg(F.sum("full").alias("n")).select("task", F.lit(0).cast("long").alias("len"), "n")
    rests = counted.filter("len > 0").select("task", "len", "n")
    before = F.sum("n").over(Window.partitionBy("len").orderBy("task")) - F.col("n")
    offsets = stage(wholes.unionByName(rests).withColumn("before", before), "piece-offsets")
    histogram = {r["len"]: r["n"] for r in offsets.groupBy("len").agg(F.sum("n").alias("n")).collect()}
    n_whole = histogram.pop(0, 0)

    patterns = plan_patterns(histogram, size)
    rows, streamed = _places(histogram, patterns)
    n_packed = sum(p.copies for p in patterns)
    ends = _stream(streamed, size)
    n_streamed = streamed // size + len(ends) - 1
    whole_base = n_packed + n_streamed
    spark = docs.sparkSession
    places = spark.createDataFrame(
        rows or [(0, 0, 0, 0, 0, 0)], "p_len long, lo long, hi long, per long, base long, first long"
    )

    small = offsets.count() * 24 <= limits.broadcast_bytes
    sized = F.broadcast if small else (lambda df: df)
    for_rest = sized(offsets.filter("len > 0").select(F.col("task").alias("r_task"), "len", F.col("before").alias("r_before")))
    for_full = sized(offsets.filter("len = 0").select(F.col("task").alias("f_task"), F.col("before").alias("f_before")))
    known = coded.join(for_full, task == F.col("f_task")).join(
        for_rest, (task == F.col("r_task")) & (rest == F.col("len")), "left"
    )
    known = known.withColumn("rank", F.col("r_before") + F.col(names["rest_at"]))
    # As many rows as patterns have parts, some thousand at most.
    known = known.join(
        F.broadcast(places), (rest == F.col("p_len")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")), "left"
    )

    def piece(start: Column, length: Column, sequence: Column, offset: Column) -> Column:
        values = {"start": start, "length": length, "sequence_id": sequence, "offset": offset}
        return F.struct(*[v.cast("long").alias(n) for n, v in values.items()])

    none = F.array().cast("array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>>")
    whole_first = F.lit(whole_base) + F.col("f_before") + F.col(names["full_at"])
    whole = F.when(
        full > 0,
        F.transform(F.sequence(F.lit(0).cast("long"), full - 1), lambda i: piece(i * size, F.lit(size), whole_first + i, F.lit(0))),
    ).otherwise(none)
    turn = F.col("rank") - F.col("lo")
    in_pattern = F.array(
        piece(
            full * size, rest, F.col("base") + F.floor(turn / F.col("per")), F.col("first") + turn % F.col("per") * rest
        )
    )
    # A piece of the stream is cut where sequences end: [at, at + rest).
    at = F.col("base") + turn * rest
    tail = F.array(*[F.lit(x).cast("long") for x in ends])
    cuts = F.concat(F.array((F.floor(at / size) + 1) * size), tail)
    edges = F.array_sort(F.array_distinct(F.concat(F.array(at, at + rest), F.filter(cuts, lambda c: (c > at) & (c < at + rest)))))

    def streamed_piece(edge: Column, i: Column) -> Column:
        stop = F.get("edges", i + 1)
        order = F.size(F.filter(tail, lambda x: x <= edge)) - 1  # in the last part, if not -1
        start_of = F.when(order < 0, F.floor(edge / size) * size).otherwise(F.get(tail, order))
        index = F.when(order < 0, F.floor(edge / size)).otherwise(F.lit(streamed // size) + order)
        return piece(full * size + edge - at, stop - edge, F.lit(n_packed) + index, edge - start_of)

    in_stream = F.transform(F.slice("edges", 1, F.size("edges") - 1), streamed_piece)
    known = known.withColumn("edges", F.when(F.col("per") == 0, edges))
    pieces = F.when(rest == 0, none).when(F.col("per") > 0, in_pattern).otherwise(in_stream)
    tokens = (F.octet_length(ids) / 4).cast("long")
    kept_columns = [F.col(f"`{c}`") for c in kept]
    cut = known.select(
        *kept_columns, ids.alias(names["ids"]), tokens.alias("doc_tokens"), F.inline(F.concat(whole, pieces))
    )
    part = F.substring(ids, (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    return cut.select(*kept_columns, "start", "length", part.alias("ids"), "doc_tokens", "sequence_id", "offset")


def _places(histogram: dict[int, int], patterns: list[Pattern]) -> tuple[list[tuple], int]:
    """(length, ranks from, to, pieces per copy, first sequence, first offset) for what patterns
    take, and with 0 pieces per copy and a place in the stream for the rest; the stream's length."""
    rows, used, sequence = [], Counter(), 0
    for pattern in patterns:
        offset = 0
        for length, many in pattern.parts:
            stop = used[length] + many * pattern.copies
            rows.append((length, used[length], stop, many, sequence, offset))
            used[length] = stop
            offset += many * length
        sequence += pattern.copies
    streamed = 0
    for length in sorted(histogram):
        left = histogram[length] - used[length]
        if left:
            rows.append((length, used[length], histogram[length], 0, streamed, 0))
            streamed += left * length
    return rows, streamed


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_tokens) of packed pieces; a group holds one sequence's tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", joined.alias("ids"), (F.octet_length(joined) / 4).cast("long").alias("n_tokens")
    )


def packing_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    return packed_pieces(docs.select("doc_id", "text"), tokenizer).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
