"""Search every text for many needles in one pass, in batches of rows inside the tasks.

A needle is filed under its n-gram of up to 8 bytes at the start. The n-grams of a text at all
its places where a needle starts with the same three bytes, taken as numbers, probe these; a
needle that is longer is then compared in words of 8 bytes where its n-gram was found. Time
follows the bytes of the texts and what is found, not the needles.

For the plans that do not hold the needles in the tasks, texts are marked by their n-grams: by a
bitmap of them (:func:`with_bitmap`), or by a list of those that some needle is filed under
(:func:`with_anchors`). Both take an n-gram as the same number as :func:`gram_code` does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 16


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys * _MIX) >> np.uint64(64 - _BITS)


class Lookup:
    """Entries (label, needles): an entry is found in a row whose texts hold all its needles.

    An empty needle lies in every text, also in an empty one. Labels come in their own order.
    """

    def __init__(self, entries: list[tuple[object, list[str]]], gram: int = 8):
        labels = sorted({label for label, _ in entries}, key=lambda v: v.encode() if isinstance(v, str) else v)
        number = {label: i for i, label in enumerate(labels)}
        needles = sorted({needle.encode() for _, parts in entries for needle in parts})
        place = {needle: i for i, needle in enumerate(needles)}
        self.labels, self.n = labels, max(len(needles), 1)
        self.sizes = np.array([len(set(parts)) for _, parts in entries], np.int64)
        self.label_of = np.array([number[label] for label, _ in entries], np.int64)
        uses = sorted((place[p.encode()], i) for i, (_, parts) in enumerate(entries) for p in set(parts))
        self.uses = np.array([i for _, i in uses], np.int64)
        self.uses_at = np.searchsorted(np.array([p for p, _ in uses], np.int64), np.arange(len(needles) + 1))

        lengths = np.array([len(needle) for needle in needles], np.int64)
        self.lengths, self.longest = lengths, int(lengths.max(initial=0))
        self.has_empty = self.longest == 0 and len(needles) > 0 or bool((lengths == 0).any())
        # The bytes of all needles in words of 8, the last one filled with zeros.
        self.words = -(-lengths // 8)
        self.words_at = np.cumsum(self.words) - self.words
        padded = b"".join(needle.ljust(8 * int(w), b"\0") for needle, w in zip(needles, self.words))
        self.spelled = np.frombuffer(padded, "<u8")
        self.classes = []
        for size in range(1, gram + 1):
            which, mask = np.flatnonzero(np.minimum(lengths, gram) == size), np.uint64((1 << 8 * size) - 1)
            if len(which):
                keys = self.spelled[self.words_at[which]] & mask
                order = np.argsort(keys, kind="stable")
                slots = np.zeros(1 << _BITS, bool)
                slots[_slots(keys)] = True
                self.classes.append((size == gram, mask, keys[order], which[order], slots))
        self.lead = None

    def _classes_led(self) -> np.ndarray:
        """Per three bytes a bit for each class with a needle that starts so, or is as short and
        starts them. Made where it is used: 16 MB that need not be sent."""
        if self.lead is None:
            lead = np.zeros(1 << 24, np.uint8)
            for i, (_, mask, keys, _, _) in enumerate(self.classes):
                size = min(int(mask).bit_length() // 8, 3)
                starts = np.unique(keys & np.uint64((1 << 8 * size) - 1)).astype(np.int64)
                led = lead.reshape(-1, 1 << 8 * size)
                for start in starts if size < 3 else ():
                    led[:, start] |= np.uint8(1 << i)
                if size == 3:
                    lead[starts] |= np.uint8(1 << i)
            self.lead = lead
        return self.lead

    def _longer(self, view: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of needles whose n-grams stand at their places, those that stand there whole."""
        whole, j = [], 0
        while len(at):
            ended = self.words[which] <= j
            whole.append((at[ended], which[ended]))
            at, which = at[~ended], which[~ended]
            bits = np.minimum(self.lengths[which] - 8 * j, 8).astype(np.uint64) * np.uint64(8)
            mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - bits)
            same = (view[at + 8 * j] & mask) == self.spelled[self.words_at[which] + j]
            at, which, j = at[same], which[same], j + 1
        return np.concatenate([w[0] for w in whole]), np.concatenate([w[1] for w in whole])

    def _needles_found(self, data: np.ndarray, ends: np.ndarray, row_of: np.ndarray) -> np.ndarray:
        """Distinct row * n + needle; text i ends before byte ``ends[i]`` and is of ``row_of[i]``."""
        length = len(data)
        padded = np.zeros(length + self.longest + 16, np.uint8)
        padded[:length] = data
        view = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        found, lead = [], self._classes_led()
        if self.has_empty:
            found.append(np.unique(row_of) * self.n)  # the empty needle sorts first
        for start in range(0, length, _CHUNK):
            stop = min(start + _CHUNK, length)
            words = view[start:stop].copy()
            first, last = np.searchsorted(ends, [start, stop - 1], side="right")
            sizes = np.minimum(ends[first : last + 1], stop) - np.concatenate([[start], ends[first:last]])
            text_at = np.repeat(np.arange(first, last + 1), sizes)
            led = lead[(words & np.uint64(0xFFFFFF)).view(np.int64)]
            some = np.flatnonzero(led)
            led, codes = led[some], []
            for i, (longer, mask, keys, order, slots) in enumerate(self.classes):
                near = some[(led & np.uint8(1 << i)) != 0]
                grams = words[near] & mask
                likely = slots[_slots(grams)]
                near, grams = near[likely], grams[likely]
                if not len(near):
                    continue
                low = np.searchsorted(keys, grams)
                known = keys[np.minimum(low, len(keys) - 1)] == grams
                at, low, grams = near[known] + start, low[known], grams[known]
                if longer and len(at):
                    n = np.searchsorted(keys, grams, side="right") - low
                    at, low = np.repeat(at, n), np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                    at, which = self._longer(view, at, order[low])
                else:
                    which = order[low]
                text = text_at[at - start]
                inside = at + self.lengths[which] <= ends[text]
                codes.append(row_of[text[inside]] * self.n + which[inside])
            if codes:
                found.append(self._distinct(np.concatenate(codes), int(row_of[first]), int(row_of[last])))
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def _distinct(self, codes: np.ndarray, first: int, last: int) -> np.ndarray:
        """Distinct row * n + needle of the rows from first to last."""
        base, cells = first * self.n, (last - first + 1) * self.n
        if cells > 64 * _CHUNK:
            return np.unique(codes)
        seen = np.zeros(cells, bool)
        seen[codes - base] = True
        return np.flatnonzero(seen) + base

    def search(self, lists: pa.ListArray, kind: pa.DataType) -> pa.ListArray:
        """Per row the labels found in its list of texts, without NULLs, in order."""
        texts, rows = lists.flatten(), len(lists)
        per_row = np.diff(lists.offsets.to_numpy())
        row_of = np.repeat(np.arange(rows, dtype=np.int64), per_row)
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        if len(texts) and len(self.sizes):
            at = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            data = texts.buffers()[2]
            data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
            codes = self._needles_found(data, at[1:] - at[0], row_of)
            row, needle = codes // self.n, codes % self.n
            n = self.uses_at[needle + 1] - self.uses_at[needle]
            entry = self.uses[np.repeat(self.uses_at[needle] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            met, times = np.unique(np.repeat(row, n) * len(self.sizes) + entry, return_counts=True)
            met = met[times == self.sizes[met % len(self.sizes)]]
            got = np.unique(met // len(self.sizes) * len(self.labels) + self.label_of[met % len(self.sizes)])
            row, label = got // len(self.labels), got % len(self.labels)
        else:
            row = label = np.zeros(0, np.int64)
        offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
        values = pa.array(self.labels, kind).take(pa.array(label))
        return pa.ListArray.from_arrays(pa.array(offsets), values)


def _mapped(
    rows: DataFrame, dropped: list[str], added: list[T.StructField], search: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """``rows`` without the columns ``dropped`` and with those that ``search`` gives per batch."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    shape = T.StructType([*[f for f in rows.schema.fields if f.name not in dropped], *added])
    names, places = [f.name for f in shape.fields], [i for i, c in enumerate(rows.columns) if c not in dropped]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in places], *search(batch)], names=names)

    return rows.mapInArrow(run, shape)


def with_labels(rows: DataFrame, texts: str, kind: T.DataType, **lookups: Lookup) -> DataFrame:
    """``rows`` without the array column ``texts``, and a column of found labels per lookup.

    The lookups are broadcast; rows stay where they are.
    """
    sent = {name: rows.sparkSession.sparkContext.broadcast(lookup) for name, lookup in lookups.items()}
    label_type = pa.string() if isinstance(kind, T.StringType) else pa.int64()
    place = rows.columns.index(texts)

    def search(batch: pa.RecordBatch) -> list[pa.Array]:
        return [lookup.value.search(batch.column(place), label_type) for lookup in sent.values()]

    return _mapped(rows, [texts], [T.StructField(name, T.ArrayType(kind)) for name in lookups], search)


def with_listed(rows: DataFrame, texts: str, needles: str, found: str) -> DataFrame:
    """``rows`` without the array columns ``texts`` and ``needles``, and with the needles found.

    A row lists the needles that may lie in its texts; a batch is searched once for those of
    all its rows.
    """
    place, listed = rows.columns.index(texts), rows.columns.index(needles)

    def search(batch: pa.RecordBatch) -> list[pa.Array]:
        wanted = batch.column(listed).flatten().unique().to_pylist()
        return [Lookup([(needle, [needle]) for needle in wanted]).search(batch.column(place), pa.string())]

    return _mapped(rows, [texts, needles], [T.StructField(found, T.ArrayType(T.StringType()))], search)


# --- n-grams as numbers ---------------------------------------------------------------

CODE_BITS = 40
_FIRST, _SECOND, _FOLD = 0xB5C0FBD, 0x9E3779B9, 29  # products stay below 2 ** 63, as the JVM fails beyond


def gram_code(text: Column, start: Column, size: int) -> Column:
    """Number of ``CODE_BITS`` bits of the ``size`` bytes, 8 at most, from a place (from 1) on."""
    data = F.encode(text, "UTF-8")

    def number(at: Column, n: int) -> Column:
        return F.conv(F.hex(F.substring(data, at, F.lit(n))), 16, 10).cast("long")

    code = (number(start, min(size, 4)) + F.lit(size << 32)) * F.lit(_FIRST)
    if size > 4:
        code = code.bitwiseXOR(number(start + 4, size - 4) * F.lit(_SECOND))
    return code.bitwiseXOR(F.shiftright(code, _FOLD)).bitwiseAND(F.lit((1 << CODE_BITS) - 1))


def _codes(view: np.ndarray, at: slice, size: int) -> np.ndarray:
    """:func:`gram_code` at places of a text; ``view`` holds the four bytes from each place on."""
    first = view[at].astype(np.uint64) >> np.uint64(8 * (4 - min(size, 4)))
    code = (first + np.uint64(size << 32)) * np.uint64(_FIRST)
    if size > 4:
        rest = view[at.start + 4 : at.stop + 4 : at.step].astype(np.uint64) >> np.uint64(8 * (8 - size))
        code ^= rest * np.uint64(_SECOND)
    return (code ^ (code >> np.uint64(_FOLD))) & np.uint64((1 << CODE_BITS) - 1)


def _bytes_of(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, int]:
    """Four bytes from each place of the texts on, where each row's texts end, and all their length."""
    texts = lists.flatten()
    ends = np.cumsum(np.r_[0, pc.binary_length(texts).to_numpy(zero_copy_only=False)]).astype(np.int64)
    length, per_row = int(ends[-1]), np.cumsum(np.diff(lists.offsets.to_numpy()))
    padded = np.zeros(length + 16, np.uint8)
    if length:
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        first = np.frombuffer(texts.buffers()[1], width)[texts.offset]
        padded[:length] = np.frombuffer(texts.buffers()[2], np.uint8)[first : first + length]
    return np.ndarray(length + 12, ">u4", padded, strides=(1,)), ends[per_row], length


def _rows_at(ends: np.ndarray, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have a byte from ``start`` to ``stop``, and how many."""
    first, last = np.searchsorted(ends, [start, stop - 1], side="right")
    rows = np.arange(first, last + 1)
    return rows, np.minimum(ends[rows], stop) - np.concatenate([[start], ends[first:last]])


_BITMAP_WORDS = 1 << 17  # of one row at most
_SHORT = 4
_OTHER = 17  # bits of a code that the second bit of its n-gram leaves out


def bitmap_sizes(lengths: list[int]) -> list[int]:
    """Sizes of the n-grams that a bitmap must hold for needles of these lengths in bytes."""
    sizes = {min(n, 8) for n in lengths}
    return sorted(sizes | {_SHORT} if max(sizes, default=0) > _SHORT else sizes)


def with_bitmap(rows: DataFrame, texts: str, sizes: list[int], bitmap: str, most_bits: int = 1 << 25) -> DataFrame:
    """``rows`` with a column of the n-grams of ``sizes`` in the array column ``texts``: an array
    of a power of two of words, 32 to 64 bits for a byte, of which an n-gram sets two. See
    :func:`may_hold`."""
    place = rows.columns.index(texts)

    def mark(view: np.ndarray, ends: np.ndarray, begin: int, words: np.ndarray) -> np.ndarray:
        """Bitmaps of rows whose texts lie from ``begin`` on."""
        at = np.cumsum(words) - words
        marked = np.zeros(int(words.sum()) * 64, bool)
        for start in range(begin, int(ends[-1]), _CHUNK):
            stop = min(start + _CHUNK, int(ends[-1]))
            own, n = _rows_at(ends, start, stop)
            base, mask = np.repeat(64 * at[own], n), np.repeat((64 * words[own] - 1).astype(np.uint64), n)
            for size in sizes:
                codes = _codes(view, slice(start, stop, 1), size)
                marked[base + (codes & mask).astype(np.int64)] = True
                marked[base + ((codes >> np.uint64(_OTHER)) & mask).astype(np.int64)] = True
        return np.packbits(marked, bitorder="little").view("<i8")

    def search(batch: pa.RecordBatch) -> list[pa.Array]:
        view, ends, _ = _bytes_of(batch.column(place))
        held = np.diff(np.r_[0, ends])
        words = np.left_shift(1, np.ceil(np.log2(np.maximum(held / 2, 1))).astype(np.int64))
        words = np.minimum(words, _BITMAP_WORDS)
        parts, total = [np.zeros(0, "<i8")], np.cumsum(words) * 64
        low = 0
        while low < len(words):  # a few rows at a time, as a bit takes a byte while it is made
            spent = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, spent + most_bits, "right")))
            parts.append(mark(view, ends[low:high], int(ends[low - 1]) if low else 0, words[low:high]))
            low = high
        offsets = np.r_[0, np.cumsum(words)].astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts), pa.int64()))]

    return _mapped(rows, [], [T.StructField(bitmap, T.ArrayType(T.LongType()))], search)


def probes(needle: Column, sizes: list[int]) -> list[tuple[Column, Column]]:
    """(word, bit) to look at in a bitmap: both bits of a needle's first and last n-gram, the
    longest that it has, then of those of ``_SHORT`` bytes, which fewer texts hold by chance."""
    length, out = F.octet_length(needle), []
    bits = F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(64)])
    for used in (sizes, [size for size in sizes if size <= _SHORT]):
        for last in (False, True) if used else ():
            code = F.lit(0).cast("long")
            for size in used:
                own = length >= size if size == max(used) else length == size
                start = length - size + 1 if last else F.lit(1)
                code = F.when(own, gram_code(needle, F.greatest(start, F.lit(1)), size)).otherwise(code)
            for shifted in (code, F.shiftright(code, _OTHER)):
                word = F.shiftright(shifted, 6).bitwiseAND(F.lit(_BITMAP_WORDS - 1)).cast("int")
                out.append((word, F.element_at(bits, (shifted % 64 + 1).cast("int"))))
    return out


def may_hold(bitmap: Column, found: list[tuple[Column, Column]]) -> Column:
    """Whether a row's bitmap holds all of the needle's bits looked at; no text that holds the
    needle is without them."""
    held = [F.get(bitmap, word.bitwiseAND(F.size(bitmap) - 1)).bitwiseAND(bit) != 0 for word, bit in found]
    return reduce(lambda a, b: a & b, held)


class CodeFilter:
    """Bits of the codes that needles are filed under; others pass in a few cases only."""

    def __init__(self, bits: int, rows: list[tuple[int, bytes]], width: int):
        self.bits, self.held = bits, np.zeros(bits // 8, np.uint8)
        for row, held in rows:
            at = row * width // 8
            self.held[at : at + width // 8] = np.frombuffer(held, np.uint8)[: width // 8]

    def among(self, codes: np.ndarray) -> np.ndarray:
        place = codes & np.uint64(self.bits - 1)
        shift = (place & np.uint64(7)).astype(np.uint8)
        return np.flatnonzero((self.held[(place >> np.uint64(3)).astype(np.int64)] >> shift) & np.uint8(1))


def with_anchors(
    rows: DataFrame, texts: str, classes: list[tuple[int, int]], known: CodeFilter, anchors: str
) -> DataFrame:
    """``rows`` without the array column ``texts``, and with the distinct codes of its n-grams
    that pass the filter: per class (size, step) those at every step-th place."""
    place, sent = rows.columns.index(texts), rows.sparkSession.sparkContext.broadcast(known)

    def search(batch: pa.RecordBatch) -> list[pa.Array]:
        view, ends, length = _bytes_of(batch.column(place))
        found = [np.zeros(0, np.uint64)]
        for start in range(0, length, _CHUNK):
            stop = min(start + _CHUNK, length)
            own, n = _rows_at(ends, start, stop)
            row = np.repeat(own.astype(np.uint64) << np.uint64(CODE_BITS), n)
            for size, step in classes:
                # Every step-th place of the batch is every step-th place of each text.
                first = start + -start % step
                codes = _codes(view, slice(first, stop, step), size)
                near = sent.value.among(codes)
                found.append(np.unique(codes[near] | row[first - start :: step][near]))
        every = np.unique(np.concatenate(found))
        offsets = np.searchsorted(every >> np.uint64(CODE_BITS), np.arange(len(ends) + 1)).astype(np.int32)
        codes = (every & np.uint64((1 << CODE_BITS) - 1)).astype(np.int64)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes))]

    return _mapped(rows, [texts], [T.StructField(anchors, T.ArrayType(T.LongType()))], search)
