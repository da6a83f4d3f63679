"""Periodic runs of words: stretches that repeat themselves at least a few times in a row.

A run of period p and length p + l is a maximal pair: two equal stretches of l words, p apart,
that differ in the word before and in the word after. All stretches that occur more than once
are the LCP intervals of the suffix array; walking their tree bottom-up, every interval holds
the places of its stretch, also listed by the word before them. When a child interval is
united with its parent, places of both that lie close enough and have different words before
them are maximal pairs. A run needs l >= (exponent - 1) * p and p + l >= least, so only
intervals of ``shortest`` words and more matter, and only places within l / (exponent - 1).

Stretches of words within repeated strings of ``shortest`` words are found by hash and handled
one by one; a run lies in one of them with all its periods. Hash collisions cost time
only, as the tree is built from the words.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_type

from newstide.llm.common import WORD, bounded_batches, private, row_batches, with_outputs

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class RunLimits:
    """A run has at least ``least`` words and ``exponent`` periods, which is 2 or more."""

    least: int = 24
    exponent: int = 3

    def __post_init__(self):
        if self.exponent < 2 or self.least < 2:
            raise ValueError("a run has two words and two periods at least")

    @property
    def shortest(self) -> int:
        """Least length of the two equal stretches of a run."""
        return max(1, -(-self.least * (self.exponent - 1) // self.exponent))

    def reach(self, length: int) -> int:
        """Greatest period of a run whose equal stretches have this length."""
        return length // (self.exponent - 1)


def repeating_stretches(ids: np.ndarray, size: int) -> list[tuple[int, int]]:
    """[start, stop) of the stretches of words that lie in a ``size``-gram occurring twice or more."""
    n = len(ids) - size + 1
    if n < 2:
        return []
    # Hashes of doubling lengths, put together to the size wanted.
    part = (ids.astype(np.uint64) + np.uint64(1)) * _ODD
    part ^= part >> np.uint64(29)
    total, done, width = None, 0, 1
    while True:
        if size & width:
            total = part[:n] if total is None else total * _MIX + part[done : done + n]
            done += width
        if done == size:
            break
        part = (part[:-width] ^ (part[:-width] >> np.uint64(31))) * _ODD + part[width:]
        width *= 2
    order = np.argsort(total, kind="stable")
    same = total[order][1:] == total[order][:-1]
    hot = np.zeros(n, bool)
    hot[order[1:][same]] = True
    hot[order[:-1][same]] = True
    at, change = np.flatnonzero(hot), np.zeros(len(ids) + 1, np.int32)
    change[at] += 1
    change[at + size] -= 1
    edge = np.diff(np.r_[False, np.cumsum(change) > 0].astype(np.int8))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and the rank of every suffix, by prefix doubling."""
    n = len(ids)
    _, rank = np.unique(ids, return_inverse=True)
    rank, width = rank.astype(np.int64) + 1, 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-width] = rank[width:]
        pair = rank * (n + 1) + after
        order = np.argsort(pair, kind="stable")
        new = np.cumsum(np.r_[1, pair[order][1:] != pair[order][:-1]])
        rank[order] = new
        if new[-1] == n or width >= n:
            return order, rank - 1
        width *= 2


def common_prefixes(words: list[int], order: list[int], rank: list[int]) -> list[int]:
    """LCP of every suffix with the one before it in order (0 for the first)."""
    n, h = len(words), 0
    lcp = [0] * n
    for i in range(n):
        r = rank[i]
        if not r:
            h = 0
            continue
        j = order[r - 1]
        stop = n - max(i, j)
        while h < stop and words[i + h] == words[j + h]:
            h += 1
        lcp[r] = h
        if h:
            h -= 1
    return lcp


class Places:
    """Places of an interval's stretch: all in order, and in order by the word before."""

    __slots__ = ("every", "classes")

    def __init__(self, place: int, before: int):
        self.every = [place]
        self.classes = {before: [place]}

    def absorb(self, other: Places) -> None:
        for mine, theirs in ((self.every, other.every), *((self.classes.setdefault(c, []), x) for c, x in other.classes.items())):
            if not mine or mine[-1] < theirs[0]:
                mine.extend(theirs)
            elif len(theirs) * 16 < len(mine):
                for x in theirs:
                    insort(mine, x)
            else:
                mine.extend(theirs)
                mine.sort()

    def unlike(self, before: int, low: int, high: int) -> list[int]:
        """Places within [low, high] whose word before is another one.

        Overlapping places of one stretch lie a period apart, so that all but the leftmost
        follow the same word: those sought are the first in the window or all to its end.
        The class list tells how many they are; should they lie otherwise, all are looked at.
        """
        every, own = self.every, self.classes.get(before, [])
        a, b = bisect_left(every, low), bisect_right(every, high)
        n = b - a - (bisect_right(own, high) - bisect_left(own, low))
        if not n:
            return []
        if n == b - a:
            return every[a:b]
        first = every[a : a + n]
        c = bisect_left(own, low)
        if own[c] > first[-1]:
            return first
        same = set(own[c : bisect_right(own, high)])
        return [x for x in every[a:b] if x not in same]


def maximal_pairs(words: list[int], limits: RunLimits) -> Iterator[tuple[int, int, int]]:
    """(i, j, l): words equal for l places from i and j, i < j, that cannot be extended to
    either side, with l and j - i such that i to j + l is a run of period j - i. The first
    and the last word are context only: no pair starts at the first or reaches the last."""
    order, rank = suffix_order(np.array(words, np.int64))
    order, rank = order.tolist(), rank.tolist()
    lcp = common_prefixes(words, order, rank)
    least = limits.shortest
    n = len(order)

    def meet(one: Places, two: Places, length: int) -> Iterator[tuple[int, int, int]]:
        reach = limits.reach(length)
        for before, places in one.classes.items():
            for i in places:
                for j in two.unlike(before, i - reach, i + reach):
                    if abs(i - j) + length >= limits.least:
                        yield min(i, j), max(i, j), length

    stack: list[tuple[int, Places]] = []  # open intervals: their length and places so far
    part: Places | None = None  # the subtree that ends before suffix r
    for r in range(n + 1):
        length = lcp[r] if 0 < r < n else 0
        while stack and stack[-1][0] > length:
            closed, places = stack.pop()
            small, large = sorted((places, part), key=lambda p: len(p.every))
            yield from meet(small, large, closed)
            large.absorb(small)
            part = large
        if length >= least:
            if stack and stack[-1][0] == length:
                _, places = stack.pop()
                small, large = sorted((places, part), key=lambda p: len(p.every))
                yield from meet(small, large, length)
                large.absorb(small)
                part = large
            stack.append((length, part))
        if r < n and (length >= least or (r + 1 < n and lcp[r + 1] >= least)):
            part = Places(order[r], words[order[r] - 1] if order[r] else -1)


def narrow_stretches(ids: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Stretches of words that all lie in ``size``-grams repeated within the same stretch.

    A run lies in one of them: its two equal stretches overlap or touch, and each is made of
    such grams. Passages repeated far apart are split off again and again."""
    work = [(0, len(ids))]
    while work:
        a, b = work.pop()
        for c, d in repeating_stretches(ids[a:b], size):
            if d - c == b - a:
                yield a, b
            else:
                work.append((a + c, a + d))


def find_word_runs(ids: np.ndarray, limits: RunLimits = RunLimits()) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start and period.

    ``period`` is the smallest one: its multiples give maximal pairs over the same stretch.
    """
    found: dict[tuple[int, int], int] = {}
    n = len(ids)
    for a, b in narrow_stretches(ids, limits.shortest):
        # A word of context on both sides, which no pair reaches, as then its stretch would
        # be longer; numbers that occur nowhere stand for the ends.
        low, high = max(a - 1, 0), min(b + 1, n)
        words = [-2] * (a == 0) + ids[low:high].tolist() + [-3] * (b == n)
        for i, j, length in maximal_pairs(words, limits):
            key = (a - 1 + i, j - i + length)
            found[key] = min(found.get(key, j - i), j - i)
    runs = [(start, length, period) for (start, length), period in found.items()]
    return sorted(runs, key=lambda run: (run[0], run[2]))


def _word_runs(data: bytes, limits: RunLimits) -> tuple[int, list[tuple[int, int, int]], bytes]:
    """Number of words, runs, and the words outside the repetitions joined by one space."""
    words = data.split()
    numbers = dict(zip(dict.fromkeys(words), count()))
    runs = find_word_runs(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), limits)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    if runs:
        gone = np.cumsum(edge[:-1]) > 0
        kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
    else:
        kept = b" ".join(words)
    return len(words), runs, kept


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def word_runs(docs: DataFrame, text: str = "text", limits: RunLimits = RunLimits()) -> DataFrame:
    """``docs`` with ``n_words``, all ``runs`` (start, length, period; word numbers from 0) and
    the text ``collapsed``: of every run its first period stays, words joined by one space.

    Words end at ASCII white space and compare by their bytes. NULL and blank texts have no
    words, no runs and an empty ``collapsed``. Rows are handled one by one, repeated ones and
    ones with equal keys too; an empty table gives no rows; input columns named like the new
    ones give way. Nothing is shuffled; memory follows the longest text.
    """
    held = private("text")
    outputs = ["n_words", "runs", "collapsed"]
    clear = docs.drop(*[c for c in docs.columns if c.lower() in outputs and c != text])
    if text in outputs:
        raise ValueError(f"{text} is an output column")
    wide = clear.withColumn(held, F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            texts = batch.column(batch.num_columns - 1).cast(pa.string()).cast(pa.binary()).to_pylist()
            rows = [_word_runs(data or b"", limits) for data in texts]
            runs = [[{"start": a, "length": b, "period": c} for a, b, c in r[1]] for r in rows]
            new = [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array(runs, _RUN),
                pa.array([r[2] for r in rows], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + new, batch.schema.names[:-1] + outputs)

    schema = clear.schema.add("n_words", "long").add("runs", from_arrow_type(_RUN)).add("collapsed", "string")
    return bounded_batches(wide).mapInArrow(run, schema)


def with_tandem_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repetition put into a tenth of the texts, chosen by the key's checksum.

    With h the CRC-32 of the decimal key and g = h // 10, texts of n words with h % 10 = 0
    repeat, from word a = g % n on, the p = 1 + (n - a) // (3 + g % 8) words from there.
    A NULL key chooses none.
    """
    words, h, n, a, p = (private(name) for name in "whnap")
    shape = docs.withColumn(h, F.crc32(F.col(key).cast("string").cast("binary")))
    shape = shape.withColumn(
        words, F.when(F.col(h) % 10 == 0, F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)))
    ).withColumn(n, F.nullif(F.size(words), F.lit(0)).cast("long"))
    g = F.floor(F.col(h) / 10)
    shape = shape.withColumn(a, g % F.col(n))
    shape = shape.withColumn(p, F.lit(1) + F.floor((F.col(n) - F.col(a)) / (F.lit(3) + g % 8)))

    def moved(i):
        return F.get(F.col(words), (F.col(a) + (i - F.col(a)) % F.col(p)).cast("int"))

    tail = F.transform(F.sequence(F.col(a), F.col(n) - 1), moved)
    made = F.array_join(F.concat(F.slice(F.col(words), F.lit(1), F.col(a).cast("int")), tail), " ")
    changed = F.when(F.col(p).isNotNull(), made).otherwise(F.col(text))
    return with_outputs(shape, **{text: changed}).drop(words, h, n, a, p)


def run_digest(docs: DataFrame) -> DataFrame:
    found = word_runs(with_tandem_tails(docs.select("doc_id", "text")))
    # Exact comparison of length / period; runs come by start and period.
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda top, r: F.when(
            top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r
        ).otherwise(top),
    )
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    listed = F.array_join(F.transform("runs", line), "")
    top = found.withColumn("top", best)
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
