"""Removal of byte strings that occur in an earlier document, by sorted suffixes.

Every string of ``length`` bytes contains an anchor: a short gram whose hash is least among
those around it, so equal strings have equal anchors at equal places. Anchors that occur in
one document only are dismissed, and with them the strings they stand for. The suffixes at
the other anchors are sorted: prefix polynomial hashes give the hash of any substring at
once, binary search over them the common extension of two suffixes, and so a comparison in
logarithmic time for the merge sort. Common extensions to the right of an anchor, and hashes
of what stands to its left, then tell which whole strings are equal; equal hashes are
verified on the bytes.

Spark deals documents out into chunks by id and text and anchors into buckets by their hash.
What moves is the documents once, 8 bytes per anchor, and the surroundings of anchors that
occur in several documents. Anchors of very many documents are replaced by the whole strings
around them, of which a chunk sends each once, so that no bucket gathers one anchor's all
surroundings.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newstide.llm.common import bounded_batches
from newstide.workspace import stage

_MOD = 1 << 64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, _MOD)
_LETTER = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class RepeatLimits:
    """Bytes of a string and of an anchor, documents' chunk size, and the number of
    documents from which on an anchor is replaced by whole strings."""

    length: int = 50
    gram: int = 16
    chunk_bytes: int = 4 << 20
    hot: int = 1000

    @property
    def window(self) -> int:
        return self.length - self.gram + 1


class Powers:
    """Powers of the hash base and of its inverse, as many as have been needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            self.up, self.down = (_powers(x, 2 * n + 64) for x in (_BASE, _INVERSE))
        return self.up, self.down


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def prefix_hashes(rows: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of every prefix, along the last axis; the hash of [i, j) is
    (p[j] - p[i]) times the inverse base to the i."""
    n = rows.shape[-1]
    out = np.zeros((*rows.shape[:-1], n + 1), np.uint64)
    np.cumsum(_LETTER[rows] * powers.to(n)[0][:n], axis=-1, out=out[..., 1:])
    return out


def stirred(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of every ``width`` values in a row, by doubling."""
    step = 1
    while 2 * step <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, powers: Powers, limits: RepeatLimits):
    """Places and hashes of the anchors, and the least hash of every window."""
    k, w = limits.gram, limits.window
    prefix = prefix_hashes(data, powers)
    grams = stirred((prefix[k:] - prefix[:-k]) * powers.to(len(data))[1][: len(data) - k + 1])
    least = _slide(grams, w, np.minimum)
    padded = np.zeros(len(grams) + w - 1, np.uint64)
    padded[w - 1 : w - 1 + len(least)] = least
    at = np.flatnonzero(_slide(padded, w, np.maximum) == grams)
    return at, grams[at], least


def _texts(table: pa.Table, limits: RepeatLimits):
    """(id, bytes) of the documents that are long enough."""
    for doc, data in zip(table.column("doc").to_pylist(), table.column("data").to_pylist()):
        if len(data) >= limits.length:
            yield doc, np.frombuffer(data, np.uint8)


def _parts(table: pa.Table) -> list[int]:
    """Which of the texts of its id each row of a chunk holds, 0 where an id has one text.

    Rows may share an id, or have none; a place says in its upper half in which text it is.
    """
    docs, texts = table.column("doc").to_pylist(), table.column("data").to_pylist()
    shared = {doc for doc, n in Counter(docs).items() if n > 1}
    known: dict[int, set[bytes]] = {doc: set() for doc in shared}
    for doc, data in zip(docs, texts):
        if doc in shared:
            known[doc].add(data)
    order = {doc: {data: i for i, data in enumerate(sorted(found))} for doc, found in known.items()}
    return [order[doc][data] if doc in shared else 0 for doc, data in zip(docs, texts)]


def _blobs(schema: list[tuple], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table({n: pa.array(list(c), k) for (n, k), c in zip(schema, columns)})


_ANCHORS = [("bucket", pa.int32()), ("chunk", pa.int32()), ("marks", pa.binary()), ("docs", pa.binary())]
_REPEATS = [("chunk", pa.int32()), ("marks", pa.binary()), ("hot", pa.binary())]
_SUFFIXES = [
    ("bucket", pa.int32()), ("chunk", pa.int32()), ("marks", pa.binary()), ("bodies", pa.binary()),
    ("masks", pa.binary()), ("docs", pa.binary()), ("places", pa.binary()),
]
_FOUND = [("chunk", pa.int32()), ("docs", pa.binary()), ("places", pa.binary()), ("masks", pa.binary())]
_SQL = {pa.int32(): "int", pa.binary(): "binary"}


def _ddl(schema: list[tuple]) -> str:
    return ", ".join(f"{n} {_SQL[k]}" for n, k in schema)


def _split(values: np.ndarray):
    """(value, index slice) for every run of equal values."""
    edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(values[a]), slice(a, b)


def chunk_anchors(limits: RepeatLimits, buckets: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        powers, found = Powers(), [np.empty(0, np.uint64)]
        for _, data in _texts(table, limits):
            found.append(np.unique(anchors(data, powers, limits)[1]))
        marks, docs = np.unique(np.concatenate(found), return_counts=True)
        bucket = ((marks >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        marks, docs, bucket = marks[order], np.minimum(docs, 65535).astype("<u2")[order], bucket[order]
        chunk = key[0].as_py()
        return _blobs(_ANCHORS, [(b, chunk, marks[s].tobytes(), docs[s].tobytes()) for b, s in _split(bucket)])

    return run


def bucket_repeats(limits: RepeatLimits):
    """Tells every chunk which of its anchors occur in two documents or more."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunks = table.column("chunk").to_pylist()
        marks = [np.frombuffer(x, np.uint64) for x in table.column("marks").to_pylist()]
        docs = np.concatenate([np.frombuffer(x, "<u2") for x in table.column("docs").to_pylist()])
        owner = np.repeat(np.arange(len(chunks)), [len(x) for x in marks])
        marks = np.concatenate(marks)
        _, place = np.unique(marks, return_inverse=True)
        total = np.bincount(place, weights=docs)[place]
        use = total >= 2
        # Chosen once: a choice per chunk would take the chunks times the bucket's anchors.
        marks, hot = marks[use], total[use] > limits.hot
        rows = [(chunks[i], marks[s].tobytes(), hot[s].tobytes()) for i, s in _split(owner[use])]
        return _blobs(_REPEATS, rows)

    return run


def _suffixes(data: np.ndarray, repeated: np.ndarray, powers: Powers, limits: RepeatLimits):
    """Places of repeated anchors, their masks and surroundings.

    Bit o of a mask stands for the string that starts o bytes before the anchor: it is set if
    the anchor is the string's first least gram, so that each string goes with one anchor.
    """
    at, marks, least = anchors(data, powers, limits)
    w = limits.window
    known = np.searchsorted(repeated, marks)
    known[known == len(repeated)] = 0
    good = (repeated[known] == marks) if len(repeated) else np.zeros(len(marks), bool)
    if not good.any():
        return None
    before = np.full(len(at), -1)
    order = np.argsort(marks, kind="stable")
    twice = np.flatnonzero(marks[order][1:] == marks[order][:-1])
    before[order[twice + 1]] = at[order[twice]]
    at, marks, before = at[good], marks[good], before[good]
    starts = at[:, None] - np.arange(w)
    inside = (starts >= 0) & (starts < len(least)) & (starts > before[:, None])
    safe = np.where(inside, starts, 0)
    inside &= least[safe] == marks[:, None]
    masks = (inside.astype(np.uint64) << np.arange(w, dtype=np.uint64)).sum(1, dtype=np.uint64)
    use = masks != 0
    if not use.any():
        return None
    at, marks, masks = at[use], marks[use], masks[use]
    padded = np.zeros(len(data) + w - 1 + limits.length, np.uint8)
    padded[w - 1 : w - 1 + len(data)] = data
    bodies = np.lib.stride_tricks.sliding_window_view(padded, w - 1 + limits.length)[at]
    # Only what the strings of the mask cover is sent; the rest is blank and packs to nothing.
    inside, column = inside[use], np.arange(w - 1 + limits.length)
    farthest, nearest = w - 1 - inside[:, ::-1].argmax(1), inside.argmax(1)
    covered = (column >= w - 1 - farthest[:, None]) & (column < w - 1 - nearest[:, None] + limits.length)
    return at, marks, masks, np.where(covered, bodies, np.uint8(0))


def _whole_strings(at, masks, bodies, limits: RepeatLimits, powers: Powers):
    """The strings of hot anchors as suffixes of their own, with the string's hash as mark."""
    w = limits.window
    row, back = np.nonzero((masks[:, None] >> np.arange(w, dtype=np.uint64)) & np.uint64(1))
    first = (w - 1) - back
    whole = bodies[row[:, None], first[:, None] + np.arange(limits.length)]
    body = np.zeros((len(row), w - 1 + limits.length), np.uint8)
    body[:, w - 1 :] = whole
    return at[row] - back, stirred(prefix_hashes(whole, powers)[:, -1]), np.ones(len(row), np.uint64), body


def _packed(rows: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(rows).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    plain = pa.decompress(data, decompressed_size=rows * width, codec="zstd", asbytes=True)
    return np.frombuffer(plain, np.uint8).reshape(rows, width)


def chunk_suffixes(limits: RepeatLimits, buckets: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        chunk, powers = key[0].as_py(), Powers()
        if not table.num_rows or not told.num_rows:
            return _blobs(_SUFFIXES, [])
        repeated = np.concatenate([np.frombuffer(x, np.uint64) for x in told.column("marks").to_pylist()])
        hot = np.concatenate([np.frombuffer(x, bool) for x in told.column("hot").to_pylist()])
        order = np.argsort(repeated)
        repeated, hot = repeated[order], hot[order]
        parts = []
        long = [len(data) >= limits.length for data in table.column("data").to_pylist()]
        which = [part for part, use in zip(_parts(table), long) if use]
        for part, (doc, data) in zip(which, _texts(table, limits)):
            found = _suffixes(data, repeated, powers, limits)
            if found is None:
                continue
            at, marks, masks, bodies = found
            much = hot[np.searchsorted(repeated, marks)]
            kept = [(at[~much], marks[~much], masks[~much], bodies[~much])]
            if much.any():
                kept.append(_whole_strings(at[much], masks[much], bodies[much], limits, powers))
            parts += [(np.full(len(p[0]), doc, np.int64), p[0] + (part << 32), *p[1:]) for p in kept]
        if not parts:
            return _blobs(_SUFFIXES, [])
        docs, at, marks, masks, bodies = (np.concatenate(c) for c in zip(*parts))
        # Equal surroundings within the chunk: the earliest document speaks for all, and in
        # the others they are repeats already.
        whole = np.concatenate([bodies, masks[:, None].view(np.uint8).reshape(len(masks), 8)], axis=1)
        _, same = np.unique(np.ascontiguousarray(whole).view(f"V{whole.shape[1]}").ravel(), return_inverse=True)
        first = np.full(same.max() + 1, _NO_ID)
        np.minimum.at(first, same, docs)
        later = docs > first[same]
        rows = [(chunk % buckets, chunk, None, None, masks[later].tobytes(), docs[later].tobytes(), at[later].astype("<i8").tobytes())]
        sent = np.flatnonzero(~later)
        bucket = ((marks[sent] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sent, bucket = sent[order], bucket[order]
        for b, s in _split(bucket):
            i = sent[s]
            rows.append(
                (b, chunk, marks[i].tobytes(), _packed(bodies[i]), masks[i].tobytes(), docs[i].tobytes(), at[i].astype("<i8").tobytes())
            )
        return _blobs(_SUFFIXES, rows)

    return run


class Suffixes:
    """Rows of bytes to be ordered, with their prefix hashes."""

    def __init__(self, rows: np.ndarray, powers: Powers):
        self.rows, self.width = rows, rows.shape[1]
        self.prefix = prefix_hashes(rows, powers)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of rows i and j, by binary search over the hashes."""
        low, high = np.zeros(len(i), np.int64), np.full(len(i), self.width)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.prefix[i, mid] == self.prefix[j, mid]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        length = self.common(i, j)
        at = np.minimum(length, self.width - 1)
        return np.where(length == self.width, or_equal, self.rows[i, at] < self.rows[j, at])


def merge_sorted(suffixes: Suffixes, group: np.ndarray) -> np.ndarray:
    """Order of the rows within their groups; ``group`` is ascending.

    Bottom-up merge sort of all groups side by side: a row's place in a merged run is its
    place in its own run plus the number of rows of the other run before it, which binary
    search finds.
    """
    m = len(group)
    order, edges = np.arange(m), np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[edges, m])
    begin, end = np.repeat(edges, sizes), np.repeat(edges + sizes, sizes)
    width = 1
    while width < sizes.max():
        p = np.flatnonzero(end - begin > width)
        local = p - begin[p]
        pair = begin[p] + local // (2 * width) * (2 * width)
        middle = np.minimum(pair + width, end[p])
        on_left = p < middle
        low = np.where(on_left, middle, pair)
        high = np.where(on_left, np.minimum(pair + 2 * width, end[p]), middle)
        base = p - np.where(on_left, pair, middle) + pair - low
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            mid = (low[todo] + high[todo]) // 2
            smaller = suffixes.before(order[mid], order[p[todo]], ~on_left[todo])
            low[todo] = np.where(smaller, mid + 1, low[todo])
            high[todo] = np.where(smaller, high[todo], mid)
        merged = order.copy()
        merged[base + low] = order[p]
        order = merged
        width *= 2
    return order


def repeated_strings(marks, bodies, masks, docs, limits: RepeatLimits, powers: Powers) -> np.ndarray:
    """Bits of the masks whose string starts in a document with a smaller id, too."""
    w, length = limits.window, limits.length
    answer = np.zeros(len(marks), np.uint64)
    order = np.argsort(marks, kind="stable")
    _, group = np.unique(marks[order], return_inverse=True)
    suffixes = Suffixes(np.ascontiguousarray(bodies[order][:, w - 1 :]), powers)
    place = merge_sorted(suffixes, group)
    common = suffixes.common(place[:-1], place[1:])
    # Verification: the bytes must agree with what the hashes said.
    a, b = suffixes.rows[place[:-1]], suffixes.rows[place[1:]]
    differ = a != b
    true = np.where(differ.any(1), differ.argmax(1), length)
    same_group = group[1:] == group[:-1]
    at = np.minimum(true, length - 1)[:, None]
    rising = (np.take_along_axis(a, at, 1) <= np.take_along_axis(b, at, 1)).ravel()
    if not ((true == common) & rising)[same_group].all():
        place = np.lexsort((*suffixes.rows.T[::-1], group))
        differ = suffixes.rows[place[:-1]] != suffixes.rows[place[1:]]
        common = np.where(differ.any(1), differ.argmax(1), length)
    common = np.where(same_group, common, -1)
    order = order[place]
    bodies, masks, docs = bodies[order], masks[order], docs[order]
    left = prefix_hashes(bodies[:, : w - 1], powers)
    down = powers.to(length)[1]
    bits = np.zeros(len(order), np.uint64)
    for o in range(w):
        use = np.flatnonzero((masks >> np.uint64(o)) & np.uint64(1))
        if len(use) < 2:
            continue
        right = np.cumsum(np.r_[0, common < length - o])[use].astype(np.uint64)
        beside = (left[use, w - 1] - left[use, w - 1 - o]) * down[w - 1 - o]
        key = stirred(beside + right * np.uint64(_BASE))
        by_key = np.argsort(key, kind="stable")
        rows, ordered = use[by_key], key[by_key]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        strings = bodies[rows, w - 1 - o : w - 1 - o + length]
        if (~new[1:] & (strings[1:] != strings[:-1]).any(1)).any():
            _, exact = np.unique(np.ascontiguousarray(strings).view(f"V{length}").ravel(), return_inverse=True)
            by_string = np.argsort(exact, kind="stable")
            rows, exact = rows[by_string], exact[by_string]
            new = np.r_[True, exact[1:] != exact[:-1]]
        starts = np.flatnonzero(new)
        earliest = np.minimum.reduceat(docs[rows], starts)
        earlier = np.repeat(earliest, np.diff(np.r_[starts, len(rows)])) < docs[rows]
        bits[rows[earlier]] |= np.uint64(1 << o)
    answer[order] = bits
    return answer


def bucket_suffixes(limits: RepeatLimits, block: int = 40_000):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        powers, rows, parts = Powers(), [], []
        wide = limits.window - 1 + limits.length
        for row in table.to_pylist():
            if row["marks"] is None:
                rows.append((row["chunk"], row["docs"], row["places"], row["masks"]))
                continue
            marks = np.frombuffer(row["marks"], np.uint64)
            parts.append(
                (
                    np.full(len(marks), row["chunk"]), marks, _unpacked(row["bodies"], len(marks), wide),
                    np.frombuffer(row["masks"], np.uint64), np.frombuffer(row["docs"], np.int64),
                    np.frombuffer(row["places"], "<i8"),
                )
            )
        if not parts:
            return _blobs(_FOUND, rows)
        chunk, marks, bodies, masks, docs, places = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(marks, kind="stable")
        edges = np.flatnonzero(np.r_[True, marks[order][1:] != marks[order][:-1]])
        ends = np.r_[edges[1:], len(order)]
        lows, highs = np.minimum.reduceat(docs[order], edges), np.maximum.reduceat(docs[order], edges)
        worth = np.flatnonzero(lows < highs)
        answer, at = np.zeros(len(marks), np.uint64), 0
        while at < len(worth):  # blocks of whole groups
            total = np.cumsum((ends - edges)[worth[at:]])
            take = max(1, int(np.searchsorted(total, block, "right")))
            use = np.concatenate([order[edges[g] : ends[g]] for g in worth[at : at + take]])
            answer[use] = repeated_strings(marks[use], bodies[use], masks[use], docs[use], limits, powers)
            at += take
        found = np.flatnonzero(answer)
        found = found[np.argsort(chunk[found], kind="stable")]
        for c, s in _split(chunk[found]):
            i = found[s]
            rows.append((c, docs[i].tobytes(), places[i].tobytes(), answer[i].tobytes()))
        return _blobs(_FOUND, rows)

    return run


def chunk_kept(limits: RepeatLimits):
    """Documents of a chunk without the strings found, and the spans removed."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, found: pa.Table) -> pa.Table:
        columns = {
            name: np.concatenate([np.empty(0, kind), *[np.frombuffer(x, kind) for x in found.column(name).to_pylist()]])
            for name, kind in (("docs", np.int64), ("places", "<i8"), ("masks", np.uint64))
        }
        order = np.argsort(columns["docs"], kind="stable")
        docs, places, masks = (columns[n][order] for n in ("docs", "places", "masks"))
        rows = []
        rows_in = zip(table.column("doc").to_pylist(), table.column("data").to_pylist(), _parts(table))
        for doc, data, part in rows_in:
            a, b = np.searchsorted(docs, doc), np.searchsorted(docs, doc, "right")
            own = places[a:b] >> 32 == part
            spans, kept = [], data
            if own.any():
                place, mask = places[a:b][own] & 0xFFFFFFFF, masks[a:b][own]
                edge = np.zeros(len(data) + 1, np.int64)
                for o in range(limits.window):
                    starts = place[(mask >> np.uint64(o)) & np.uint64(1) != 0] - o
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + limits.length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                sides = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
                spans = [{"start": int(x), "stop": int(y)} for x, y in zip(sides[::2], sides[1::2])]
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            rows.append((doc, len(data), kept, spans))
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return _blobs([("doc", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()), ("spans", span)], rows)

    return run


KEPT = "doc long, n_bytes long, kept binary, spans array<struct<start:long,stop:long>>"


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", limits: RepeatLimits = RepeatLimits()
) -> DataFrame:
    """Per document ``doc``, ``n_bytes``, the bytes ``kept`` and the ``spans`` removed.

    A byte goes if it lies in a string of ``length`` bytes that also starts in a document
    with a smaller id; strings are those of the input. NULL is the empty text; texts shorter
    than ``length`` stay whole; repeated rows are one document in two rows; a NULL id counts
    as the largest and is given back as NULL; an empty table gives an empty result. Rows that
    share an id, or have none, are none earlier than the other, whatever their texts. Texts
    equal to an earlier one are settled by their digest and not searched.
    """
    if limits.window > 64:
        raise ValueError("a string may start at 64 places before an anchor at most")
    spark = bounded_batches(docs).sparkSession
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"),
    )
    narrow = rows.select(
        "doc", F.octet_length("data").cast("long").alias("n_bytes"), F.unhex(F.sha2("data", 256)).alias("digest"),
        F.xxhash64("data").alias("code"),
    ).filter(F.col("n_bytes") >= limits.length)
    narrow = stage(narrow, "text-digests")
    total = narrow.agg(F.sum("n_bytes")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(2 * parts, -(-total // limits.chunk_bytes))
    firsts = narrow.groupBy("digest").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = narrow.join(firsts, "digest").filter("doc > first").select("doc", "n_bytes", "code")
    copies = stage(copies, "text-copies")
    # By text as well as id: an id that many rows share is no crowded chunk.
    chunk = F.pmod(F.xxhash64("doc", "code"), F.lit(chunks)).cast("int")
    gone = copies.select("doc", "code").distinct().select(
        chunk.alias("c_chunk"), F.col("doc").alias("c_doc"), F.col("code").alias("c_code")
    )
    # The chunk is the only key Spark may join by: documents then move by chunk once, for
    # this join and everything below. Within a chunk, few rows are compared.
    same = F.col("chunk") == F.col("c_chunk")
    for a, b in (("doc", "c_doc"), ("code", "c_code")):
        same &= (F.col(a) <= F.col(b)) & (F.col(a) >= F.col(b))
    fresh = rows.withColumn("code", F.xxhash64("data")).select(chunk.alias("chunk"), "doc", "code", "data")
    fresh = fresh.join(gone, same, "left_anti").select("chunk", "doc", "data")

    by_chunk = fresh.groupBy("chunk")
    marks = by_chunk.applyInArrow(chunk_anchors(limits, chunks), _ddl(_ANCHORS))
    told = marks.groupBy("bucket").applyInArrow(bucket_repeats(limits), _ddl(_REPEATS))
    around = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(chunk_suffixes(limits, chunks), _ddl(_SUFFIXES))
    found = around.groupBy("bucket").applyInArrow(bucket_suffixes(limits), _ddl(_FOUND))
    kept = by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(chunk_kept(limits), KEPT)

    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    settled = copies.select("doc", "n_bytes", F.lit(b"").alias("kept"), whole.alias("spans"))
    every = kept.unionByName(settled)
    return every.withColumn("doc", F.when(F.col("doc") != _NO_ID, F.col("doc")))


def repeat_digest(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return remove_repeats(docs).select(
        F.col("doc").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
