"""Exact Jaccard self-join of documents on word n-grams by token-combination prefixes.

A document is the set of its distinct shingles ("tokens"). All documents order tokens alike:
rare ones first, then frequent, then very frequent ones. Two sets that are similar enough
must share many tokens, so their prefixes in this order must share some. Rare tokens are
indexed one by one. A frequent token says little, so prefixes are extended and tokens of a
frequent class are indexed in combinations of two or three: two prefixes that share no
combination share at most one (or two) tokens of that class, which the extension makes up
for. Candidates are verified on the whole sets.

How frequent a token is comes from counters over all documents, hashed into a table of fixed
size; which class a token falls into affects speed, never the result. Tokens are 64-bit
hashes of shingles, sets are equal if 128-bit digests of them are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from newstide.llm.common import bounded_batches, private, row_batches
from newstide.llm.links import components
from newstide.workspace import stage

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)
_BLOCK = 1 << 14  # counters per block of the table
_SMALL = 64  # sets below this size are indexed by single tokens only
_NAMES = 1 << 20  # words whose hashes a task remembers


@dataclass(frozen=True)
class JoinLimits:
    """Similarity ``num/den``, words per shingle, size of the counter table (2**table).

    Marks of up to ``few`` nodes are joined pair by pair, larger ones in cells of two blocks
    of ``cell`` nodes each; both compare all pairs."""

    words: int = 4
    num: int = 85
    den: int = 100
    table: int = 24
    few: int = 32
    cell: int = 1024

    def need(self, n: int) -> int:
        """Tokens of a set of n of which a similar set must hold at least one."""
        return n + (-self.num * n // self.den) + 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _NAMES:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def token_set(text: str | None, names: WordHashes, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes; A-Z are lower-cased, words end at ASCII white space."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(names.__getitem__, found), np.uint64, n)
    if n < words:
        whole = _ODD[4:] * np.uint64(n)
        for i in range(n):
            whole = whole + hashes[i : i + 1] * _ODD[i]
        return mixed(whole)
    total = hashes[: n - words + 1] * _ODD[0]
    for i in range(1, words):
        total = total + hashes[i : n - words + 1 + i] * _ODD[i]
    return np.unique(mixed(total))


def count_table(docs: DataFrame, text: str, limits: JoinLimits) -> DataFrame:
    """(block, counts, total): how often tokens fall on each counter, over all documents."""
    blocks = (1 << limits.table) // _BLOCK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, shift = WordHashes(), np.uint64(64 - limits.table)
        table = np.zeros(1 << limits.table, np.uint32)
        for batch in row_batches(batches):
            sets = [token_set(x, names, limits.words) for x in batch.column(0).to_pylist()]
            np.add.at(table, (np.concatenate(sets) >> shift).astype(np.int64), 1)
        table = np.minimum(table, 255).astype(np.uint8).reshape(blocks, _BLOCK)
        for first in range(0, blocks, 64):
            part = [x.tobytes() for x in table[first : first + 64]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(first, first + len(part)), pa.int32()), pa.array(part, pa.binary())],
                ["block", "counts"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = np.frombuffer(counts, np.uint8)
                sums[block] = sums[block] + row if block in sums else row.astype(np.uint32)
        for block, row in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int32()),
                    pa.array([row.astype("<u4").tobytes()], pa.binary()),
                    pa.array([int(row.sum())], pa.int64()),
                ],
                ["block", "counts", "total"],
            )

    partial = docs.select(text).mapInArrow(count, "block int, counts binary").repartition("block")
    return stage(partial.mapInArrow(add, "block int, counts binary, total long"), "token-counts")


def frequent_tokens(counted: DataFrame, limits: JoinLimits) -> tuple[np.ndarray, np.ndarray]:
    """Bit per counter: frequent, very frequent. 2 * 2**table bits, whatever the input."""
    total = counted.agg(F.sum("total")).first()[0] or 0
    mean = total / (1 << limits.table)
    # Counters are shared; what stands out from the mean by chance is not frequent.
    least, most = mean + 5 * mean**0.5 + 8, 4 * mean + 10 * mean**0.5 + 64

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(x, "<u4") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([np.packbits(r > least).tobytes() for r in rows], pa.binary()),
                    pa.array([np.packbits(r > most).tobytes() for r in rows], pa.binary()),
                ],
                ["block", "some", "much"],
            )

    found = counted.select("block", "counts").mapInArrow(judge, "block int, some binary, much binary")
    bits = np.zeros((2, (1 << limits.table) // _BLOCK, _BLOCK // 8), np.uint8)
    for row in found.collect():
        bits[0, row["block"]] = np.frombuffer(row["some"], np.uint8)
        bits[1, row["block"]] = np.frombuffer(row["much"], np.uint8)
    return bits[0].ravel(), bits[1].ravel()


def _bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1


def signatures(tokens: np.ndarray, classes: np.ndarray, limits: JoinLimits) -> np.ndarray:
    """What a set is indexed under: every similar set shares at least one of these.

    Let a prefix hold n_g tokens of group g, whose combinations have k_g tokens. Two prefixes
    without a common combination share at most sum of min(n_g, k_g - 1) tokens. It is cut
    where the other tokens, sum of max(0, n_g - k_g + 1), reach ``need``. Rare tokens have
    k = 1; frequent and very frequent ones fall into groups by hash, with k = 2 and 3. Size
    bands fix the number of groups, so that the allowance never exceeds what a set can
    spare; a set whose similar sets may lie in the band below is indexed there as well.
    """
    n = len(tokens)
    need = limits.need(n)
    order = np.argsort(classes, kind="stable")  # tokens come sorted
    tokens, classes = tokens[order], classes[order]
    rare = int((classes == 0).sum())
    band = -1 if n < _SMALL else int(np.log2(n / _SMALL) // 2)
    low = _SMALL * 4**band if band >= 0 else 0
    bands = [band, band - 1] if band >= 0 and -(-limits.num * n // limits.den) < low else [band]
    out = []
    for b in bands:
        salt = _ODD[3:4] * np.uint64(2 * b + 3)
        if b < 0 or rare >= need:
            out.append(mixed(tokens[:need] ^ salt))
            continue
        out.append(mixed(tokens[:rare] ^ salt))
        groups, covered, members = 16 * 4**b, rare, {}
        for token, kind in zip(tokens[rare:].tolist(), classes[rare:].tolist()):
            if covered >= need:
                break
            group = members.setdefault((kind, (token >> 20) % groups), [])
            group.append(token)
            covered += len(group) > kind
        combined = [
            sum(part) % (1 << 64)
            for (kind, _), group in members.items()
            for part in combinations([t * (2 * kind + 1) for t in group], kind + 1)
        ]
        out.append(mixed(np.array(combined, np.uint64) ^ (salt + np.uint64(1))))
    return np.unique(np.concatenate(out))


def histogram(tokens: np.ndarray) -> np.ndarray:
    """Tokens per range of hashes: the overlap is at most the sum of the lesser counts."""
    bits = 6 if len(tokens) < 2048 else 8 if len(tokens) < 16384 else 10
    return np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def overlap_bound(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    if len(x) > len(y):
        x, y = y, x
    return int(np.minimum(x, y.reshape(len(x), -1).sum(1)).sum())


def indexed_sets(docs: DataFrame, key: str, text: str, limits: JoinLimits) -> DataFrame:
    """Per document: ``doc``, ``digest`` of its set, ``n``, histogram and signatures."""
    some, much = frequent_tokens(count_table(docs, text, limits), limits)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, shift = WordHashes(), np.uint64(64 - limits.table)
        for batch in row_batches(batches):
            rows = []
            for value in batch.column(1).to_pylist():
                tokens = token_set(value, names, limits.words)
                if not len(tokens):
                    rows.append((None, 0, None, None))
                    continue
                at = (tokens >> shift).astype(np.int64)
                classes = _bit(some, at) + _bit(much, at)
                marks = signatures(tokens, classes, limits).view(np.int64)
                digest = hashlib.md5(tokens.tobytes(), usedforsecurity=False).digest()
                rows.append((digest, len(tokens), histogram(tokens).astype("<u4").tobytes(), marks))
            kinds = [pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc", "digest", "n", "hist", "marks"]
            )

    shape = "doc long, digest binary, n long, hist binary, marks array<long>"
    narrow = docs.select(F.col(key).cast("long").alias("doc"), text)
    return stage(narrow.mapInArrow(index, shape), "token-sets")


def shared_marks(nodes: DataFrame) -> DataFrame:
    """(mark, node, n, first, last) for marks of two nodes or more, streamed in mark order."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, of which it is not known yet whether it is alone
        for batch in batches:
            if not batch.num_rows:
                continue
            mark, node, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:3])
            if held is not None:
                mark, node, n = (np.concatenate([[h], c]) for h, c in zip(held[:3], (mark, node, n)))
            same = mark[1:] == mark[:-1]
            first = held is not None and held[3]
            use = np.concatenate([[first], same])
            use[:-1] |= same
            held = (mark[-1], node[-1], n[-1], bool(use[-1]))
            use = use[:-1]
            if use.any():
                yield _marks(mark[:-1][use], node[:-1][use], n[:-1][use])
        if held is not None and held[3]:
            yield _marks(*([v] for v in held[:3]))

    rows = nodes.select(F.explode("marks").alias("mark"), "node", "n")
    rows = rows.repartition("mark").sortWithinPartitions("mark", "node")
    return stage(rows.mapInArrow(keep, "mark long, node long, n long"), "shared-marks")


def _marks(mark, node, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (mark, node, n)], ["mark", "node", "n"])


def sizes_fit(limits: JoinLimits, a: str, b: str):
    return F.least(a, b) * limits.den >= F.greatest(a, b) * limits.num


def candidate_sets(wanted: DataFrame, docs: DataFrame, key: str, text: str, limits: JoinLimits) -> DataFrame:
    """(node, tokens) of the wanted nodes, built again from the texts.

    A bitmap of fixed size over the ids picks the texts out where they are read; what it
    lets through by chance goes in the join.
    """
    wanted, bits = wanted.distinct(), 23
    spot = F.pmod(F.xxhash64("node"), F.lit(1 << bits))
    chunks = (
        wanted.groupBy(F.bitmap_bucket_number(spot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bitmap"))
        .collect()
    )
    bitmap = {r["bucket"]: bytes(r["bitmap"]) for r in chunks}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordHashes()
        for batch in row_batches(batches):
            spots = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            use = [b in bitmap and bool(bitmap[b][p >> 3] >> (p & 7) & 1) for b, p in spots]
            chosen = batch.filter(pa.array(use, pa.bool_()))
            sets = [token_set(x, names, limits.words).tobytes() for x in chosen.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([chosen.column(0), pa.array(sets, pa.binary())], ["node", "tokens"])

    at = docs.select(F.col(key).cast("long").alias("node"), text).select(
        "node", F.bitmap_bucket_number(spot).alias("bucket"), F.bitmap_bit_position(spot).alias("place"), text
    )
    sets = at.mapInArrow(build, "node long, tokens binary").join(wanted, "node").dropDuplicates(["node", "tokens"])
    return stage(sets, "candidate-sets")


def enough(limits: JoinLimits, n_a: int, n_b: int, overlap: int) -> bool:
    return limits.den * overlap >= limits.num * (n_a + n_b - overlap)


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, limits: JoinLimits) -> DataFrame:
    """The pairs (a, b) that are similar indeed.

    Histograms bound the overlap and dismiss most false candidates; for the rest whole sets
    are compared.
    """
    hists = nodes.select("node", "n", "hist")
    left, right = (hists.select(*[F.col(c).alias(f"{c}_{s}") for c in hists.columns]) for s in "ab")
    met = pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
    met = met.select("a", "b", "n_a", "n_b", "hist_a", "hist_b")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            use = [enough(limits, n, m, overlap_bound(x, y)) for n, m, x, y in zip(*columns[2:])]
            yield batch.select(["a", "b"]).filter(pa.array(use, pa.bool_()))

    likely = stage(met.mapInArrow(bound, "a long, b long"), "likely-pairs")
    sets = candidate_sets(likely.select(F.explode(F.array("a", "b")).alias("node")), docs, key, text, limits)
    left, right = (sets.select(F.col("node").alias(f"node_{s}"), F.col("tokens").alias(f"tokens_{s}")) for s in "ab")
    whole = likely.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches, 64):
            use = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                use.append(enough(limits, len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
            yield batch.select(["a", "b"]).filter(pa.array(use, pa.bool_()))

    return stage(
        whole.select("a", "b", "tokens_a", "tokens_b").mapInArrow(compare, "a long, b long"), "similar-pairs"
    )


def first_pairs(marks: DataFrame, limits: JoinLimits) -> DataFrame:
    """Each node with the first and the last node of every mark it shares: no more pairs
    than rows, and enough to bring most groups of near copies together."""
    ends = marks.groupBy("mark").agg(
        F.min(F.struct("node", "n")).alias("x"), F.max(F.struct("node", "n")).alias("y")
    )
    met = marks.join(ends, "mark").select("node", "n", F.explode(F.array("x", "y")).alias("end"))
    fit = met.filter("node <> end.node").filter(sizes_fit(limits, "n", "end.n"))
    return fit.select(
        F.least("node", "end.node").alias("a"), F.greatest("node", "end.node").alias("b")
    ).distinct()


def open_marks(marks: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of marks whose nodes are not all in one component yet, with component c."""
    placed = marks.join(known, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    unsettled = (
        placed.groupBy("mark")
        .agg(F.count(F.lit(1)).alias("size"), F.min("c").alias("least"), F.max("c").alias("most"))
        .filter("least <> most")
        .select("mark", "size")
    )
    return stage(placed.join(unsettled, "mark"), "open-marks")


def other_pairs(rows: DataFrame, limits: JoinLimits) -> DataFrame:
    """All pairs that share a mark of few nodes and are in different components."""
    one = rows.select("mark", *[F.col(x).alias(f"{x}_1") for x in ("node", "n", "c")])
    two = rows.select("mark", *[F.col(x).alias(f"{x}_2") for x in ("node", "n", "c")])
    return (
        one.join(two, "mark")
        .filter("node_1 < node_2 AND c_1 <> c_2")
        .filter(sizes_fit(limits, "n_1", "n_2"))
        .select(F.col("node_1").alias("a"), F.col("node_2").alias("b"))
        .distinct()
    )


def shared_tokens(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices, some columns at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1
    number = np.cumsum(common) - 1
    use = common[token]
    token, owner = number[token[use]], owner[use]
    total = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    for first in range(0, int(common.sum()), columns):
        part = slice(*np.searchsorted(token, [first, first + columns]))
        matrix = np.zeros((len(sets), columns), np.float32)
        matrix[owner[part], token[part] - first] = 1
        total += matrix @ matrix.T
    return total.astype(np.int64)


def cell_links(rows: DataFrame, docs: DataFrame, key: str, text: str, limits: JoinLimits) -> DataFrame:
    """Links (a, b) that connect what is similar among the nodes of marks with many nodes.

    A mark's nodes are split into blocks of about ``cell`` nodes, and every two blocks meet
    in a cell of their own, with their sets: no task holds more than two blocks, and all
    pairs are compared inside, none is made a row. A cell gives each node it has connected a
    link to one node of the same component.
    """
    sets = candidate_sets(rows.select("node"), docs, key, text, limits)
    blocks = F.ceil(F.col("size") / limits.cell).cast("int")
    cells = rows.select("mark", "node", "c", blocks.alias("blocks"))
    cells = cells.withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select(
        "mark", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "c"
    ).join(sets, "node")
    cells = cells.select("mark", "i", "j", "block", "node", "c", "tokens")

    def links(held: list[tuple]) -> list[tuple[int, int]]:
        _, i, j, block, node, c, tokens = (np.array(x, object) for x in zip(*held))
        found = [np.frombuffer(t, np.uint64) for t in tokens]
        size = np.array([len(x) for x in found])
        inter = shared_tokens(found)
        near = limits.den * inter >= limits.num * (size[:, None] + size - inter)
        if i[0] != j[0]:
            near &= block[:, None] != block
        _, first, label = np.unique(c.astype(np.int64), return_index=True, return_inverse=True)
        a, b = np.nonzero(near)
        known = label
        while True:
            lower = known.copy()
            np.minimum.at(lower, a, known[b])
            root = np.full(len(first), len(first))
            np.minimum.at(root, label, lower)  # nodes of one component move together
            lower = np.minimum(lower, root[label])
            if (lower == known).all():
                break
            known = lower
        moved = np.flatnonzero(known != label)
        return [(int(node[x]), int(node[first[known[x]]])) for x in moved]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in row_batches(batches):
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and held[-1][:3] != row[:3]:
                    out += links(held)
                    held = []
                held.append(row)
            yield _pairs(out)
        yield _pairs(links(held) if held else [])

    placed = cells.repartition("mark", "i", "j").sortWithinPartitions("mark", "i", "j")
    return stage(placed.mapInArrow(compare, "a long, b long"), "cell-links")


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows) if rows else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (list(a), list(b))], ["a", "b"])


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", limits: JoinLimits = JoinLimits()
) -> DataFrame:
    """Per document ``doc``, ``n_shingles`` and ``component_id``: the least id it reaches by
    links, itself included. Two documents link when the Jaccard similarity of their sets is
    at least ``num/den``.

    NULL and wordless texts have an empty set and link with nothing. Fewer words than a
    shingle are one shingle. Documents with equal sets meet once, as a node named by their
    least id. Repeated rows give equal rows, of rows that share an id each goes by its own
    text, and one whose id is NULL gets the component of those it equals, if any. Empty
    tables give empty results.
    """
    docs = bounded_batches(docs)
    sets = indexed_sets(docs, key, text, limits)
    nodes = stage(
        sets.filter("n > 0 AND doc IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc").alias("node"), F.first("n").alias("n"), F.first("hist").alias("hist"), F.first("marks").alias("marks")),
        "token-nodes",
    )
    marks = shared_marks(nodes)
    first = stage(first_pairs(marks, limits), "first-pairs")
    links = verified(first, nodes, docs, key, text, limits)
    known = components(links)
    rest = open_marks(marks, known)
    few = other_pairs(rest.filter(F.col("size") <= limits.few), limits).join(first, ["a", "b"], "left_anti")
    more = verified(few, nodes, docs, key, text, limits)
    many = cell_links(rest.filter(F.col("size") > limits.few), docs, key, text, limits)
    final = components(links.union(more).union(many), "all-links")
    named = sets.select("doc", "n", "digest").join(nodes.select("digest", "node"), "digest", "left")
    named = named.join(final, "node", "left").select(
        "doc", "n", F.coalesce("component", "node", "doc").alias("component_id")
    )
    return named.select("doc", F.col("n").alias("n_shingles"), "component_id")


def join_digest(docs: DataFrame) -> DataFrame:
    return similar_groups(docs).withColumnRenamed("doc", "doc_id")


def one_of_each(docs: DataFrame, limits: JoinLimits = JoinLimits(words=5, num=80)) -> DataFrame:
    """Documents without those that repeat another: of each group the least id stays, once.

    Rows are told apart by a number of their own, so that rows sharing an id, or having none,
    stand for themselves: NULL ids count as the largest, ties go to the earlier row.
    """
    row, group = private("row"), private("group")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    groups = similar_groups(numbered.select(row, "text"), key=row, limits=limits)
    groups = groups.select(F.col("doc").alias(row), F.col("component_id").alias(group))
    ids = numbered.select(row, F.col("doc_id").alias("id")).join(groups, row)
    least = ids.groupBy(group).agg(F.min(F.struct(F.col("id").isNull(), "id", row))[row].alias(row), F.count(F.lit(1)).alias("n"))
    # Groups of one, most of them, take no part in the join that removes.
    many = stage(least.filter("n > 1").select(group, F.col(row).alias("kept")), "kept-rows")
    gone = stage(ids.join(many, group).filter(F.col(row) != F.col("kept")).select(row), "near-copies-gone")
    return numbered.join(gone, row, "left_anti").drop(row)
