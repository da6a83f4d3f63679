"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are short, documents may be long, so Jaccard similarity says little; what counts is
which share of an item's shingles a document contains. An item is represented by its k least
shingles under a random order (a bottom-k MinHash sketch). A document that contains the share
t of n shingles lacks at most n - ceil(t n) of them; with k one more than that, it must hold
some of the k, so no document is missed whatever its length. Documents and items are
partitioned by size: an item is not sought in partitions whose documents are all too short.
What is found is verified by exact containment of the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newstide.workspace import stage

NOT_WORD = r"[^\p{L}\p{N}]+"
SEED = 20


def normal_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != F.lit(""))


def shingle_texts(words: Column, n: int) -> Column:
    """Distinct n-word shingles; of fewer words, the whole sequence as one; of none, none."""
    size = F.size(words)
    each = F.transform(
        F.sequence(F.lit(0), size - n), lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)])
    )
    whole = F.filter(F.array(F.array_join(words, " ")), lambda x: x != F.lit(""))
    return F.when(size >= n, F.array_distinct(each)).otherwise(whole)


def shingle_hashes(words: Column, n: int) -> Column:
    """Hashes of the shingles, repeats kept; those of :func:`shingle_texts`, hashed."""
    size = F.size(words)
    each = F.transform(
        F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)])
    )
    whole = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.when(size >= n, each).when(size > 0, whole)


def _need(size: Column, share: float) -> Column:
    return F.ceil(size * F.lit(float(share)) - F.lit(1e-9)).cast("int")


def _class(size: Column) -> Column:
    """Size partition: sizes from 2**c to 2**(c+1) - 1 share a class. Never NULL, so that no
    join tests it for that before the scan, where it would cost as much as the search."""
    return F.coalesce(F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int"), F.lit(0))


def sketches(items: DataFrame, n: int, share: float) -> DataFrame:
    """The search index: (hash, item, least_class), the bottom-k sketch of every item."""
    words = items.select(F.col("item_id").alias("item"), normal_words(F.col("text")).alias("words"))
    hashes = F.array_distinct(shingle_hashes(F.col("words"), n))
    rows = words.select("item", hashes.alias("h"))
    need = _need(F.size("h"), share)
    order = F.array_sort(F.transform("h", lambda x: F.struct(F.xxhash64(x, F.lit(SEED)), x.alias("hash"))))
    least = F.slice(order, 1, F.size("h") - need + 1)
    return rows.select(
        F.explode_outer(F.transform(least, lambda x: x["hash"])).alias("hash"),
        "item",
        _class(need).alias("least_class"),
    ).filter("hash IS NOT NULL").distinct()


def find_leaks(docs: DataFrame, items: DataFrame, n: int = 5, share: float = 0.8) -> DataFrame:
    """(doc_id, _digest, item_id, item_shingles, shared) for every contained item.

    An item is contained if the document has at least ``share`` of its distinct n-word
    shingles. Words are lower-case runs of letters and digits. NULL or wordless items and
    documents match nothing; a text of fewer than n words is one shingle, and matches only
    such; repeated rows and ties give one row per (document, item); empty tables give none.
    Only the hashes of a document's shingles meet the index; the index, a few rows per item,
    is broadcast or shuffled by its measured size, and so are the pairs found.
    """
    # Words are a column of their own: inside the shingle expressions they would be split
    # again for every shingle. The outer explode keeps the optimizer from testing the size of
    # the array beforehand, which would do just that.
    marked = docs.select(
        "doc_id", F.xxhash64("text").alias("_digest"), normal_words(F.col("text")).alias("words")
    )
    index = stage(sketches(items, n, share), "leak-index")
    probes = marked.select("doc_id", "_digest", shingle_hashes(F.col("words"), n).alias("h")).select(
        "doc_id", "_digest", _class(F.size("h")).alias("size_class"), F.explode_outer("h").alias("hash"))
    pairs = (
        probes.join(index, "hash")
        .filter(F.col("size_class") >= F.col("least_class"))
        .groupBy("doc_id", "_digest", "item")
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    pairs = stage(pairs.select(F.col("doc_id").alias("d"), F.col("_digest").alias("g"), "item"), "leak-pairs")

    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("_digest") == F.col("g"))
    whole = items.select(F.col("item_id").alias("i"), normal_words(F.col("text")).alias("words"))
    whole = whole.select("i", shingle_texts(F.col("words"), n).alias("item_texts"))
    met = (
        marked.join(pairs.groupBy("d", "g").agg(F.collect_set("item").alias("found")), same)
        .select("doc_id", "_digest", "found", shingle_texts(F.col("words"), n).alias("doc_texts"))
        .select("doc_id", "_digest", "doc_texts", F.explode("found").alias("item"))
        .join(whole, F.col("item").eqNullSafe(F.col("i")))
    )
    shared = F.size(F.array_intersect("item_texts", "doc_texts"))
    return (
        met.select(
            "doc_id", "_digest", F.col("item").alias("item_id"),
            F.size("item_texts").alias("item_shingles"), shared.alias("shared"),
        )
        .filter(F.col("shared") >= _need(F.col("item_shingles"), share))
        .distinct()
    )


def leak_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return find_leaks(docs, items).select("doc_id", "item_id", "item_shingles", "shared")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that contain no item; input columns only."""
    leaks = stage(
        find_leaks(docs, items).select(F.col("doc_id").alias("_leak_id"), F.col("_digest").alias("_leak_digest")).distinct(),
        "leaks",
    )
    same = F.col("doc_id").eqNullSafe(F.col("_leak_id")) & (F.xxhash64("text") == F.col("_leak_digest"))
    return docs.join(leaks, same, "left_anti")
