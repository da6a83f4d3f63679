"""Join articles with every dictionary entry their text contains.

``contains`` offers no key to hash on. Three exact plans are used. The first two broadcast
the dictionary, which is measured before, and shuffle no article that comes in enough splits:

* few entries: broadcast the dictionary and test each pair (nested loop). Beyond some entries a
  bitmap of each text's n-grams is made first, and a pair is tested by the bits of the needle's
  n-grams before its text is searched;
* many entries: every needle is filed under its n-gram of up to 8 bytes at the start, and the
  n-grams of an article at all its places probe the broadcast needles, in batches of rows
  (:mod:`newstide.operators.substrings`). What follows the n-gram is compared where it was
  found, so no text is searched again for each needle that might be in it.

* a dictionary too large to broadcast: an inverted index, shuffled. An entry is filed under the
  n-gram of it, or k n-grams in a row, that the fewest others share; of a text those at all, or
  every k-th, places are listed that pass a filter of what is filed, which is broadcast and
  bounded in size. Both sides meet by n-gram, and the articles, written once with a row number,
  meet the list of their candidates by that number; a batch of them is searched for the
  candidates of its rows. The articles are read once whatever the dictionary. An n-gram in most
  texts is spread over several partitions by row number, and no article key can be crowded.

All search distinct needles; entries that share one meet what was found afterwards. A field
that lies within another one of its article, such as a title the text begins with, is not
searched by itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from newstide.operators.substrings import (
    CodeFilter,
    Lookup,
    bitmap_sizes,
    gram_code,
    may_hold,
    probes,
    with_anchors,
    with_bitmap,
    with_labels,
    with_listed,
)
from newstide.workspace import stage


@dataclass(frozen=True)
class ContainsLimits:
    gram: int = 8  # bytes a needle is filed under at most, 8 at most
    nested_loop_entries: int = 32
    plain_entries: int = 32  # needles up to which a nested loop that is forced takes no bitmaps
    broadcast_bytes: int = 64 << 20
    row_overhead_bytes: int = 120
    # For the shuffled index: entries of at least so many bytes are filed under n-grams of so
    # many, of which texts list those at every so-manieth place that pass the filter.
    classes: tuple[tuple[int, int, int], ...] = tuple((n, n, 1) for n in range(8, 0, -1))
    filter_bits_per_code: int = 64
    most_filter_bytes: int = 16 << 20
    # An n-gram found in every text is about this share of all n-grams listed.
    grams_per_text: int = 256


DEFAULTS = ContainsLimits()

_NEEDLE, _ANCHOR, _ENTRY, _ROW, _SALT, _KIND = "_needle", "_anchor", "_entry", "_row", "_salt", "_kind"


def _class_of(length: Column, classes: tuple[tuple[int, int, int], ...]) -> Column:
    """Index of the class an entry of a length belongs to."""
    chosen = F.lit(len(classes) - 1)
    for i in reversed(range(len(classes) - 1)):
        chosen = F.when(length >= classes[i][0], F.lit(i)).otherwise(chosen)
    return chosen


def _filed(needles: DataFrame, kinds: list[int], limits: ContainsLimits) -> DataFrame:
    """Needles with ``_anchor``, a row per n-gram each is filed under.

    Of the places in a needle where k n-grams in a row can start, the one is taken whose most
    shared n-gram is shared by the fewest needles.
    """
    needle, parts = F.col(_NEEDLE), []
    for kind in kinds:
        _, gram, _ = limits.classes[kind]
        starts = F.sequence(F.lit(1), F.octet_length(needle) - gram + 1)
        parts.append(
            needles.filter(F.col(_KIND) == kind).select(_NEEDLE, _KIND)
            .select("*", F.posexplode(starts).alias("_at", "_start"))
            .select(_NEEDLE, _KIND, "_at", gram_code(needle, F.col("_start"), min(gram, 8)).alias(_ANCHOR))
        )
    pieces = reduce(DataFrame.union, parts)
    shared = pieces.select(_NEEDLE, _ANCHOR).distinct().groupBy(_ANCHOR).agg(F.count(F.lit(1)).alias("_n"))
    # A needle's own n-grams, as many as it has bytes.
    spelled = (
        pieces.join(shared, _ANCHOR)
        .groupBy(_NEEDLE, _KIND)
        .agg(F.array_sort(F.collect_list(F.struct("_at", "_n", _ANCHOR))).alias("_grams"))
    )
    step = F.element_at(F.array(*[F.lit(c[2]) for c in limits.classes]), F.col(_KIND) + 1)
    runs = F.transform(
        F.sequence(F.lit(1), F.size("_grams") - step + 1),
        lambda i: F.struct(
            F.array_max(F.transform(F.slice("_grams", i, step), lambda g: g["_n"])).alias("most"), i.alias("from")
        ),
    )
    best = spelled.select(_NEEDLE, _KIND, "_grams", F.array_min(runs)["from"].alias("_from"))
    return best.select(
        _NEEDLE, F.explode(F.array_distinct(F.transform(F.slice("_grams", F.col("_from"), step), lambda g: g[_ANCHOR]))).alias(_ANCHOR)
    )


def _code_filter(filed: DataFrame, limits: ContainsLimits) -> CodeFilter:
    """The filter of the codes filed, made by partial bitmaps."""
    bits, width = 1 << 15, 1 << 15  # width: bits that one bitmap_construct_agg holds
    while bits < limits.filter_bits_per_code * filed.count() and bits < 8 * limits.most_filter_bytes:
        bits *= 2
    place = F.col(_ANCHOR).bitwiseAND(F.lit(bits - 1))
    places = filed.select(F.floor(place / width).cast("int").alias("row"), (place % width).alias("bit"))
    held = places.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    return CodeFilter(bits, [(r["row"], bytes(r["bits"])) for r in held], width)


def _texts(fields: list[str]) -> Column:
    """The lower-cased fields as an array, without those that lie within another one."""
    lowered = [F.lower(F.coalesce(F.col(f), F.lit(""))) for f in fields]
    longest_first = F.array_sort(
        F.array_distinct(F.array(*lowered)), lambda a, b: F.octet_length(b) - F.octet_length(a)
    )
    return F.aggregate(
        longest_first,
        F.array().cast("array<string>"),
        lambda kept, x: F.when(F.exists(kept, lambda k: k.contains(x)), kept).otherwise(F.concat(kept, F.array(x))),
    )


def _join_by_shuffle(
    articles: DataFrame, needles: DataFrame, fields: list[str], lengths: list[int], kept: list[str], limits: ContainsLimits
) -> DataFrame:
    """Distinct needles and the articles they lie in: the columns ``kept`` and ``_needle``."""
    spark, classes = articles.sparkSession, limits.classes
    salts = 1 + int(spark.conf.get("spark.sql.shuffle.partitions")) // limits.grams_per_text
    kinds = sorted({next((i for i, c in enumerate(classes) if n >= c[0]), len(classes) - 1) for n in lengths})
    if not kinds:  # an empty dictionary
        return articles.limit(0).crossJoin(needles.limit(0)).select(*kept, _NEEDLE)
    needles = needles.withColumn(_KIND, _class_of(F.octet_length(_NEEDLE), classes))
    filed = stage(_filed(needles, kinds, limits), "filed")
    numbered = stage(articles.withColumn(_ROW, F.monotonically_increasing_id()), "articles")
    texts = numbered.select(_ROW, _texts(fields).alias("_texts"))
    listed = with_anchors(
        texts, "_texts", [(min(classes[i][1], 8), classes[i][2]) for i in kinds], _code_filter(filed, limits), "_anchors"
    )
    # The outer form spares the optimizer's size test, which would search twice.
    grams = listed.select(
        _ROW, F.pmod(F.col(_ROW), F.lit(salts)).cast("int").alias(_SALT), F.explode_outer("_anchors").alias(_ANCHOR)
    ).filter(F.col(_ANCHOR).isNotNull())
    filed = filed.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    candidates = grams.join(filed, [_ANCHOR, _SALT]).groupBy(_ROW).agg(F.collect_set(_NEEDLE).alias("_listed"))
    met = numbered.join(candidates, _ROW).select(*kept, _texts(fields).alias("_texts"), "_listed")
    found = with_listed(met, "_texts", "_listed", "_found")
    return found.select(*kept, F.explode_outer("_found").alias(_NEEDLE)).filter(F.col(_NEEDLE).isNotNull())


def contains_join(
    articles: DataFrame,
    dictionary: DataFrame,
    fields: list[str],
    needle: str,
    limits: ContainsLimits = DEFAULTS,
    plan: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Inner join on "some field contains the needle", ignoring case.

    Gives all columns of both sides, or of the articles those in ``keep`` only, one row per
    (article, dictionary row). NULL and empty needles match nothing. ``plan`` may force
    ``"nested_loop"``, ``"grams"`` or ``"shuffle"``; without it the dictionary's rows and bytes
    decide.
    """
    wanted = F.lower(F.col(needle))
    entries = stage(
        dictionary.filter(F.length(wanted) > 0).withColumn(_NEEDLE, wanted), "dictionary"
    )
    row_bytes = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in entries.columns],
    ) + F.lit(limits.row_overhead_bytes)
    most = max(8, *[c[0] for c in limits.classes])
    measured = entries.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes"),
        F.count_distinct(_NEEDLE).alias("needles"),
        F.collect_set(F.least(F.octet_length(_NEEDLE), F.lit(most))).alias("lengths"),
    ).first()

    kept = articles.columns if keep is None else keep
    output = kept + dictionary.columns
    if plan is None:
        plan = "nested_loop" if measured["rows"] <= limits.nested_loop_entries else "grams"
        plan = plan if measured["bytes"] <= limits.broadcast_bytes else "shuffle"
    shared = measured["needles"] < measured["rows"]
    if plan == "shuffle":
        needles = entries.select(_NEEDLE).distinct()
        hits = _join_by_shuffle(articles, needles, fields, measured["lengths"], kept, limits)
        fits = measured["bytes"] <= limits.broadcast_bytes
        return hits.join(F.broadcast(entries) if fits else entries, _NEEDLE).select(*output)

    if plan == "grams":
        needles = stage(entries.select(_NEEDLE).distinct().withColumn(_ENTRY, F.monotonically_increasing_id()), "needles")
        entries = stage(entries.join(needles, _NEEDLE), "entries")
        lookup = Lookup([(row[_ENTRY], [row[_NEEDLE]]) for row in needles.collect()], limits.gram)
        searched = with_labels(articles.select(*kept, _texts(fields).alias("_texts")), "_texts", T.LongType(), _found=lookup)
        # The outer form spares the optimizer's size test, which would search twice.
        hits = searched.select(*kept, F.explode_outer("_found").alias(_ENTRY)).filter(F.col(_ENTRY).isNotNull())
        return hits.join(F.broadcast(entries), _ENTRY).select(*output)

    needles = entries.select(_NEEDLE).distinct() if shared else entries
    texts = articles.select(*kept, _texts(fields).alias("_texts"))
    lowered = [F.coalesce(F.get("_texts", F.lit(i)), F.lit("")).alias(f"_lower_{i}") for i in range(len(fields))]
    found = reduce(lambda a, b: a | b, [F.col(f"_lower_{i}").contains(F.col(_NEEDLE)) for i in range(len(fields))])
    if measured["needles"] <= limits.plain_entries:
        hits = texts.select(*kept, *lowered).join(F.broadcast(needles), found)
    else:  # every pair is tested by the text's bitmap of n-grams first
        sizes = bitmap_sizes(measured["lengths"])
        looked = probes(F.col(_NEEDLE), sizes)
        needles = needles.withColumns({f"_{kind}_{i}": c for i, p in enumerate(looked) for kind, c in zip(("word", "bit"), p)})
        likely = may_hold(F.col("_bitmap"), [(F.col(f"_word_{i}"), F.col(f"_bit_{i}")) for i in range(len(looked))])
        marked = with_bitmap(texts, "_texts", sizes, "_bitmap").select(*kept, *lowered, "_bitmap")
        hits = marked.join(F.broadcast(needles), likely & found)
    if shared:
        hits = hits.select(*kept, _NEEDLE).join(F.broadcast(entries), _NEEDLE)
    return hits.select(*output)
