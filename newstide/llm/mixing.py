"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document draws u from its id and gets the key -ln(u) / weight, an exponential variable
scaled by its quality weight; small keys come first. A source whose target exceeds its size
is taken whole as often as it fits (complete epochs); the rest of the budget goes to the
documents in key order, as far as the running sum of their sizes carries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from newstide.llm.common import n_words, with_outputs
from newstide.workspace import stage

SYMBOLS = r"[#*$%&|<>{}0-9]+"


def quality_weight(text: Column) -> Column:
    """Share of characters that are neither symbols nor digits, at least 0.05."""
    text = F.coalesce(text, F.lit(""))
    plain = F.length(F.regexp_replace(text, SYMBOLS, ""))
    return F.greatest(F.lit(0.05), plain / F.greatest(F.length(text), F.lit(1)))


def draw(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on key and seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("-"))))
    whole = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (whole + F.lit(0.5)) / F.lit(float(16**13))


def targets(sizes: DataFrame, weights: tuple[int, ...], fraction: float, epochs: float) -> DataFrame:
    """Rows (source, source_size) with ``target``.

    Sources by code point, NULL last, take ``weights`` in turn. Their targets are in
    proportion to the weights and sum to ``fraction`` of all sizes; one above ``epochs``
    times its source's size stops there, and the excess is shared by weight among the rest.
    One row per source goes through one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    whole = Window.partitionBy()
    # Sources fill up in the order of limit / weight. While the first k are full, the level of
    # the others is (total - limits of the k) / (weight of the others); the final level is the
    # first at which the next source does not fill up.
    fill = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sizes.withColumn("w", weight)
        .withColumn("limit", F.col("source_size") * F.lit(float(epochs)))
        .withColumn("ratio", F.col("limit") / F.col("w"))
        .withColumn("total", F.sum("source_size").over(whole) * F.lit(float(fraction)))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("open"))
        .withColumn("turn", F.when(F.col("ratio") > F.col("level"), F.row_number().over(fill)))
        .withColumn("level", F.min_by("level", "turn").over(whole))
        .withColumn("target", F.coalesce(F.least("limit", F.col("level") * F.col("w")), F.col("limit")))
        .select("source", "source_size", "target")
    )


def plan_mix(
    narrow: DataFrame, weights: tuple[int, ...], fraction: float, epochs: float, bins: int
) -> DataFrame:
    """Per source: size, target, whole epochs, and the last key that the rest still takes.

    ``narrow`` has ``source, key, size, v`` with v = 1 - u**(1/weight), which orders rows as
    the exponential key does and lies in [0, 1). Sizes are summed per source and bin of v,
    so only the rows of the one bin in which a budget ends are sorted, and no source, however
    large, is.
    """
    binned = narrow.withColumn("bin", F.floor(F.col("v") * bins))
    per_bin = stage(binned.groupBy("source", "bin").agg(F.sum("size").alias("words")), "mix-bins")
    per_source = targets(
        per_bin.groupBy("source").agg(F.sum("words").alias("source_size")), weights, fraction, epochs
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    per_source = stage(
        per_source.withColumn("epochs", whole.cast("long")).withColumn(
            "rest", F.col("target") - F.col("epochs") * F.col("source_size")
        ),
        "mix-targets",
    )
    up_to = Window.partitionBy("source").orderBy("bin")
    last_bin = (
        per_bin.withColumn("base", F.sum("words").over(up_to) - F.col("words"))
        .join(per_source.select(F.col("source").alias("s2"), "rest"), F.col("source").eqNullSafe(F.col("s2")))
        .filter((F.col("base") <= F.col("rest")) & (F.col("rest") < F.col("base") + F.col("words")))
        .select(F.col("source").alias("s2"), F.col("bin").alias("b2"), "base", "rest")
    )
    by_key = Window.partitionBy("source").orderBy("v", "key")
    cut = (
        binned.join(last_bin, F.col("source").eqNullSafe(F.col("s2")) & (F.col("bin") == F.col("b2")))
        .withColumn("ahead", F.col("base") + F.sum("size").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("source", "b2")
        .agg(F.max(F.when(F.col("ahead") - F.col("size") / 2 <= F.col("rest"), F.struct("v", "key"))).alias("last"))
        .select(
            F.col("source").alias("s3"),
            F.coalesce(F.col("last.v"), F.col("b2") / F.lit(float(bins))).alias("cut_v"),
            F.col("last.key").alias("cut_key"),
        )
    )
    return stage(
        per_source.join(cut, F.col("source").eqNullSafe(F.col("s3")), "left").drop("s3"), "mix-plan"
    )


def _decided(
    docs: DataFrame,
    key: str,
    source: str,
    text: str,
    weights: tuple[int, ...],
    fraction: float,
    epochs: float,
    seed: int,
    bins: int,
) -> DataFrame:
    """Documents with ``_mix_*`` columns: size, source_size, target, repeats."""
    u = draw(F.col(key), seed)
    rows = docs.withColumns(
        {"_mix_size": n_words(F.col(text)), "_mix_v": 1 - F.pow(u, 1 / quality_weight(F.col(text)))}
    )
    narrow = stage(
        rows.select(
            F.col(source).alias("source"),
            F.col(key).alias("key"),
            F.col("_mix_size").alias("size"),
            F.col("_mix_v").alias("v"),
        ),
        "mix-rows",
    )
    plan = plan_mix(narrow, weights, fraction, epochs, bins)
    plan = plan.select(*[F.col(c).alias(f"_mix_{c}") for c in plan.columns])
    joined = rows.join(plan, F.col(source).eqNullSafe(F.col("_mix_source")))
    reached = (F.col("_mix_v") < F.col("_mix_cut_v")) | (
        (F.col("_mix_v") == F.col("_mix_cut_v")) & (F.col(key) <= F.col("_mix_cut_key"))
    )
    return joined.withColumn(
        "_mix_repeats", (F.col("_mix_epochs") + F.when(reached, 1).otherwise(0)).cast("int")
    )


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = (3, 1, 2),
    fraction: float = 1.5,
    epochs: float = 2.0,
    seed: int = 0,
    bins: int = 1 << 14,
) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target`` and ``taken``, in words.

    ``taken`` counts repeats: whole epochs times the size, plus the size once more where the
    rest of the budget reaches the document. The running sum stops at the document boundary
    nearest to the budget, so a source misses its target by at most half a document.

    A NULL text has size 0 and takes nothing, NULL is a source of its own, rows with the
    same key draw the same number and are taken together, an empty table gives an empty
    result. Input columns called like an output give way. Texts are read where they lie and
    never shuffled as long as the plan, one row per source, is small enough to broadcast by
    its measured size; a larger one is joined by shuffle.
    """
    decided = _decided(docs, key, source, text, weights, fraction, epochs, seed, bins)
    out = with_outputs(
        decided,
        size=F.col("_mix_size"),
        source_size=F.col("_mix_source_size"),
        target=F.col("_mix_target"),
        taken=F.col("_mix_size") * F.col("_mix_repeats"),
    )
    return out.drop(*[c for c in decided.columns if c.startswith("_mix_")])


def mix_digest(docs: DataFrame) -> DataFrame:
    """The mix of all documents with the production weights, without their texts."""
    return mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_corpus(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = (3, 1, 2),
    fraction: float = 1.5,
    epochs: float = 2.0,
    seed: int = 0,
    bins: int = 1 << 14,
) -> DataFrame:
    """The documents themselves, each as many times as the mix takes it; input columns only."""
    decided = _decided(docs, key, source, text, weights, fraction, epochs, seed, bins)
    repeated = decided.withColumn("_mix_n", F.expr("explode(array_repeat(0, _mix_repeats))"))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
