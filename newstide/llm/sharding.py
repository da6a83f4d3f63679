"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Every record hashes into one of some thousand slots, for good. Bytes are summed per slot,
and a table of (version, slot, shard) says where a slot lives. Rebalancing edits the table:
slots leave shards that hold more than their share, the rest stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from newstide.llm.common import private, with_outputs
from newstide.workspace import stage

MAP_COLUMNS = ["version", "slot", "shard", "bytes"]


def slot_loads(rows: DataFrame, slot: str, size: str, slots: int) -> DataFrame:
    """(slot, bytes, rows) for every slot, empty ones too; at most ``slots`` rows."""
    sums = rows.groupBy(F.col(slot).alias("slot")).agg(
        F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    every = rows.sparkSession.range(slots).select(F.col("id").alias("slot"))
    return every.join(sums, "slot", "left").na.fill(0, ["bytes", "rows"])


def rebalance(
    loads: DataFrame, shards: int, previous: DataFrame | None = None, slack: float = 0.0
) -> DataFrame:
    """The next version of the map, columns ``version, slot, shard, bytes``.

    A slot keeps its shard as long as the shard's slots up to it, largest first, stay within
    (1 + ``slack``) times the mean. The others, and those of shards that no longer exist, go
    one by one, largest first, to the shard with the fewest bytes. Ties go to the smaller
    slot and shard number. Works on one row per slot, a number fixed by a parameter.
    """
    current = loads.select("slot", "bytes")
    if previous is None:
        current = current.select("*", F.lit(None).cast("int").alias("shard"), F.lit(0).alias("v"))
    else:
        last = previous.select(
            "slot", F.when(F.col("shard") < shards, F.col("shard")).alias("shard"), F.col("version").alias("v")
        )
        current = current.join(last, "slot", "left")
    together = Window.partitionBy()
    running = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot")
    current = (
        current.withColumn("fair", F.sum("bytes").over(together) / F.lit(shards) * F.lit(1 + slack))
        .withColumn("v", F.coalesce(F.max("v").over(together), F.lit(0)))
        .withColumn("stays", F.col("shard").isNotNull() & (F.sum("bytes").over(running) <= F.col("fair")))
    )
    gathered = current.groupBy("v").agg(
        F.collect_list(F.when(F.col("stays"), F.struct("slot", "bytes", "shard"))).alias("kept"),
        F.array_sort(
            F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("less"), "slot")))
        ).alias("free"),
    )
    placed = F.expr(
        f"""aggregate(
          free,
          named_struct(
            'loads', transform(sequence(0, {shards - 1}), k ->
              aggregate(filter(kept, x -> x.shard = k), 0L, (a, x) -> a + x.bytes)),
            'done', cast(array() AS array<struct<slot:bigint,bytes:bigint,shard:int>>)),
          (a, s) -> named_struct(
            'loads', transform(a.loads, (x, i) ->
              if(i + 1 = array_position(a.loads, array_min(a.loads)), x - s.less, x)),
            'done', concat(a.done, array(named_struct('slot', s.slot, 'bytes', -s.less, 'shard',
              cast(array_position(a.loads, array_min(a.loads)) - 1 AS int))))),
          a -> a.done)"""
    )
    return (
        gathered.select("v", F.explode(F.concat("kept", placed)).alias("s"))
        .select((F.col("v") + 1).alias("version"), "s.slot", "s.shard", "s.bytes")
    )


def shard_documents(
    docs: DataFrame,
    size: Column,
    key: list[str],
    shards: int,
    slots: int = 4096,
    previous: DataFrame | None = None,
    cell_rows: int = 50_000,
) -> tuple[DataFrame, DataFrame]:
    """Documents with ``virtual_slot``, ``shard`` and ``slot``, and the map that was used.

    ``shard`` follows from the record's virtual slot through the map; ``slot`` numbers the
    records of a shard from 0 without gaps, ordered by virtual slot. Shards come out near
    equal in bytes as long as no single slot outweighs a shard; equal keys share a slot, so
    one key must not hold more than a shard's share.

    NULL keys hash like any value, NULL sizes count 0, repeated rows are numbered one by
    one, an empty table gives an empty result. Input columns called like an output give way.
    Numbering works per cell, a part of a slot of about ``cell_rows`` rows, so that no task
    sorts a whole shard. Only the table of slots passes through one task.
    """
    s, z, c, r = private("slot"), private("size"), private("cell"), private("row")
    rows = docs.withColumns(
        {
            s: F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(slots)),
            z: F.coalesce(size.cast("long"), F.lit(0)),
        }
    )
    loads = stage(slot_loads(rows, s, z, slots), "slot-loads")
    mapping = stage(rebalance(loads, shards, previous), "slot-map")
    largest = loads.agg(F.max("rows")).first()[0] or 0
    cells = max(1, -(-largest // cell_rows))
    every = [F.col(f"`{x}`") for x in docs.columns]
    rows = rows.withColumn(c, F.pmod(F.xxhash64(*every, F.lit(1)), F.lit(cells)).cast("int"))

    counts = rows.groupBy(s, c).agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("shard").orderBy(s, c).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counts.join(mapping.select(F.col("slot").alias(s), "shard"), s)
        .withColumn("start", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .select(F.col(s).alias("_s"), F.col(c).alias("_c"), F.col("shard").alias("_h"), "start")
    )
    order = Window.partitionBy(s, c).orderBy(*[F.col(k) for k in key])
    numbered = rows.withColumn(r, F.row_number().over(order))
    joined = numbered.join(starts, (F.col(s) == F.col("_s")) & (F.col(c) == F.col("_c")))
    out = with_outputs(
        joined,
        virtual_slot=F.col(s),
        shard=F.col("_h").cast("int"),
        slot=(F.col("start") + F.col(r) - 1).cast("long"),
    )
    return out.drop(s, z, c, r, "_s", "_c", "_h", "start"), mapping


def shard_digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per document: its size, checksum, shard and place in the shard.

    The law is ``bytes``: shards hold near equal bytes. ``grown_shard`` is NULL. A NULL text
    has no bytes: size 16, checksum 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    placed, _ = shard_documents(narrow, F.col("size"), ["doc_id"], shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
