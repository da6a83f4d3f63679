"""The analysis over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newstide.operators.contains import DEFAULTS, ContainsLimits
from newstide.plans.analyse import ResultTables, analyse
from newstide.schemas import SCORED_ARTICLES


def analyse_arrivals(
    spark: SparkSession,
    articles_folder: str,
    checkpoint: str,
    tables: ResultTables,
    sectors: DataFrame,
    companies: DataFrame,
    ticks: DataFrame | None = None,
    files_per_batch: int = 1000,
    limits: ContainsLimits = DEFAULTS,
) -> None:
    """Fold every article file not seen before into the tables, then stop.

    Prices are folded in up front, so that the batches of one run share them. The number of
    a batch is stored with it, so one that the stream delivers again after a failure is
    skipped before anything is searched; articles that come in another batch again are not new.
    """
    if ticks is not None:
        analyse(tables, sectors, companies, ticks=ticks, limits=limits)

    def fold(batch: DataFrame, number: int) -> None:
        analyse(tables, sectors, companies, articles=batch, limits=limits, delivery=(checkpoint, number))

    query = (
        spark.readStream.schema(SCORED_ARTICLES)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(articles_folder)
        .writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
