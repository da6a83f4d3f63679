"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Dates are parsed and printed in UTC, numbers are parsed strictly, and partition
# counts, join strategies and skewed partitions are settled at run time.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session handed in by the caller."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "newstide",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session; on a cluster leave ``master`` to the submit command."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())
