"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the cluster; only a local session may fall back to /tmp."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="newstide-")
    return _local_folders[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """Deal out a table that comes as fewer splits than there are cores.

    For tables just read, where the number of splits is known without running anything: a
    table in one row group is one task, however many cores there are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the written table.

    Cuts the lineage, survives lost executors, and gives the optimizer real
    sizes instead of estimates.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard_stage(staged: DataFrame) -> None:
    """Delete the files of a staged table that is not read any more."""
    jvm = staged.sparkSession.sparkContext._jvm
    hadoop = staged.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rsplit("/", 1)[0] for file in staged.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)
