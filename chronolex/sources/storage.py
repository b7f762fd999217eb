"""The folder that driver and executors share, and checkpoints in it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that setting is absent, as in tests in local mode, a temporary folder serves.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set on this cluster")
        shared = tempfile.mkdtemp(prefix="chronolex-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, uri: str) -> None:
    """Delete a folder with all it holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of whole texts that go to a Python worker at a time; Spark's default of 10,000 may be a hundred MB and more.
BATCH_ROWS = 1000


def batched(df: DataFrame) -> DataFrame:
    """The table, whose rows now go to Python in batches of BATCH_ROWS at most, by a setting of its session that is no smaller yet."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, BATCH_ROWS)
    return df


def spread(df: DataFrame, most: int = 64 << 20) -> DataFrame:
    """A small table over all cores; one of more bytes than ``most`` stays as it is.

    A small file may be a single row group and so a single task's, while what follows (tokens, hashes) takes long for each byte.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if size <= most and df.rdd.getNumPartitions() < 2 * cores else df
