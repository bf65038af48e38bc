"""Written tables between the steps of an operator.

A step that is read more than once is written as Parquet below the shared folder of
``spark.checkpoint.dir`` and read back: the lineage ends there, columns can be pruned, and
the loss of an executor costs only its own unfinished tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df``, computed once and read back from the shared folder."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.written_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows and bytes of one Arrow batch between Spark and the Python workers; Spark's own defaults are 10000 and 64 MB.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def modest_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch sizes to what operators on whole texts need, so that workers stay small beside each other."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    spark.conf.set(size, str(BATCH_BYTES))
