"""Session construction and the few scale helpers every module shares.

* ``build_session`` pins the settings the engine relies on: UTC session zone and
  AQE with skew-join splitting.  Master, partitions and memory are the
  submission's; only a plain local run gets defaults.
* ``checkpoint_root`` / ``scratch_path`` resolve the *shared* folder named by
  ``spark.checkpoint.dir``.  Only a local-mode session without that setting
  (tests, the bench) gets a private temporary folder; a cluster session without
  it is an error, because a machine-local folder does not survive the loss of
  an executor.
* ``bounded_broadcast`` is the only way this package broadcasts a side that is
  derived from data: the side is checkpointed (lineage cut, computed once),
  measured, and marked for broadcast only under a stated bound on rows and one
  on bytes.  Above either the plain DataFrame is returned and Spark plans a shuffle join, which
  AQE may still convert or split at runtime.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default bound for a broadcast side (rows).  One row per run, per snapshot
# file or per protected name stays far below this; a side that grows with the
# data beyond it falls back to a shuffle join.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 << 20


# Settings of a plain local run (tests, the bench, a laptop); a submitted job brings its own.
LOCAL_DEFAULTS = {
    "spark.master": None,  # local[cpus]
    "spark.sql.shuffle.partitions": None,  # cpus
    "spark.driver.memory": "16g",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
_SUBMIT_FLAGS = {"spark.master": "--master", "spark.driver.memory": "--driver-memory"}


def _configured(key: str) -> bool:
    """Whether the submission, its defaults file or a running session already sets ``key``."""
    if SparkContext._gateway is not None or "PYSPARK_GATEWAY_PORT" in os.environ:
        # the JVM is up: its configuration holds what was submitted
        if SparkContext._active_spark_context is not None:
            return SparkContext._active_spark_context.getConf().contains(key)
        return SparkConf().contains(key)
    args = os.environ.get("PYSPARK_SUBMIT_ARGS", "").split()
    if _SUBMIT_FLAGS.get(key) in args or any(a.split("=")[0] == key for a in args):
        return True
    home = os.environ.get("SPARK_HOME")
    folder = os.environ.get("SPARK_CONF_DIR") or (f"{home}/conf" if home else None)
    defaults = os.path.join(folder, "spark-defaults.conf") if folder else ""
    if not os.path.isfile(defaults):
        return False
    with open(defaults, encoding="utf-8") as f:
        return any(line.replace("=", " ").split()[:1] == [key] for line in f)


def build_session(
    master: str | None = None,
    app: str = "rollcall",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the engine assumes (UTC, AQE, skew join).

    Master, shuffle partitions, memory and the like are only set where neither
    the caller's arguments nor the submitted configuration names them; without
    a configured master the run is a local one with ``LOCAL_DEFAULTS``.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    local = master is not None or not _configured("spark.master")
    given = {"spark.master": master, "spark.sql.shuffle.partitions": shuffle_partitions and str(shuffle_partitions)}
    fallback = LOCAL_DEFAULTS | {"spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus}
    for key, value in fallback.items():
        if given.get(key):
            builder = builder.config(key, given[key])
        elif local and not _configured(key):
            builder = builder.config(key, value)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session; set one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # unset in the session conf
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder"
            )
        configured = tempfile.mkdtemp(prefix="rollcall-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/rollcall-{label}-{uuid.uuid4().hex[:12]}"


def _bytes(c: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in a broadcast table."""
    if isinstance(kind, T.StringType | T.BinaryType):
        size = F.octet_length(c) + 16
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.NumericType | T.DateType | T.TimestampType | T.TimestampNTZType | T.BooleanType):
            size = F.size(c) * 8 + 32
        else:
            each = F.transform(c, lambda x: _bytes(x, kind.elementType))
            size = F.aggregate(each, F.lit(32).cast("long"), lambda a, x: a + x)
    elif isinstance(kind, T.StructType):
        size = F.lit(16)
        for field in kind.fields:
            size = size + _bytes(c[field.name], field.dataType)
    else:
        size = F.lit(16)
    return F.coalesce(size.cast("long"), F.lit(16).cast("long"))


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Checkpoint ``df``, measure it, and hint a broadcast only under both bounds."""
    checkpoint_root(df.sparkSession)
    frozen = df.checkpoint(eager=True)
    width = F.lit(16).cast("long")
    for field in frozen.schema.fields:
        width = width + _bytes(F.col(f"`{field.name}`"), field.dataType)
    rows, size = frozen.agg(F.count(F.lit(1)), F.sum(width)).first()
    return F.broadcast(frozen) if rows <= max_rows and (size or 0) <= max_bytes else frozen


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when it has fewer partitions.

    For CPU-heavy per-row work (caption parsing over whole texts) on an input
    with few splits, e.g. one parquet row group.  A large input already has
    more splits than cores, and then this is a no-op (no shuffle).
    """
    if df.isStreaming:
        return df  # a stream's micro-batches are partitioned by the source
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
