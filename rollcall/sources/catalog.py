"""Snapshot catalogue (S6, F3, O2, T11): which files are follower snapshots, and when.

A snapshot is named ``df_followers_YYYY-MM-DD HHMMSS`` (a ``.csv`` file, or
the ``snapshot=...`` folder of a partitioned export).  The date is read from
characters 14-17, 19-20 and 22-23 of that name (1-based), the snapshot time
from characters 14-30.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.scalars import folder_of, name_of

# The snapshot name marker and stamp layout.
SNAPSHOT_MARK = "df_followers"
STAMP_FORMAT = "yyyy-MM-dd HHmmss"


def snapshot_name(path: Column) -> Column:
    """The snapshot's name: the file name, or its partition folder's value."""
    base = name_of(path)
    parent = F.regexp_replace(name_of(folder_of(path)), r"^[^=]*=", "")
    return F.when(base.contains(SNAPSHOT_MARK), base).otherwise(parent)


def _stamp_time(name: Column) -> Column:
    """The stamp's time; a name with a date only counts as that day's midnight."""
    full = F.try_to_timestamp(F.substring(name, 14, 17), F.lit(STAMP_FORMAT)).cast("timestamp_ntz")
    return F.coalesce(full, _stamp_date(name).cast("timestamp_ntz"))


def _stamp_date(name: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws("-", F.substring(name, 14, 4), F.substring(name, 19, 2),
                                          F.substring(name, 22, 2)), F.lit("yyyy-MM-dd")).cast("date")


def snapshot_time(path: Column) -> Column:
    """Snapshot time (TIMESTAMP_NTZ) read from a snapshot file's path."""
    return _stamp_time(snapshot_name(path))


def snapshot_date(path: Column) -> Column:
    """Snapshot date read from a snapshot file's path."""
    return _stamp_date(snapshot_name(path))


def snapshot_catalog(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """(_path, arquivo, snap_ts, snap_date) for every snapshot file, ordered by name."""
    files = paths.select(F.col(path_col).alias("_path"),
                         snapshot_name(F.col(path_col)).alias("arquivo")).where(
        F.col("arquivo").contains(SNAPSHOT_MARK))
    a = F.col("arquivo")
    return files.select("_path", "arquivo", _stamp_time(a).alias("snap_ts"),
                        _stamp_date(a).alias("snap_date")).orderBy("arquivo")


def list_snapshot_files(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue of the snapshot files in ``folder`` (file listing only; content pruned)."""
    paths = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(folder).select("path"))
    return snapshot_catalog(paths)
