"""Follower snapshot files as a stream: each micro-batch of new files extends the history.

This is the streaming form of the repeated runs that each apply one snapshot.
A ``binaryFile`` stream (path only; ``content`` is never selected) yields the
new snapshot files; ``foreachBatch`` reads them, and ``replay_history``
continues the stored history over all of them in one pass (no loop over
files).  Storage is that of ``rollcall.sources.history_store``; a batch also
keeps the snapshot rows it took.

The file source hands files over by modification time, a bounded number per
trigger, while history runs by snapshot time.  So a batch whose snapshots all
come after the latest one applied continues the stored open set, which is read
in place; a batch with an earlier snapshot, or with more rows of one already
applied, replays all stored snapshot rows and starts a new base.  Marks set on
periods meanwhile are carried over by (pk, data_entrada).  A store that was
seeded, or grown by daily runs, has no earlier rows to replay: there a late
snapshot is an error that names it.

A re-delivered batch that is committed is skipped; one that failed half-way is
rewritten whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators.history import replay_history
from rollcall.schemas import FOLLOWERS, empty
from rollcall.sources.catalog import snapshot_catalog, snapshot_date, snapshot_time
from rollcall.sources.csv_io import INDEX_COL, read_export_csv
from rollcall.sources.history_store import STORED, commit, committed_versions, default_buckets, meta, new_attempt, read_open, read_snaps, read_store

SNAPSHOT_FILE = T.StructType([T.StructField("pk", T.LongType()),
                              T.StructField("username", T.StringType()),
                              T.StructField("full_name", T.StringType())])

BINARY_FILE = T.StructType([T.StructField("path", T.StringType()),
                            T.StructField("modificationTime", T.TimestampType()),
                            T.StructField("length", T.LongType()),
                            T.StructField("content", T.BinaryType())])


def read_history(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """The history after the last committed run (or after run ``upto``)."""
    versions = [v for v in committed_versions(spark, root) if upto is None or v <= upto]
    if not versions:
        return empty(spark, FOLLOWERS)
    return read_store(spark, root, versions[-1])


def _rows(spark: SparkSession, catalog: DataFrame, paths: list[str]) -> DataFrame:
    """Rows of the files with their place; a file without rows leaves one row without pk, so that its snapshot counts."""
    if not paths:
        return empty(spark, STORED)
    read = read_export_csv(spark, paths, SNAPSHOT_FILE, has_index=True, keep_index=True, source_col="_file")
    file = F.col("_file")
    rows = read.select(
        snapshot_time(file).alias("snap_ts"), snapshot_date(file).alias("snap_date"),
        F.struct(file.alias("file"), F.col(INDEX_COL).cast("bigint").alias("row")).alias("place"), "pk", "username", "full_name")
    marks = catalog.select("snap_ts", "snap_date", *[F.lit(None).cast(f.dataType).alias(f.name) for f in STORED.fields[2:]])
    return rows.unionByName(marks)


def _replay(rows: DataFrame, initial: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    calendar = rows.select("snap_ts", "snap_date").distinct()
    return replay_history(rows.where(F.col("pk").isNotNull()), calendar, order="place", initial=initial, partitions=partitions)


def apply_files(spark: SparkSession, files: DataFrame, root: str, batch_id: int) -> None:
    """Extend the history at ``root`` with the snapshot files listed in ``files.path``."""
    root = root.rstrip("/")
    done = committed_versions(spark, root)
    run, known = (done[-1] + 1, meta(spark, root, done[-1])) if done else (0, None)
    if known and batch_id in known.batches:
        return  # re-delivered batch, already committed
    attempt = new_attempt()
    catalog = snapshot_catalog(files.select("path")).checkpoint()
    listed = catalog.select("_path", "arquivo", "snap_ts", "snap_date").collect()  # file names of one trigger (bounded)
    if undated := [r["arquivo"] for r in listed if r["snap_ts"] is None]:
        raise ValueError(f"snapshot files without a date in their names: {undated[:5]}")
    snaps = f"{root}/snaps/run={run}/part={attempt}"
    _rows(spark, catalog, [r["_path"] for r in listed]).write.parquet(snaps)
    new = spark.read.schema(STORED).parquet(snaps)
    buckets, base = default_buckets(spark, root), known.base if known else run

    late = [r["arquivo"] for r in listed if known and known.last_ts and r["snap_ts"] <= known.last_ts]
    if not late:
        opened = read_open(spark, root, done[-1]) if done else empty(spark, FOLLOWERS)
        # the open set is stored bucketed by pk: it is read in place, never shuffled
        out = _replay(new, opened, known.buckets if known else None) if listed else opened
    elif not known.replayable:
        raise ValueError(f"snapshots not later than the stored history, which has no rows to replay: {late[:5]}")
    else:
        stored = read_snaps(spark, root, done[-1]).unionByName(new)
        marks = read_history(spark, root).where(F.col("welcome").isNotNull()).select("pk", "data_entrada", "welcome")
        out, base = _replay(stored).drop("welcome").join(marks, ["pk", "data_entrada"], "left"), run
    taken = sorted({(r["snap_ts"], r["snap_date"], False) for r in listed})
    commit(spark, root, run, out, buckets, base, taken, known.replayable if known else True, batch_id, attempt=attempt, kept_rows=True)


def snapshot_stream(spark: SparkSession, folder: str, root: str, checkpoint_location: str,
                    max_files_per_trigger: int = 100, available_now: bool = True) -> StreamingQuery:
    """Start the stream of snapshot files in ``folder`` into the history at ``root``."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
             .option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .load(folder).select("path"))
    writer = (files.writeStream.option("checkpointLocation", checkpoint_location)
              .foreachBatch(lambda df, batch_id: apply_files(df.sparkSession, df, root, batch_id)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
