"""History store (K7, K8): the open set bucketed by pk, closed periods append-only.

Layout below ``root``, for run ``n`` (each attempt at a run writes below a name of its own):

* ``open/v=<n>-<attempt>/``: the open periods after the run, written ``bucketBy(buckets, "pk")``
  and sorted by pk.  As a bucketed table it is the join side that never moves:
  the full outer join with a snapshot shuffles only the snapshot into the same
  buckets.  Each run writes a new version; no path is overwritten while read.
* ``closed/run=<n>/part=<attempt>/``: periods closed by the run (never rewritten).
* ``snaps/run=<n>/part=<attempt>/``: the snapshot rows it took (of a seed: who was there at its last date).
* ``gone/run=<n>/part=<attempt>/``: keys of closed periods of earlier runs that a late snapshot changed; their
  new rows are among the run's own.
* ``marks/<n>``: the run's commit mark, a JSON line: the attempts that make up the history, the bucket
  count its open set was written with, the first run whose closed periods count (a rebuilt
  history starts again at its own run), all snapshots applied, whether ``snaps`` holds all of them,
  and the stream's batches.  Of two runs that started from the same version only
  one gets its mark (``marks.Conflict``); what the other wrote is never read.

Every reader declares the bucket count that the version was *written* with, so
the session's ``spark.sql.shuffle.partitions`` may change between runs; Spark
shuffles the stored side too where the counts don't fit each other.  A version
is registered as a table named after a hash of its full path, and declared anew
when it is read, so stores never share a table.

A daily snapshot may come late.  Only periods that touch its date are looked at and changed
(``operators.history.late_changes``); closed history before the next snapshot is never read, and
the open set is joined in place.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.history import apply_snapshot_split, clean_snapshot, dedupe_snapshot, late_changes
from rollcall.schemas import FOLLOWERS, conform, empty
from rollcall.sources import marks
from rollcall.sources.marks import file_system, hadoop_path

STORED = T.StructType([T.StructField("snap_ts", T.TimestampNTZType()), T.StructField("snap_date", T.DateType()),
                       T.StructField("place", T.StructType([T.StructField("file", T.StringType()),
                                                            T.StructField("row", T.LongType())])),
                       T.StructField("pk", T.LongType()), T.StructField("username", T.StringType()),
                       T.StructField("full_name", T.StringType())])
GONE = T.StructType([T.StructField("pk", T.LongType()), T.StructField("data_entrada", T.DateType())])


def exists(spark: SparkSession, path: str) -> bool:
    return bool(file_system(spark, path).exists(hadoop_path(spark, path)))


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Runs that carry their commit mark."""
    return marks.numbers(spark, root.rstrip("/"))


@dataclass
class Run:
    """A committed run, and the history it made."""

    buckets: int
    base: int
    replayable: bool
    calendar: list[dict]  # ts, date, first (nothing is known of the snapshots before it) of every snapshot applied
    attempts: dict[int, str]  # of all runs up to it
    snaps: list[int]  # runs whose snapshot rows are kept
    gone: list[int]  # runs that replaced closed periods
    batches: list[int]
    last_ts: _dt.datetime | None = None

    def parts(self, root: str, what: str, runs) -> list[str]:
        return [f"{root}/{what}/run={n}/part={self.attempts[n]}" for n in runs]


def meta(spark: SparkSession, root: str, version: int) -> Run:
    """What the mark of a committed run says."""
    d = marks.load(spark, root.rstrip("/"), version)
    calendar = [{"ts": _dt.datetime.fromisoformat(c["ts"]), "date": _dt.date.fromisoformat(c["date"]), "first": c["first"]} for c in d["calendar"]]
    calendar.sort(key=lambda c: c["ts"])
    return Run(d["buckets"], d["base"], d["replayable"], calendar, {int(n): a for n, a in d["attempts"].items()}, d["snaps"], d["gone"], d["batches"],
               calendar[-1]["ts"] if calendar else None)


def register_open(spark: SparkSession, root: str, version: int) -> str:
    """Declare a version's open set as the bucketed table it was written as; returns its name."""
    root = root.rstrip("/")
    run = meta(spark, root, version)
    fs = file_system(spark, root)
    path = fs.makeQualified(hadoop_path(spark, f"{root}/open/v={version}-{run.attempts[version]}")).toString()
    name = "history_open_" + hashlib.sha1(path.encode()).hexdigest()[:24]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FOLLOWERS.fields)
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # only the declaration: the table is external
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet "
              f"CLUSTERED BY (pk) SORTED BY (pk) INTO {run.buckets} BUCKETS "
              f"LOCATION '{quoted}'")
    return name


def read_open(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.table(register_open(spark, root, version))


def _runs(spark: SparkSession, root: str, what: str, schema: T.StructType, run: Run, numbers) -> DataFrame:
    """Rows of ``what`` written by the runs ``numbers``, with their ``run``."""
    schema = T.StructType([*schema.fields, T.StructField("run", T.IntegerType())])
    paths = run.parts(root.rstrip("/"), what, numbers)
    if not paths:
        return empty(spark, schema)
    return spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/{what}").parquet(*paths).select(*schema.fieldNames())


def read_snaps(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The snapshot rows kept by the runs up to ``version``."""
    run = meta(spark, root, version)
    return _runs(spark, root, "snaps", STORED, run, run.snaps).drop("run")


def read_closed(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The closed periods after run ``version``, each as its latest run wrote it."""
    run = meta(spark, root, version)
    closed = _runs(spark, root, "closed", FOLLOWERS, run, [n for n in run.attempts if n >= run.base])
    gone = [n for n in run.gone if n >= run.base]
    if gone:
        names = {"pk": "g_pk", "data_entrada": "g_entrada", "run": "g_run"}
        keys = _runs(spark, root, "gone", GONE, run, gone).withColumnsRenamed(names)
        closed = closed.join(keys, (F.col("pk") == F.col("g_pk")) & (F.col("data_entrada") == F.col("g_entrada")) & (F.col("run") < F.col("g_run")), "left_anti")
    return closed.drop("run")


def read_store(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The whole history after run ``version``: its closed periods and its open set."""
    return read_closed(spark, root, version).unionByName(read_open(spark, root, version))


def default_buckets(spark: SparkSession, root: str, buckets: int | None = None) -> int:
    """Asked count, else that of the store, else the session's shuffle partitions."""
    done = committed_versions(spark, root)
    return buckets or (meta(spark, root, done[-1]).buckets if done
                       else int(spark.conf.get("spark.sql.shuffle.partitions")))


def new_attempt() -> str:
    return uuid.uuid4().hex[:16]


def commit(spark: SparkSession, root: str, version: int, history: DataFrame, buckets: int, base: int | None = None,
           calendar: list[tuple] = (), replayable: bool = False, batch: int | None = None,
           gone: DataFrame | None = None, attempt: str | None = None, kept_rows: bool = False) -> None:
    """Write run ``version``: the closed periods among ``history``, its open set, and at last the mark.

    ``base``: the run that the history starts at, if not where the one before did; ``calendar``: the
    snapshots it took (time, date, whether nothing is known of earlier ones); ``gone``: keys of closed periods that its own
    rows replace; ``attempt``: the name below which its snapshot rows were written, if ``kept_rows``.
    A run that was cut off before its mark leaves files that nothing reads.
    """
    root, attempt = root.rstrip("/"), attempt or new_attempt()
    before = meta(spark, root, version - 1) if version else None
    history = conform(history, FOLLOWERS).checkpoint()
    (history.where(F.col("data_saida").isNotNull()).write.parquet(f"{root}/closed/run={version}/part={attempt}"))
    opened = history.where(F.col("data_saida").isNull())
    path = file_system(spark, root).makeQualified(hadoop_path(spark, f"{root}/open/v={version}-{attempt}")).toString()
    name = "history_write_" + hashlib.sha1(path.encode()).hexdigest()[:24]
    (opened.write.bucketBy(buckets, "pk").sortBy("pk").option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")
    if gone is not None:
        gone.write.parquet(f"{root}/gone/run={version}/part={attempt}")
    taken = [{"ts": ts.isoformat(), "date": day.isoformat(), "first": first} for ts, day, first in calendar]
    known = [{"ts": c["ts"].isoformat(), "date": c["date"].isoformat(), "first": c["first"]} for c in before.calendar] if before else []
    marks.put(spark, root, version, {
        "buckets": buckets, "base": before.base if base is None and before else base or 0, "replayable": replayable,
        "calendar": [*known, *(c for c in taken if c not in known)],
        "attempts": (before.attempts if before else {}) | {version: attempt},
        "snaps": (before.snaps if before else []) + [version] * kept_rows,
        "gone": (before.gone if before else []) + [version] * (gone is not None),
        "batches": (before.batches if before else []) + ([] if batch is None else [batch])})


def _keep_rows(root: str, version: int, attempt: str, rows: DataFrame, taken: _dt.datetime, order: str | None) -> None:
    """Write the rows of the snapshot that run ``version`` takes, one per pk."""
    place = F.struct(F.lit(None).cast("string").alias("file"), (F.col(order).cast("long") if order else F.lit(None).cast("long")).alias("row"))
    rows.select(F.lit(taken).cast("timestamp_ntz").alias("snap_ts"), F.lit(taken.date()).alias("snap_date"),
                place.alias("place"), "pk", "username", "full_name").write.parquet(f"{root.rstrip('/')}/snaps/run={version}/part={attempt}")


def apply_daily(spark: SparkSession, root: str, snap: DataFrame, run_date: _dt.date | str,
                version: int, buckets: int | None = None, order: str | None = None) -> None:
    """K7 as one run: apply ``snap`` (taken on ``run_date``) to the history of run
    ``version - 1``, append the newly closed periods, write open set ``version``.

    ``order`` is the snapshot's row position: of a pk listed twice the first row names it.
    A snapshot older than the store's last one is worked in where it belongs: the history is then
    that of all snapshots in the order of their dates.
    """
    day = _dt.date.fromisoformat(run_date) if isinstance(run_date, str) else run_date
    taken = _dt.datetime(day.year, day.month, day.day)
    valid, _ = clean_snapshot(snap)
    opened, last = empty(spark, FOLLOWERS), None
    if version > 0:
        opened, last = read_open(spark, root, version - 1), meta(spark, root, version - 1).last_ts
    buckets = default_buckets(spark, root, buckets)
    if last and taken.date() < last.date():
        _apply_late(spark, root, valid, taken, version, buckets, order)
        return
    attempt = new_attempt()
    _keep_rows(root, version, attempt, valid, taken, order)
    updated = apply_snapshot_split(opened, dedupe_snapshot(valid, order), run_date)
    commit(spark, root, version, updated, buckets, calendar=[(taken, day, False)], attempt=attempt, kept_rows=True)


def _apply_late(spark: SparkSession, root: str, valid: DataFrame, taken: _dt.datetime, version: int, buckets: int, order: str | None) -> None:
    """Work a snapshot in that is older than the store's last one."""
    day, known = taken.date(), meta(spark, root, version - 1)
    dates = [c["date"] for c in known.calendar]
    before, after = [c for c in known.calendar if c["date"] < day], [c for c in known.calendar if c["date"] > day]
    if day in dates:
        raise ValueError(f"the store has a snapshot of {day}, and later ones; which came first isn't known")
    if dates.count(after[0]["date"]) > 1:
        raise ValueError(f"the snapshot after {day} is one of several of its date")
    if any(c["first"] for c in after):
        raise ValueError(f"nothing is known of the snapshots around {day}: the store was seeded with a later history")
    following, previous, attempt = after[0]["date"], before[-1] if before else None, new_attempt()
    _keep_rows(root, version, attempt, valid, taken, order)
    around = (F.col("data_entrada") <= F.lit(following))
    opened = read_open(spark, root, version - 1)
    closed = read_closed(spark, root, version - 1).where(around & (F.col("data_saida") >= F.lit(following)))
    names = None
    if previous:
        rows = read_snaps(spark, root, version - 1).where((F.col("snap_ts") == F.lit(previous["ts"])) & F.col("pk").isNotNull())
        names = dedupe_snapshot(rows, "place")
    changes = late_changes(opened.where(around), closed, dedupe_snapshot(valid, order), day, following, previous and previous["date"], names)
    changes = changes.checkpoint()  # touched people only
    old = changes.where("was_open").select("pk", "old_entrada")
    kept = opened.join(old, (opened["pk"] == old["pk"]) & (opened["data_entrada"] == old["old_entrada"]), "left_anti")
    rows = changes.select(F.explode("rows").alias("r")).select("r.*")
    gone = changes.where("NOT was_open AND old_entrada IS NOT NULL").select("pk", F.col("old_entrada").alias("data_entrada"))
    commit(spark, root, version, kept.unionByName(rows), buckets, calendar=[(taken, day, False)], replayable=known.replayable, gone=gone, attempt=attempt, kept_rows=True)


def seed_store(spark: SparkSession, root: str, history: DataFrame, buckets: int | None = None) -> None:
    """Start a store at run 0 from an existing history (closed rows appended, open set bucketed).

    Snapshots older than its last date can't be worked in later, as those it was made of aren't known.
    """
    history = conform(history, FOLLOWERS).checkpoint()
    last = history.agg(F.greatest(F.max("data_entrada"), F.max("data_saida"), F.max("data_update"))).first()[0]
    last = last and _dt.datetime(last.year, last.month, last.day)
    attempt = new_attempt()
    if last:
        _keep_rows(root, 0, attempt, history.where(F.col("data_saida").isNull()), last, None)
    commit(spark, root, 0, history, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")),
           calendar=[(last, last.date(), True)] if last else [], attempt=attempt, kept_rows=bool(last))


def mark_store(spark: SparkSession, root: str, accepted: DataFrame) -> int:
    """K9 on the store: the next run, with ``welcome = 1`` on the open periods of the accepted pks."""
    from rollcall.operators.audience import mark_open

    last = committed_versions(spark, root)[-1]
    known = meta(spark, root, last)
    marked = mark_open(read_open(spark, root, last), accepted)
    commit(spark, root, last + 1, marked, known.buckets, replayable=known.replayable)
    return last + 1
