"""Follower membership history: apply one snapshot (K7) or replay many (K8).

History rows are periods ``[data_entrada, data_saida)`` per ``pk``; at most
one period per pk is open (``data_saida`` null).

``apply_snapshot`` is one step: open rows absent from the snapshot close on
the run date, snapshot pks without an open row open a period, and every open
row present in the snapshot takes the snapshot's names and ``data_update``.
Closed rows pass through untouched (no shuffle); only open rows meet the
snapshot in a full outer join on ``pk``, whose keys are unique on both sides.

``replay_history`` gives the same table as folding ``apply_snapshot`` over
all snapshots, oldest first, in one pass: number the snapshots from the file
catalogue (so an empty snapshot still closes everyone), then a pk's run of
consecutive snapshot numbers is one period (gaps and islands).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.operators.upsert import pick_row
from rollcall.schemas import FOLLOWERS, conform
from rollcall.session import bounded_broadcast

HISTORY_COLS = [f.name for f in FOLLOWERS.fields]


def _date(d) -> Column:
    if isinstance(d, Column):
        return d.cast("date")
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.lit(d).cast("date")


def clean_snapshot(snap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a pk, rejected rows with a null pk)."""
    return snap.where(F.col("pk").isNotNull()), snap.where(F.col("pk").isNull())


def dedupe_snapshot(snap: DataFrame, order: str | None = None,
                    extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per pk (per ``extra_keys`` group): the first by ``order``.

    ``row_number() = 1`` leaves one row per key and task before the shuffle
    (``WindowGroupLimit``), so a pk repeated in a third of the rows is reduced
    there.  Without ``order`` the smallest (username, full_name) is kept,
    which is deterministic.
    """
    keys = [*extra_keys, "pk"]
    rows = pick_row(snap, keys, [order] if order else ["username", "full_name"], last=False)
    return rows.select(*keys, "username", "full_name")


def apply_snapshot_split(open_rows: DataFrame, snap: DataFrame, run_date) -> DataFrame:
    """K7 over open rows only: returns the updated rows (still open + newly closed).

    ``snap`` must hold unique, non-null pks (see ``clean_snapshot`` /
    ``dedupe_snapshot``).  Writers append the newly closed rows to the
    closed-period table and replace the open-period table, so closed history
    is never rewritten.
    """
    d = _date(run_date)
    o = open_rows.select(*HISTORY_COLS).withColumn("_o", F.lit(True))
    t = snap.select("pk", "username", "full_name").withColumnsRenamed(
        {"username": "t_username", "full_name": "t_full_name"}).withColumn("_t", F.lit(True))
    j = o.join(t, "pk", "full_outer")
    in_o, in_t = F.col("_o").isNotNull(), F.col("_t").isNotNull()
    return j.select(
        F.col("pk"),
        F.when(in_t, F.col("t_username")).otherwise(F.col("username")).alias("username"),
        F.when(in_t, F.col("t_full_name")).otherwise(F.col("full_name")).alias("full_name"),
        F.when(in_o, F.col("data_entrada")).otherwise(d).alias("data_entrada"),
        F.when(in_t, F.lit(None).cast("date")).otherwise(d).alias("data_saida"),
        F.when(in_t, d).otherwise(F.col("data_update")).alias("data_update"),
        F.col("welcome").cast("int").alias("welcome"),
    )


def apply_snapshot(history: DataFrame, snap: DataFrame, run_date, order: str | None = None) -> DataFrame:
    """K7: history after applying snapshot ``snap`` taken on ``run_date``.

    A pk listed twice in the snapshot counts once; its first row by ``order``
    (a row-position column) supplies the names.
    """
    history = conform(history, FOLLOWERS)
    valid, _ = clean_snapshot(snap)
    closed = history.where(F.col("data_saida").isNotNull())
    opened = history.where(F.col("data_saida").isNull())
    updated = apply_snapshot_split(opened, dedupe_snapshot(valid, order), run_date)
    return closed.unionByName(updated)


def late_changes(opened: DataFrame, closed: DataFrame, snap: DataFrame, day: _dt.date, following: _dt.date,
                 previous: _dt.date | None, names: DataFrame | None) -> DataFrame:
    """K7 for a snapshot that comes late: what it changes in a history that later snapshots went into.

    ``opened`` and ``closed``: the periods that touch the gap between the snapshots around ``day``, that is, entered
    on the ``following`` one's date or before and not left before it (one per pk at most); ``snap``:
    the late snapshot, one row per pk; ``names``: the rows of the ``previous`` one, if there is one.
    Who was there before and after follows from the period itself:

    ======  ====  =====  =========================================================================
    before  late  after  the period
    ======  ====  =====  =========================================================================
    yes     no    yes    is split: left on the late date, with the names of then; entered again after
    yes     yes   no     was last seen on the late date, and takes its names
    yes     no    no     was left on the late date already
    no      yes   yes    was entered on the late date already
    no      yes   no     is new: entered on the late date, left on the following one
    ======  ====  =====  =========================================================================

    A mark of welcome stays with the earlier part.  Returns one row per pk touched: ``pk``, the
    ``old_entrada`` of the period changed (null: a new one), whether it ``was_open``, and its new ``rows``.
    """
    late, after = F.lit(day), F.lit(following)
    o, c = (df.select("pk", F.struct(*HISTORY_COLS).alias(name)) for df, name in ((opened, "_open"), (closed, "_closed")))
    t = snap.select("pk", F.struct("username", "full_name").alias("_t"))
    # the open set comes last, so that it stays in its buckets
    j = o.join(c.join(t, "pk", "full_outer"), "pk", "full_outer")
    j = j.select("pk", F.coalesce("_open", "_closed").alias("_o"), F.col("_open").isNotNull().alias("was_open"), "_t")
    j = j.select("*", *[F.col(f"_o.{c}") for c in HISTORY_COLS if c != "pk"])
    seen = F.col("_t").isNotNull()
    was = F.col("_o").isNotNull() & (F.col("data_entrada") <= F.lit(previous)) if previous else F.lit(False)
    stays = F.col("_o").isNotNull() & (F.col("data_saida").isNull() | (F.col("data_saida") > after))
    case = (F.when(was & ~seen & stays, "split").when(was & seen & ~stays, "seen").when(was & ~seen & ~stays, "left")
            .when(~was & seen & stays, "entered").when(~was & seen & ~stays, "new"))
    j = j.withColumn("_case", case).where(F.col("_case").isNotNull())
    if names is not None:
        n = names.select(F.col("pk").alias("_npk"), F.struct("username", "full_name").alias("_n"))
        j = j.join(n, (F.col("pk") == F.col("_npk")) & (F.col("_case") == "split"), "left")
    else:
        j = j.withColumn("_n", F.col("_t"))

    def row(**changed):
        return F.struct(*[changed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in FOLLOWERS.fields])

    def named(c: str) -> dict:
        return {"username": F.col(f"{c}.username"), "full_name": F.col(f"{c}.full_name")}

    nothing = F.lit(None)
    split = F.array(row(data_saida=late, data_update=F.lit(previous), **named("_n")), row(data_entrada=after, welcome=nothing))
    rows = (F.when(F.col("_case") == "split", split).when(F.col("_case") == "seen", F.array(row(data_update=late, **named("_t"))))
            .when(F.col("_case") == "left", F.array(row(data_saida=late))).when(F.col("_case") == "entered", F.array(row(data_entrada=late)))
            .otherwise(F.array(row(data_entrada=late, data_saida=after, data_update=late, welcome=nothing, **named("_t")))))
    return j.select("pk", F.col("data_entrada").alias("old_entrada"), "was_open", rows.alias("rows"))


def present_in(history: DataFrame, snap: DataFrame) -> DataFrame:
    """Open rows whose pk is in the snapshot (``EXISTS``)."""
    return (history.where(F.col("data_saida").isNull())
            .join(snap.select("pk").where(F.col("pk").isNotNull()), "pk", "left_semi"))


def snapshot_calendar(catalog: DataFrame) -> DataFrame:
    """One row per snapshot: ordinal ``n`` and the next snapshot's date.

    ``catalog`` has one row per snapshot (``snap_ts``, ``snap_date``) and is
    bounded by the number of snapshot files, so the unpartitioned window runs
    on a small table.
    """
    w = Window.orderBy("snap_ts")
    return (catalog.select("snap_ts", "snap_date").distinct()
            .select("snap_ts", "snap_date",
                    F.row_number().over(w).alias("n"),
                    F.lead("snap_date").over(w).alias("next_date")))


def replay_history(snaps: DataFrame, catalog: DataFrame, order: str | None = None,
                   initial: DataFrame | None = None, partitions: int | None = None,
                   max_calendar_rows: int = 2_000_000) -> DataFrame:
    """K8: all periods from snapshot rows ``(snap_ts, pk, username, full_name)``.

    ``catalog``: ``(snap_ts, snap_date)`` for every snapshot, empty ones
    included.  Two snapshots on one date stay distinct (ordered by time,
    labelled by date).  Shuffles: the (snap_ts, pk) de-duplication (one row per
    key and task first) and one exchange on pk shared by the island window and
    the period aggregate.  A pk has at most one row per snapshot, so no
    window partition outgrows the snapshot count.

    ``initial``: an existing history to continue from (the same result as
    folding ``apply_snapshot`` over the new snapshots starting from it).
    Its open rows take part as snapshot number 0, carrying their entry date
    and welcome mark; its closed rows are returned unchanged.

    ``partitions``: when ``initial`` is a table bucketed by pk into that many
    buckets, the new rows are hashed by pk into the same number of
    partitions; the union then keeps that partitioning and the stored open
    set is never shuffled (only the new snapshot rows move).
    """
    valid, _ = clean_snapshot(snaps)
    rows = dedupe_snapshot(valid, order, extra_keys=("snap_ts",))
    cal = bounded_broadcast(snapshot_calendar(catalog), max_calendar_rows)
    m = rows.join(cal, "snap_ts").select(
        "pk", "username", "full_name", "snap_date", "n", "next_date",
        F.lit(None).cast("date").alias("_entrada0"), F.lit(None).cast("int").alias("_welcome0"))
    closed = None
    if partitions:
        m = m.repartition(partitions, "pk")
    if initial is not None:
        initial = conform(initial, FOLLOWERS)
        closed = initial.where(F.col("data_saida").isNotNull())
        # one scalar from the small, already checkpointed calendar
        head = cal.where(F.col("n") == 1).select("snap_date").first()
        first = F.lit(head[0] if head else None).cast("date")
        seed = initial.where(F.col("data_saida").isNull()).select(
            "pk", "username", "full_name", F.col("data_update").alias("snap_date"),
            F.lit(0).cast(m.schema["n"].dataType).alias("n"), first.alias("next_date"),
            F.col("data_entrada").alias("_entrada0"), F.col("welcome").alias("_welcome0"))
        m = m.unionByName(seed)
    island = F.col("n") - F.row_number().over(Window.partitionBy("pk").orderBy("n"))
    periods = (m.withColumn("island", island)
               .groupBy("pk", "island")
               .agg(F.max_by(F.struct("username", "full_name"), F.col("n")).alias("_names"),
                    F.min("snap_date").alias("_first_seen"),
                    F.min("_entrada0").alias("_entrada0"),
                    F.max("_welcome0").alias("_welcome0"),
                    F.max("snap_date").alias("data_update"),
                    F.count(F.lit(1)).alias("_rows"),
                    F.count("next_date").alias("_with_next"),
                    F.max("next_date").alias("_last_next")))
    out = periods.select(
        "pk",
        F.col("_names.username").alias("username"),
        F.col("_names.full_name").alias("full_name"),
        F.coalesce("_entrada0", "_first_seen").alias("data_entrada"),
        F.when(F.col("_rows") == F.col("_with_next"), F.col("_last_next")).alias("data_saida"),
        "data_update",
        F.col("_welcome0").cast("int").alias("welcome"),
    )
    return out if closed is None else closed.unionByName(out)
