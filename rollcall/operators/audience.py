"""Audience operators: cutoff, no-interaction, protect list, candidates, outbox,
accepted prefix, welcome mark and counts (F1 F2 J1 J5 D1 D2 K9 A1 A2 A4 T6 T7).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.scalars import free_name, greeting_name, render, strict_pk
from rollcall.operators.upsert import pick_row
from rollcall.session import DEFAULT_BROADCAST_ROWS, bounded_broadcast

# Fixed values of the studied behaviour.
CUTOFF_DAYS = 115
SECONDS_PER_POST = 2.5
WELCOME_TEMPLATE = (
    "Hello, {}!\nWelcome to our page.\nWe prepare our posts with great care.\n"
    "I love receiving comments on posts and look forward to yours. Send it there, okay?\n"
    "Gratitude 🌹💖🙌"
)


def _ts_literal(as_of) -> F.Column:
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else as_of.isoformat()
    return F.lit(as_of).cast("timestamp_ntz")


def posts_since(posts: DataFrame, as_of, days: int = CUTOFF_DAYS,
                ts_col: str = "criado_em_post") -> DataFrame:
    """posts created at or after ``as_of - days`` (local wall time).

    ``as_of`` is an argument, never ``now()`` in the plan; the comparison is
    a plain column-versus-literal filter, so it reaches the parquet scan.
    """
    cutoff = _ts_literal(as_of) - F.make_dt_interval(F.lit(days))
    return posts.where(F.col(ts_col) >= cutoff)


def rename_pk(df: DataFrame, name: str) -> DataFrame:
    """``follower_pk`` / ``list_follower_pk`` → ``pk``."""
    return df.withColumnsRenamed({name: "pk"}) if name != "pk" else df


def no_interaction(followings: DataFrame, likes: DataFrame, comments: DataFrame,
                   likes_key: str = "follower_pk", comments_key: str = "follower_pk") -> DataFrame:
    """Followed accounts with neither a like nor a comment.

    Both sides are cast to BIGINT (text ids still match); text that is no id
    ends the query (take such rows out with ``scalars.split_ids`` and report
    them), since dropping it would change who counts as inactive.  The interaction
    keys are unioned and de-duplicated first (partial aggregate, so a heavy
    liker collapses map-side); one anti-join then replaces the two
    successive masks, which commute.  AQE broadcasts the distinct keys when
    they are small and keeps a shuffle join otherwise.
    """
    f = followings.withColumn("pk", strict_pk(followings, "pk"))
    likes, comments = rename_pk(likes, likes_key), rename_pk(comments, comments_key)
    touched = (likes.select(strict_pk(likes, "pk").alias("pk"))
               .unionByName(comments.select(strict_pk(comments, "pk").alias("pk")))
               .where(F.col("pk").isNotNull())
               .distinct())
    return f.join(touched, "pk", "left_anti").select(*followings.columns)


def exclude_protected(df: DataFrame, protected, column: str = "username",
                      max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Drop rows whose ``column`` is in the protect list (a list or a DataFrame)."""
    if isinstance(protected, DataFrame):
        names = protected.select(F.col(protected.columns[0]).alias(column)).where(
            F.col(column).isNotNull()).distinct()
        names = bounded_broadcast(names, max_rows)
    else:
        schema = T.StructType([T.StructField(column, T.StringType())])
        names = bounded_broadcast(df.sparkSession.createDataFrame([(n,) for n in set(protected)], schema), max_rows)
    return df.join(names, column, "left_anti").select(*df.columns)


def open_periods(history: DataFrame) -> DataFrame:
    """periods not yet closed and not yet welcomed."""
    return history.where(F.col("welcome").isNull() & F.col("data_saida").isNull())


def candidate_periods(history: DataFrame, order: Sequence[str] = ("data_entrada", "pk")) -> DataFrame:
    """D1 + T6: (username, convites, pk) per username, of its open periods the last by ``order``."""
    rows = open_periods(history).select(
        "username", greeting_name(F.col("full_name"), F.col("username")).alias("convites"), "pk", *[c for c in order if c != "pk"])
    return pick_row(rows, ["username"], list(order), last=True).select("username", "convites", "pk")


def welcome_candidates(history: DataFrame, order: Sequence[str] = ("data_entrada", "pk")) -> DataFrame:
    """D1 + T6: (username, convites) per username, the last row by ``order`` wins."""
    return candidate_periods(history, order).select("username", "convites")


def render_outbox(candidates: DataFrame, template: str = WELCOME_TEMPLATE,
                  name_col: str = "convites") -> DataFrame:
    """The outbox table (username, message)."""
    return candidates.select("username", render(template, F.col(name_col)).alias("message"))


def accepted_prefix(results: DataFrame, run: str = "run_id", order: Sequence[str] = ("seq",),
                    status: str = "status", include_failing: bool = False,
                    max_runs: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Per run, the rows before the first ``status = false``.

    A null status does not stop the walk and counts as accepted.  With
    ``include_failing`` the failing row itself is kept (the removal loop has
    already attempted it).  The cut is an aggregate per run (partial, so a
    run holding a third of all rows is fine) joined back through a
    size-checked broadcast; beyond the bound AQE splits skewed partitions.
    """
    key, at, end = F.struct(*[F.col(c) for c in order]), free_name("_run", results), free_name("_cut", results)
    cut = (results.where(F.col(status) == F.lit(False))
           .groupBy(F.col(run).alias(at)).agg(F.min(key).alias(end)))
    cut = bounded_broadcast(cut, max_runs)
    j = results.join(cut, F.col(run).eqNullSafe(F.col(at)), "left")
    before = (key <= F.col(end)) if include_failing else (key < F.col(end))
    return j.where(F.col(end).isNull() | before).select(*results.columns)


def mark_welcomed(people: DataFrame, accepted: DataFrame, key: str = "username",
                  mark: str = "welcome") -> DataFrame:
    """K9: ``welcome = 1`` where ``key`` is among the accepted keys, else unchanged."""
    hit = free_name("_hit", people)
    keys = accepted.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn(hit, F.lit(True))
    j = people.join(keys, key, "left")
    base = F.col(mark) if mark in people.columns else F.lit(None)
    return j.withColumn(mark, F.when(F.col(hit), F.lit(1)).otherwise(base).cast("int")).select(
        *people.columns, *([] if mark in people.columns else [mark]))


def accepted_pks(history: DataFrame, accepted: DataFrame) -> DataFrame:
    """The pks behind the accepted usernames: those whose greeting was in the outbox."""
    names = accepted.select("username").where(F.col("username").isNotNull()).distinct()
    return candidate_periods(history).join(names, "username", "left_semi").select("pk").distinct()


def mark_open(history: DataFrame, accepted: DataFrame) -> DataFrame:
    """K9 keyed by pk: ``welcome = 1`` on the open periods of the accepted pks; closed and earlier periods stay."""
    keys = accepted.select("pk").where(F.col("pk").isNotNull()).distinct().withColumn("_hit", F.lit(True))
    j = history.join(keys, "pk", "left")
    hit = F.col("_hit").isNotNull() & F.col("data_saida").isNull()
    return j.withColumn("welcome", F.when(hit, F.lit(1)).otherwise(F.col("welcome")).cast("int")).select(*history.columns)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A2: one row per table: (metric, value)."""
    parts = [df.agg(F.count(F.lit(1)).cast("double").alias("value"))
             .select(F.lit(name).alias("metric"), "value") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unwelcomed_count(history: DataFrame) -> DataFrame:
    """A1: count of history rows with ``welcome`` null."""
    return history.where(F.col("welcome").isNull()).agg(
        F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("unwelcomed").alias("metric"), "value")


def extraction_estimate(posts: DataFrame) -> DataFrame:
    """A4: posts to process and estimated minutes ``n × 2.5 / 60``."""
    n = posts.agg(F.count(F.lit(1)).cast("double").alias("n"))
    return n.select(
        F.explode(F.array(
            F.struct(F.lit("posts_to_process").alias("metric"), F.col("n").alias("value")),
            F.struct(F.lit("estimated_minutes").alias("metric"),
                     (F.col("n") * F.lit(SECONDS_PER_POST) / F.lit(60.0)).alias("value")),
        )).alias("m")).select("m.metric", "m.value")

