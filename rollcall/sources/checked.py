"""T5 in one pass: rows whose ids are none, told apart and counted by the job that writes all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rollcall.functions.scalars import free_name, pk_of


def checked_ids(df: DataFrame, name: str, path: str) -> tuple[DataFrame, DataFrame, int]:
    """(rows whose id ``name`` is valid, as BIGINT, or null; rejected rows as they are; their count).

    ``df`` is computed once: its rows are written to ``path`` with their parsed ids, rejects are
    counted meanwhile (``observe``), and both results read what was written.
    """
    parsed, seen = free_name("_parsed", df), Observation()
    none = F.col(name).isNotNull() & F.col(parsed).isNull()
    tagged = df.withColumn(parsed, pk_of(df, name))
    tagged.observe(seen, F.count(F.when(none, 1)).alias("rejected")).write.parquet(path)
    rows = df.sparkSession.read.schema(tagged.schema).parquet(path)
    good = rows.where(~none).withColumn(name, F.col(parsed)).drop(parsed)
    return good, rows.where(none).drop(parsed), seen.get["rejected"]
