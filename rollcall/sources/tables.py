"""Tables read by SQL through session views or catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose ``df`` to SQL under ``name`` for this session, and read it back as a table."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
