"""Column expressions on texts that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column | str) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; a null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]
