"""O3: ordered previews (head / tail).  Spark rows have no order, so the order is stated.

``orderBy(..).limit(n)`` plans as TakeOrderedAndProject: each partition keeps
its own top n and only those reach the final merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, key: Sequence[str] | str, n: int = 10, tail: bool = False) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    cols = [F.col(k).desc() if tail else F.col(k).asc() for k in keys]
    return df.orderBy(*cols).limit(n)
