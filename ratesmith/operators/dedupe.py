"""Last-row-wins de-duplication.

The reference builds Python dicts, so the last pair per key wins.  A
DataFrame has no row order, so the order is an explicit ordinal: one
``groupBy`` with ``max_by`` (partial aggregation map-side, so a hot key is
combined before the shuffle rather than collected into one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_by_ordinal(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                    ordinal: Sequence[str]) -> DataFrame:
    """Per key, the ``values`` of the row with the greatest ``ordinal``.

    ``max`` of the struct (ordinal first, then the values) is the same row
    as ``max_by(values, ordinal)`` when the ordinal is unique, breaks
    remaining ties on the values, and measured faster than ``max_by``.
    """
    fields = [F.col(o).alias(f"_o{i}") for i, o in enumerate(ordinal)] + [F.col(v) for v in values]
    picked = F.max(F.struct(*fields)).alias("_last")
    return (df.groupBy(*keys).agg(picked)
              .select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values]))
