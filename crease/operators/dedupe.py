"""DISTINCT ON (keys) with a deterministic survivor.

Implemented as ``groupBy(keys).agg(min_by(struct(rest), struct(order)))``: a sort
aggregate (its state is a struct) with map-side partial aggregation, so a hot key is reduced
before the shuffle (a ``row_number() = 1`` window would put a hot key's rows into one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_on(df: DataFrame, keys: list[str], order_by: list[str],
                descending: bool = False, columns: list[str] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order_by`` (all ascending, or all
    descending with ``descending=True``). Output columns: ``columns`` (default: all of
    ``df`` in their original order). NULL keys form one group, as in SQL."""
    cols = columns or df.columns
    rest = [c for c in cols if c not in keys]
    payload = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(1).alias("_x"))
    order = F.struct(*[F.col(c) for c in order_by])
    pick = F.max_by if descending else F.min_by
    survivor = df.groupBy(*keys).agg(pick(payload, order).alias("_row"))
    return survivor.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                             for c in cols])
