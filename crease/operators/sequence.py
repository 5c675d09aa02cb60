"""Running counts (COUNT(*) OVER (PARTITION BY p ORDER BY o)) and appearance orders.

``running_count`` keeps the SQL default frame (RANGE UNBOUNDED PRECEDING .. CURRENT ROW):
rows with equal order keys (peers) share one value. It is one plain window at every size:
a partition is an innings or one of its parts, a few hundred rows by the rules of the game.
``running_count_ranges`` gives the same for partitions of any size, NULL keys included: no
task holds more than a range of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crease.session import scratch_path


def running_count(df: DataFrame, partition_by: list[str], order_by: list[str],
                  out: str) -> DataFrame:
    """Add ``out`` = number of rows in the same partition with order key <= this row's.

    ``order_by`` columns are ascending, nulls first (Spark's default; PostgreSQL's
    default ASC is nulls last — callers keep order keys non-null). Rows with a NULL
    partition key form one partition."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(out, F.count(F.lit(1)).over(w))


def running_count_ranges(df: DataFrame, partition_by: list[str], order_by: list[str], out: str) -> DataFrame:
    """``running_count`` where one key, or NULL, may hold a large share of the rows.

    Rows are dealt to ranges of (partition, order) and stored, so that every pass sees the same
    ranges; peers have equal values and share a range. Each range counts its own rows per key.
    A key that goes on from an earlier range adds that range's rows: only such keys have an
    offset, at most one per range, so the offsets are broadcast. Peers of more rows than a task
    can hold would still share one."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    dealt = df.repartitionByRange(*[F.col(c) for c in (*partition_by, *order_by)]).withColumn(
        "__range", F.spark_partition_id())
    dealt.write.parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path)
    held = rows.groupBy("__range", *partition_by).agg(F.count(F.lit(1)).alias("__held"))
    earlier = Window.partitionBy(*partition_by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"__key{i}" for i in range(len(partition_by))]
    offsets = (held.withColumn("__before", F.sum("__held").over(earlier)).filter("__before > 0")
               .select(F.col("__range").alias("__of"), "__before",
                       *[F.col(c).alias(n) for c, n in zip(partition_by, names)]))
    own = Window.partitionBy("__range", *partition_by).orderBy(*order_by)
    counted = rows.withColumn("__counted", F.count(F.lit(1)).over(own))
    same = counted["__range"] == offsets["__of"]
    for c, n in zip(partition_by, names):
        same = same & counted[c].eqNullSafe(offsets[n])
    return (counted.join(F.broadcast(offsets), same, "left")
            .withColumn(out, F.col("__counted") + F.coalesce("__before", F.lit(0)))
            .select(*df.columns, out))


def running_sums(df: DataFrame, order: str, values: list[str]) -> DataFrame:
    """Add ``__<value>`` = the sum of the value over all rows up to this one by ``order`` (unique,
    not null), over the whole table and without a single task for it.

    Rows are dealt to ranges of ``order`` and stored, so that every pass sees the same ranges; each
    range sums its own rows, the totals of the ranges before it (one row per range) are added."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    dealt = df.repartitionByRange(F.col(order)).withColumn("__range", F.spark_partition_id())
    dealt.write.parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path)
    totals = rows.groupBy("__range").agg(*[F.sum(v).cast("long").alias(v) for v in values])
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__range").alias("__of"), *[
        F.coalesce(F.sum(v).over(before), F.lit(0)).alias("__before_" + v) for v in values])
    own = Window.partitionBy("__range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(F.broadcast(offsets), F.col("__range") == F.col("__of"))
    for v in values:
        out = out.withColumn("__" + v, F.sum(v).over(own).cast("long") + F.col("__before_" + v))
    return out.drop("__range", "__of", *["__before_" + v for v in values])


def role_first_steps(events: DataFrame, partition_by: list[str], seq_col: str,
                     actors: list[tuple[str, int]], earliest_only: bool = True) -> DataFrame:
    """Per (partition, actor, role): the first step (``_first``). Roles come from one
    scan (explode of an array of (actor, priority) structs) rather than a UNION of two
    scans; the rows are already distinct, as the SQL UNION requires. With
    ``earliest_only``, ``_min_first`` = the actor's earliest step over all roles
    (FIRST_VALUE over the actor's roles ordered by step) and only roles at it are kept."""
    p = list(partition_by)
    roles = F.array(*[F.struct(F.col(c).alias("_actor"), F.lit(pr).alias("_priority"))
                      for c, pr in actors])
    firsts = (events.select(*p, seq_col, F.explode(roles).alias("_r"))
              .select(*p, seq_col, "_r._actor", "_r._priority")
              .groupBy(*p, "_actor", "_priority")
              .agg(F.min(seq_col).alias("_first")))
    if not earliest_only:
        return firsts
    per_actor = Window.partitionBy(*p, "_actor").orderBy("_first")
    return (firsts.withColumn("_min_first", F.first("_first").over(per_actor))
            .filter(F.col("_first") == F.col("_min_first")))


def appearance_order(events: DataFrame, partition_by: list[str], seq_col: str,
                     actors: list[tuple[str, int]], name_out: str, pos_out: str) -> DataFrame:
    """Order in which actors first appear in a sequence.

    For each actor column (with a priority used to break a tie on the same step), take
    the first step the actor appears at; keep, per actor, the role(s) at its earliest
    step; then number actors by (first step, priority) with ``running_count``.

    The per-actor minimum is a partial aggregate; the window that compares an actor's
    roles has at most ``len(actors)`` rows per partition."""
    p = list(partition_by)
    earliest = role_first_steps(events, p, seq_col, actors)
    numbered = running_count(earliest, p, ["_min_first", "_priority"], pos_out)
    return numbered.select(*p, F.col("_actor").alias(name_out), F.col(pos_out))

