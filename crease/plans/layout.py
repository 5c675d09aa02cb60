"""Match-keyed models as bucketed tables: shuffled once when stored, not when read.

Every ball-grain model is keyed by the match first. Stored in hash buckets of ``match_id``, with
the same number of buckets each, the models meet bucket by bucket: windows per innings,
aggregates per player and joins between them run inside a task, whatever further key columns
they have. A bucket is one file and one task, so their number has to grow with the balls:
``buckets_for`` gives it.

Joins on more than the match need ``in_buckets`` around their execution: Spark otherwise deals
both sides anew by all keys of the join, for fear of a skewed one; a match is bounded.

The tables are external ones of the session's catalog; ``attach`` makes files that another
session stored known to this one. An empty model is stored as an empty table; a NULL match id
falls into one bucket, as a match does.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from crease.plans import marts

KEY = "match_id"
#: Balls of a bucket (some 350 MB of a task's memory), and the least and most buckets (Spark's own bound).
BUCKET_ROWS, FEWEST, MOST = 500_000, 8, 100_000
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def buckets_for(rows: int) -> int:
    """How many buckets balls of this number are stored in."""
    return min(MOST, max(FEWEST, -(-rows // BUCKET_ROWS)))


@contextmanager
def in_buckets(spark: SparkSession) -> Iterator[None]:
    """Plans made and run inside join bucket with bucket if the key is among the join's keys."""
    before = spark.conf.get(_ALL_KEYS)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_ALL_KEYS, before)


def attach(spark: SparkSession, name: str, path: str, buckets: int, schema) -> DataFrame:
    """The bucketed table stored at ``path``, known to this session's catalog as ``name``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet "
              f"CLUSTERED BY (`{KEY}`) INTO {buckets} BUCKETS LOCATION '{location}'")
    return spark.table(name)


class MatchTables:
    """Bucketed tables below ``root``, a run's own names in the catalog."""

    def __init__(self, spark: SparkSession, root: str, buckets: int):
        if buckets < 1:
            raise ValueError("buckets must be positive")
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._run = uuid.uuid4().hex[:12]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, name: str, rows: DataFrame) -> DataFrame:
        """Write ``rows``, which must not read this table, and read them back."""
        if KEY not in rows.columns:
            raise ValueError(f"{name} has no column {KEY}")
        known = f"crease_{name}_{self._run}"
        # dealt by the bucket's own hash: one file a bucket; no shuffle if rows lie so already
        dealt = rows.repartition(self.buckets, KEY)
        with in_buckets(self.spark):
            (dealt.write.format("parquet").mode("overwrite").bucketBy(self.buckets, KEY)
             .option("path", self.path(name)).saveAsTable(known))
        return self.spark.table(known)

    def drop(self) -> None:
        """Forget the names; the files stay."""
        for table in self.spark.catalog.listTables(pattern=f"crease_*_{self._run}"):
            self.spark.sql(f"DROP TABLE `{table.name}`")


def scorecards(deliveries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(batting, bowling) scorecards of stored ``deliveries``; run ``in_buckets`` (``store`` does),
    ball order, appearance orders, dismissals, aggregates and joins stay in the bucket of the match."""
    sequence = marts.fct_deliveries_sequence(deliveries)
    batting = marts.fct_batting_scorecard(deliveries, marts.fct_batting_order(sequence),
                                          marts.fct_dismissed_players(deliveries))
    return batting, marts.fct_bowling_scorecard(deliveries, marts.fct_bowling_order(sequence))
