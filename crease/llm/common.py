"""Helpers shared by the corpus operators: word columns, scratch tables, salted joins and
a fixed-size membership filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.session import scratch_path, table_path

#: A word is a run of characters other than space and U+0009..U+000D.
SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SEPARATOR_CHARS = " \t\n\x0b\x0c\r"
#: A hot key is dealt over this many salts.
SALTS = 64
#: The small side of a salted join is broadcast up to so many rows.
BROADCAST_ROWS = 50_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents"))


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read it back.

    Cuts lineage without keeping anything on an executor: a lost executor costs only the
    tasks it was running."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Column,
                how: str = "left", salts: int = SALTS, rows: int | None = None) -> DataFrame:
    """Join many ``left`` rows to few ``right`` rows when one key may own a third of ``left``.

    ``right`` has one narrow row per key. Up to BROADCAST_ROWS it is broadcast (it is counted
    for that, unless the caller knows a bound, ``rows``). Beyond, it is repeated once per salt
    and ``left`` takes its salt from ``spread``, so a hot key is shared by ``salts`` tasks; the
    planner does not see how large the repeated side is, so it is told to shuffle it. Null
    keys match null keys."""
    if rows is None:
        right = materialise(right, "join-side")
        rows = right.count()
    keys = [f"__{i}" for i in range(len(on))]
    small = right.select(*[F.col(c).alias(k) for c, k in zip(on, keys)],
                         *[c for c in right.columns if c not in on])
    big, cond = left, F.lit(True)
    if rows <= BROADCAST_ROWS:
        small = F.broadcast(small)
    else:
        salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt")
        small = small.select("*", salt).hint("merge")
        big = left.withColumn("__dealt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
        cond = big["__dealt"] == small["__salt"]
    for c, k in zip(on, keys):
        cond = cond & big[c].eqNullSafe(small[k])
    return big.join(small, cond, how).drop("__dealt", "__salt", *keys)


def key_filter(keys: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """Bitmap of the hashed ``columns`` of ``keys``: at most ``bits`` / 32768 rows of 4 KB.

    Its size depends on ``bits`` alone, so it may always be broadcast."""
    slot = F.pmod(F.xxhash64(*columns), F.lit(bits)) + 1
    return (keys.select(F.bitmap_bucket_number(slot).alias("__bucket"),
                        F.bitmap_bit_position(slot).alias("__bit"))
            .groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__map")))


def may_contain(df: DataFrame, bitmap: DataFrame, columns: Sequence[str], bits: int,
                out: str) -> DataFrame:
    """Add boolean ``out``: false only if the key is certainly not in the filtered set."""
    slot = F.pmod(F.xxhash64(*columns), F.lit(bits)) + 1
    byte = F.conv(F.hex(F.substring("__map", (F.col("__at") / 8).cast("int") + 1, F.lit(1))),
                  16, 10).cast("int")
    hit = F.expr("shiftright(__byte, __at % 8) & 1") == 1
    return (df.withColumn("__of", F.bitmap_bucket_number(slot))
            .withColumn("__at", F.bitmap_bit_position(slot).cast("int"))
            .join(F.broadcast(bitmap), F.col("__of") == F.col("__bucket"), "left")
            .withColumn("__byte", byte)
            .withColumn(out, F.coalesce(hit, F.lit(False)))
            .drop("__of", "__at", "__bucket", "__map", "__byte"))
