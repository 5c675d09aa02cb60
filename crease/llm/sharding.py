"""Shards of near-equal bytes by histogram sort, in built-in functions only.

Rows are ordered by a 64-bit key: a hash of the text above a hash of the id, so equal
texts stand side by side and yet may be cut. The boundaries between shards are found by
refinement: all partitions count the exact bytes below candidate boundaries, the bracket
of each boundary that is still wider than the tolerance gets FANOUT finer candidates, and
so on. The driver sees at most FANOUT counts for each open bracket. Then one range
exchange sorts the rows, and a row's slot is its place in its partition plus the counts of
the partitions before it (a table as long as there are partitions).

Defined results: a null text has 16 bytes and CRC 0; equal keys (repeated rows) stay in one
shard and get slots of their own; an empty table gives an empty result; columns of the
input other than those named are ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.common import materialise

OVERHEAD = 16
FANOUT_BITS = 8
#: A boundary may miss its target by this share of a shard.
TOLERANCE = 1e-4


def order_key(text: Column, doc_id: Column) -> Column:
    """Signed 64-bit key: 32 bits of the text's hash, then 31 bits of the id's."""
    high = F.shiftleft(F.shiftright(F.xxhash64(text), 32), 32)
    return high.bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.lit(7), doc_id), 33))


def splitters(rows: DataFrame, key: str, weight: str, shards: int,
              tolerance: float = TOLERANCE) -> list[int]:
    """Keys s_1 <= .. <= s_(shards-1): shard i holds the keys from s_i up to s_(i+1).

    A bracket is (first key, bits left in it); candidates below it are its equal parts."""
    total = rows.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    targets = [total * i / shards for i in range(1, shards)]
    slack = tolerance * total / shards
    # per target: bracket start, log2 of its width, weight below its start
    open_at = {i: (-(1 << 63), 64, 0) for i in range(len(targets))}
    found: dict[int, int] = {}
    while open_at:
        bits = next(iter(open_at.values()))[1]
        step = bits - FANOUT_BITS
        starts = sorted({start >> bits for start, _, _ in open_at.values()})
        inside = (rows if bits == 64 else
                  rows.filter(F.shiftright(F.col(key), bits).isin(starts)))
        counts = {r[0]: r[1] for r in inside.groupBy(
            F.shiftright(F.col(key), step) if step else F.col(key)).agg(F.sum(weight)).collect()}
        still = {}
        for i, (start, _, below) in open_at.items():
            first = start >> step
            sums = list(itertools.accumulate(
                (counts.get(first + j, 0) for j in range(1 << FANOUT_BITS)), initial=below))
            j = max(k for k, s in enumerate(sums[:-1]) if s <= targets[i])
            ends = ((targets[i] - sums[j], j), (abs(sums[j + 1] - targets[i]), j + 1))
            miss, edge = min(ends)
            if miss <= slack or step == 0:
                found[i] = min((first + edge) << step, (1 << 63) - 1)
            else:
                still[i] = ((first + j) << step, step, sums[j])
        open_at = still
    return [found[i] for i in range(len(targets))]


def shard_by_bytes(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text",
                   keep_text: bool = False, tolerance: float = TOLERANCE) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot (and ``text`` if asked for)."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = materialise(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(t) + OVERHEAD).cast("long").alias("size"),
        F.crc32(t.cast("binary")).cast("long").alias("text_crc32"),
        order_key(t, F.col(doc_id)).alias("_key"),
        *([F.col(text).alias("text")] if keep_text else [])), "shard-rows")
    cuts = splitters(rows, "_key", "size", shards, tolerance)
    shard = F.lit(0)
    for s in cuts:
        shard = shard + (F.col("_key") >= F.lit(s)).cast("int")
    spark = docs.sparkSession
    tasks = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = (rows.withColumn("shard", shard)
              .repartitionByRange(tasks, "_key", "doc_id")
              .sortWithinPartitions("_key", "doc_id")
              .withColumn("_place", F.monotonically_increasing_id()))
    placed = materialise(ranged, "shard-sorted")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    runs = placed.groupBy("_part", "shard").agg(F.min("_place").alias("_first"),
                                                F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    runs = runs.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    runs = runs.select("_part", "shard", (F.col("_offset") - F.col("_first")).alias("_shift"))
    # one row per partition and shard in it: at most tasks + shards - 1 rows
    return (placed.join(F.broadcast(runs), ["_part", "shard"])
            .withColumn("slot", (F.col("_place") + F.col("_shift")).cast("long"))
            .drop("_key", "_place", "_part", "_shift"))
