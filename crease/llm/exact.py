"""Exact dedup by progressive refinement, in built-in functions only.

Three rounds, each looking only at what the one before left undecided: texts of equal byte
length; of those, texts with an equal hash of their first PREFIX characters; of those, texts
with an equal SHA-256 of the whole. What survives a round is passed to the next scan as a
bitmap of fixed size (hashed keys; a false hit costs one needless hash, never a result),
so no text is shuffled and full content is hashed only for surviving groups.

Defined results: a null text is an empty one; of equal texts the row with the largest
doc_id stays (a null doc_id is below all others, and of rows that share the largest one
stays); every row gets a result, repeated rows each their own; an empty table gives an
empty result; columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.common import key_filter, materialise, may_contain, salted_join

PREFIX = 128
#: Size of the filter passed between rounds: 2**22 bits are 512 KB.
FILTER_BITS = 1 << 22


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                digest_all: bool = False, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Per row: doc_id, keep_id, group_size (long), kept, text_sha256 (binary).

    ``text_sha256`` is null for texts that were told apart before the last round, unless
    ``digest_all`` asks for it."""
    base = docs.select(F.col(doc_id).alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("_text"))
    base = base.withColumn("_len", F.octet_length("_text").cast("long"))

    def shared(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)

    lengths = key_filter(shared(base, ["_len"]), ["_len"], filter_bits)
    first = may_contain(base, lengths, ["_len"], filter_bits, "_same_len")
    first = first.withColumn("_prefix", F.when(
        F.col("_same_len"), F.xxhash64(F.substring("_text", 1, PREFIX))))
    starts = ["_len", "_prefix"]
    prefixes = key_filter(shared(first.filter("_same_len"), starts), starts, filter_bits)
    second = may_contain(first, prefixes, starts, filter_bits, "_same_start")
    undecided = F.col("_same_len") & F.col("_same_start")
    digest: Column = F.unhex(F.sha2("_text", 256))
    rows = materialise(second.select(
        "doc_id", F.monotonically_increasing_id().alias("_row"),
        undecided.alias("_undecided"),
        (digest if digest_all else F.when(undecided, digest)).alias("text_sha256")), "exact")
    order = F.struct(F.col("doc_id"), (-F.col("_row")).alias("_row"))
    groups = (rows.filter("_undecided").groupBy("text_sha256")
              .agg(F.max(order).alias("_keep"), F.count(F.lit(1)).alias("_size"))
              .filter("_size > 1"))
    joined = salted_join(rows, groups, ["text_sha256"], F.col("_row"))
    alone = F.col("_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_keep.doc_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_keep._row") == -F.col("_row"))).alias("kept"),
        "text_sha256")
