"""Preference formatting of chosen and rejected conversations, in built-in functions only.

A pair is two conversations. Their longest common prefix of turns is rendered once as the
prompt; what follows in each is its completion. A mask of run lengths says which characters
of a completion are trained on: the words and the end mark of assistant turns.

Defined results: turns are ordered by number, then role, then text, nulls first; a null
role is rendered as ``none``, a null text as an empty one, yet either is equal only to
itself; repeated turns are turns; turns without a conversation id belong to no
conversation; if one conversation goes no further than the prompt its completion is empty
(both, if they are equal); empty tables give an empty result; other columns are ignored. A
conversation is one record and has to fit in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.common import materialise, salted_join

TRAINED = "assistant"
END = "<|end|>\n"
#: So many rejected conversations share one copy of their chosen one in the join.
PER_COPY = 256


def conversations(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation: conv_id and turns, an ordered array (turn, role, text)."""
    rows = turns.filter(F.col(conv).isNotNull()).groupBy(F.col(conv).alias("conv_id"))
    return rows.agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def _head(t: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(t["role"], F.lit("none")), F.lit("|>\n"))


def _body(t: Column) -> Column:
    return F.concat(F.coalesce(t["text"], F.lit("")), F.lit(END))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """Run lengths in characters, ``0:n`` not trained on, ``1:n`` trained on, by turn."""
    def runs(t: Column) -> Column:
        flag = F.when(t["role"] == TRAINED, "1").otherwise("0")
        return F.concat(F.lit("0:"), F.length(_head(t)).cast("string"), F.lit(","), flag,
                        F.lit(":"), F.length(_body(t)).cast("string"))
    return F.array_join(F.transform(turns, runs), ",")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs``: chosen_id, chosen, rejected_id, rejected (ordered turns). Adds n_prompt_turns,
    prompt, chosen_text, chosen_mask, rejected_text, rejected_mask."""
    def same(c: Column, i: Column) -> Column:
        r = F.get(F.col("rejected"), i)
        return c["role"].eqNullSafe(r["role"]) & c["text"].eqNullSafe(r["text"]) & r.isNotNull()

    first = F.array_position(F.transform("chosen", same), False)
    df = pairs.withColumn("n_prompt_turns", F.when(first > 0, first - 1)
                          .otherwise(F.size("chosen")).cast("long"))
    n = F.col("n_prompt_turns").cast("int")

    def rest(side: str) -> Column:
        return F.slice(side, n + 1, F.greatest(F.size(side) - n, F.lit(0)))

    df = df.withColumn("_c", rest("chosen")).withColumn("_r", rest("rejected"))
    return df.select("chosen_id", "rejected_id", "n_prompt_turns",
                     rendered(F.slice("chosen", F.lit(1), n)).alias("prompt"),
                     rendered(F.col("_c")).alias("chosen_text"), mask(F.col("_c")).alias("chosen_mask"),
                     rendered(F.col("_r")).alias("rejected_text"),
                     mask(F.col("_r")).alias("rejected_mask"))


def stored_conversations(turns: DataFrame) -> DataFrame:
    """``conversations``, written once, with the characters in assistant turns (_score) and two
    hashes of the first turn."""
    first = F.get(F.col("turns"), F.lit(0))
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda total, t: total + F.when(
        t["role"] == TRAINED, F.coalesce(F.length(t["text"]), F.lit(0))).otherwise(0))
    return materialise(conversations(turns).select(
        "conv_id", "turns", chars.alias("_score"), F.xxhash64(first["role"], first["text"]).alias("_p1"),
        F.xxhash64(F.lit(1), first["text"], first["role"]).alias("_p2")), "conversations")


def pairs_by_first_turn(convs: DataFrame) -> DataFrame:
    """Conversations that open with the same turn answer the same request: the one with most
    characters in assistant turns (then the least id) is chosen over each other one.

    The chosen conversation of a large group is copied once per PER_COPY rejected ones."""
    key = ["_p1", "_p2"]
    best = convs.groupBy(*key).agg(
        F.max(F.struct(F.col("_score"), (-F.col("conv_id")).alias("_id"))).alias("_best"),
        F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
            *key, (-F.col("_best._id")).alias("chosen_id"),
            F.ceil(F.col("_n") / PER_COPY).cast("int").alias("_copies"))
    best = materialise(best, "chosen")
    placed = salted_join(convs.select("conv_id", *key), best, key, F.col("conv_id"), how="inner")
    placed = placed.filter("conv_id != chosen_id").select(
        F.col("conv_id").alias("rejected_id"), "chosen_id",
        F.pmod(F.xxhash64("conv_id"), F.col("_copies")).cast("int").alias("_copy"))
    texts = convs.select("conv_id", "turns")
    chosen = (best.select("chosen_id", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy"))
              .join(texts, F.col("chosen_id") == F.col("conv_id"))
              .select("chosen_id", "_copy", F.col("turns").alias("chosen")))
    rejected = placed.join(texts.withColumnRenamed("turns", "rejected"),
                           F.col("rejected_id") == F.col("conv_id")).drop("conv_id")
    return rejected.join(chosen, ["chosen_id", "_copy"]).select(
        "chosen_id", "chosen", "rejected_id", "rejected")


def pairs_by_stale_reply(convs: DataFrame) -> DataFrame:
    """Of a conversation with several replies, up to the last one: as it is (chosen), and with
    the words of its first reply repeated in place of the last (rejected)."""
    replies = F.filter(F.sequence(F.lit(0), F.size("turns") - 1),
                       lambda i: F.get(F.col("turns"), i)["role"] == TRAINED)
    rows = convs.withColumn("_at", replies).filter(F.size("_at") > 1)
    last = F.element_at("_at", -1)
    stale = F.get(F.col("turns"), F.element_at("_at", 1))["text"]
    rows = rows.withColumn("chosen", F.slice("turns", F.lit(1), last + 1)).withColumn("_stale", stale)
    rejected = F.transform("chosen", lambda t, i: F.struct(
        t["turn"].alias("turn"), t["role"].alias("role"),
        F.when(i == F.size("chosen") - 1, F.col("_stale")).otherwise(t["text"]).alias("text")))
    return rows.select(F.col("conv_id").alias("chosen_id"), "chosen",
                       F.col("conv_id").alias("rejected_id"), rejected.alias("rejected"))
