"""Mixing sources to target weights as a min-cost flow over membership patterns.

A document may belong to several sources. Documents are summed by the set of sources they
belong to (the pattern); the flow runs between patterns and source quotas only, so its
size depends on the number of distinct sets, not on documents. A pattern offers its words
once at no cost, again at cost 1 and a third time at cost 2, so repetition is spread evenly
before anything is taken thrice. The flow out of a pattern is then laid along its
documents in seeded order, lap after lap; the last, partial lap takes the documents that
fit and, in two repair rounds, further ones that fit into what is still missing.

Defined results: a null text has no words; a null source is a source, sorted last; rows
that repeat are documents of their own; sources without words get a target of 0; an empty
table gives an empty result; other columns can be carried along.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.common import WORD, materialise, salted_join

MAX_TAKES = 3
BIN_BITS = 16
REPAIRS = 2
WEIGHTS = (1, 2, 3)


def targets(sizes: dict[str | None, int], weights: Sequence[int] = WEIGHTS,
            most: int = MAX_TAKES) -> dict[str | None, Fraction]:
    """Share all words by weight; a target stops at ``most`` times its source, the rest is
    shared again by weight among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = Fraction(sum(sizes.values())), set(names), {}
    while free:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > most * sizes[s]]
        if not over:
            return out | {s: share * weight[s] for s in free}
        for s in over:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
            free.remove(s)
    return out


def route(supply: list[tuple[int, list]], quota: dict, most: int = MAX_TAKES) -> list[dict]:
    """Min-cost flow: per pattern {source: words}. ``supply``: (words of one lap, sources).

    Cost grows only with the lap, so the cheapest flow fills lap by lap: offer the next lap
    of every pattern, send it on directly, then along augmenting paths over shared sources."""
    room = dict(quota)
    flow: list[dict] = [{} for _ in supply]
    rest = [0] * len(supply)
    members: dict = {}
    for p, (_, sources) in enumerate(supply):
        for s in sources:
            members.setdefault(s, []).append(p)
    for _ in range(most):
        for p, (words, sources) in enumerate(supply):
            rest[p] += words
            for s in sources:
                sent = min(rest[p], room[s])
                if sent:
                    flow[p][s] = flow[p].get(s, 0) + sent
                    rest[p] -= sent
                    room[s] -= sent
        while path := _augmenting(supply, flow, rest, room, members):
            start, sent = path[0][0], min([rest[path[0][0]], room[path[-1][1]],
                                           *(flow[q][s] for (_, s), (q, _) in zip(path, path[1:]))])
            rest[start] -= sent
            room[path[-1][1]] -= sent
            for i, (p, s) in enumerate(path):
                flow[p][s] = flow[p].get(s, 0) + sent
                if i + 1 < len(path):
                    flow[path[i + 1][0]][s] -= sent
    return flow


def _augmenting(supply, flow, rest, room, members) -> list[tuple]:
    """Shortest path of (pattern, source) steps from spare words to spare quota."""
    if not any(room.values()):
        return []
    queue = deque(p for p, r in enumerate(rest) if r and len(supply[p][1]) > 0)
    came: dict = {p: None for p in queue}
    via: dict = {}
    while queue:
        p = queue.popleft()
        for s in supply[p][1]:
            if s in via:
                continue
            via[s] = p
            if room[s]:
                path = [(p, s)]
                while came[p] is not None:
                    s = came[p]
                    p = via[s]
                    path.append((p, s))
                return path[::-1]
            for q in members[s]:
                if q not in came and flow[q].get(s, 0):
                    came[q] = s
                    queue.append(q)
    return []


def running_start(rows: DataFrame, group: str, order: str, size: str, out: str) -> DataFrame:
    """Add ``out``: words of the group's rows that come earlier in the order of ``order``.

    Prefix sums at two levels: over 2**BIN_BITS ranges of the hash, then inside a range,
    so a group that holds a third of all rows is spread over as many windows."""
    rows = rows.withColumn("_bin", F.shiftright(F.col(order), 64 - BIN_BITS))
    bins = rows.groupBy(group, "_bin").agg(F.sum(size).alias("_words"))
    upto = Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(group, "_bin", F.coalesce(F.sum("_words").over(upto), F.lit(0)).alias("_off"))
    inside = (Window.partitionBy(group, "_bin").orderBy(order, "_row")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("_in", F.coalesce(F.sum(size).over(inside), F.lit(0)))
            .join(bins, [group, "_bin"]).withColumn(out, F.col("_off") + F.col("_in"))
            .drop("_bin", "_off", "_in"))


def _measured(docs: DataFrame, doc_id: str, text: str, sources: Column | None, seed: int,
              whole: bool) -> DataFrame:
    """doc_id, size, members, _seed and _row of ``docs``, and with ``whole`` its columns as _doc."""
    member = F.array(F.col("source")) if sources is None else sources
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")] if whole else []
    return materialise(docs.select(
        *kept, F.col(doc_id).alias("doc_id"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.array_sort(F.array_distinct(member)).alias("members"),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("_seed"),
        F.monotonically_increasing_id().alias("_row")), "mix-docs" if whole else "mix-rows")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
        sources: Column | None = None, weights: Sequence[int] = WEIGHTS, seed: int = 17,
        most: int = MAX_TAKES) -> tuple[DataFrame, DataFrame]:
    """(rows, documents). ``rows``: _row, doc_id, size, members, copies, taken_for (array of
    struct(source, source_size, target), one per copy; empty for none), own (the same for
    the first source). ``documents``: _row and the columns of ``docs`` as stored.

    ``sources``: array column of the sources a document belongs to (default: its ``source``).
    """
    stored = _measured(docs, doc_id, text, sources, seed, whole=True)
    return _mixed(stored.drop("_doc"), weights, most), stored.select("_row", "_doc")


def mix_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              sources: Column | None = None, weights: Sequence[int] = WEIGHTS, seed: int = 17,
              most: int = MAX_TAKES) -> DataFrame:
    """The ``rows`` of ``mix`` alone: texts are read once and not kept."""
    return _mixed(_measured(docs, doc_id, text, sources, seed, whole=False), weights, most)


def _laid(rows: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``rows`` with their pattern's share of the flow (lap, routed, cuts), _start, _laps (whole
    laps), _rest (words of the partial lap) and _round: 0 for a document that the partial lap
    takes, 1, 2, .. for one that a repair round adds, else null."""
    spark = rows.sparkSession
    # one row per distinct set of sources
    patterns = [(r["members"], r["n"]) for r in
                rows.groupBy("members").agg(F.sum("size").alias("n")).collect()]
    sizes: dict[str | None, int] = {}
    for members, n in patterns:
        for s in members:
            sizes[s] = sizes.get(s, 0) + n
    # documents of several sources count once in what there is to share
    total = Fraction(sum(n for _, n in patterns))
    goal = targets(sizes, weights, most)
    if goal and sum(goal.values()) > total:
        goal = {s: t * total / sum(goal.values()) for s, t in goal.items()}
    flows = route([(n, list(m)) for m, n in patterns], {s: round(t) for s, t in goal.items()}, most)
    table = []
    for (members, n), flow in zip(patterns, flows):
        at, cuts = 0, []
        for s in members:
            cuts.append((s, sizes[s], float(goal[s]), at, at + flow.get(s, 0)))
            at += flow.get(s, 0)
        table.append((members, n, at, cuts))
    plan = spark.createDataFrame(table, "members array<string>, lap long, routed long, cuts array<"
                                 "struct<source:string,source_size:long,target:double,"
                                 "begin:long,finish:long>>")
    rows = salted_join(rows, plan, ["members"], F.col("_row"), how="inner")
    rows = rows.withColumn("_group", F.xxhash64("members"))
    rows = running_start(rows, "_group", "_seed", "size", "_start")
    full = F.when(F.col("lap") > 0, F.expr("routed div lap")).otherwise(F.lit(0))
    rest = F.col("routed") - full * F.col("lap")
    rows = (rows.withColumn("_laps", full)
            .withColumn("_round", F.when(F.col("_start") + F.col("size") <= rest, F.lit(0)))
            .withColumn("_rest", rest))
    rows = materialise(rows, "mix-laps")
    for n in range(1, REPAIRS + 1):
        got = rows.groupBy("_group").agg(
            F.sum(F.when(F.col("_round").isNotNull(), F.col("size")).otherwise(0)).alias("_got"))
        missing = salted_join(rows.filter("_round IS NULL"), got, ["_group"], F.col("_row"), "inner")
        short = F.col("_rest") - F.col("_got")
        fits = missing.withColumn("_short", short).filter("size > 0 AND size <= _short")
        fits = running_start(fits.select("_row", "_group", "_seed", "size", "_short"),
                             "_group", "_seed", "size", "_at")
        more = fits.filter("_at + size <= _short").select("_row", F.lit(n).alias("_more"))
        rows = materialise(rows.join(more, "_row", "left")
                           .withColumn("_round", F.coalesce("_round", "_more"))
                           .drop("_more"), "mix-repair")
    return rows


def _mixed(rows: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    rows = _laid(rows, weights, most)
    copies = (F.col("_laps") + F.col("_round").isNotNull().cast("long")).cast("int")
    middle = F.col("_start") + F.expr("size div 2")

    def owner(lap: Column) -> Column:
        at = F.least(middle + lap * F.col("lap"), F.col("routed") - 1)
        mine = F.filter("cuts", lambda c: (c["begin"] <= at) & (at < c["finish"]))
        return F.get(mine, F.lit(0))

    def public(c: Column) -> Column:
        return F.struct(c["source"].alias("source"), c["source_size"].alias("source_size"),
                        c["target"].alias("target"))

    none = F.slice(F.transform("cuts", public), 1, 0)
    laps = F.transform(F.sequence(F.lit(0), copies - 1), lambda i: public(owner(i)))
    return rows.select(
        "_row", "doc_id", "size", "members", copies.alias("copies"),
        F.when(copies > 0, laps).otherwise(none).alias("taken_for"),
        F.get(F.transform("cuts", public), F.lit(0)).alias("own"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    sources: Column | None = None, weights: Sequence[int] = WEIGHTS, seed: int = 17,
                    most: int = MAX_TAKES) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken.

    What a round takes of a pattern is the beginning of the seeded order of the documents that
    fit, so one row per pattern (the last document of each round and the words that were
    missing) tells every document its copies: the texts are not shuffled."""
    stored = _measured(docs, doc_id, text, sources, seed, whole=True)
    place = F.struct("_seed", "_row")
    rounds = range(REPAIRS + 1)
    rules = _laid(stored.drop("_doc"), weights, most).groupBy("members", "_laps", "_rest").agg(
        *[F.max(F.when(F.col("_round") == n, place)).alias(f"_last{n}") for n in rounds],
        *[F.coalesce(F.sum(F.when(F.col("_round") < n, F.col("size"))), F.lit(0)).alias(f"_got{n}")
          for n in rounds])
    rows = salted_join(stored, rules, ["members"], F.col("_row"), how="inner")
    extra = F.lit(False)
    for n in rounds:
        fits = (F.col("size") > 0) & (F.col("size") <= F.col("_rest") - F.col(f"_got{n}"))
        taken = F.coalesce(place <= F.col(f"_last{n}"), F.lit(False))
        extra = extra | (taken & fits if n else taken)
    copies = (F.col("_laps") + extra.cast("long")).cast("int")
    return (rows.withColumn("_copies", copies).filter("_copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]))
