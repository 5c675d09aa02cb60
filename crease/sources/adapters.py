"""Match data derived from the driver's TPC-H-style tables, so every query's work grows
with the input.

F-D (balls) from ``lineitem``: one match per supplier, innings by line status, ball
order by a running count over the line's full sort key.
F-M (matches) from ``supplier`` ⋈ ``nation`` ⋈ ``region``: venue, city, teams, toss,
outcome, players and registry, consistent with F-D's team names.

From these we also build the raw shapes the ingest path reads: per-ball typed
``delivery`` structs (as in the raw deliveries table), their JSON text, whole match
documents and ``(path, content)`` file rows.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease import schemas
from crease.operators.sequence import running_count
from crease.session import read_table, table_path

# --- fixed values of the adapters ---------------------------------------------------
FD_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_shipdate"]
DISMISSAL_BY_LINE = ["bowled", "caught", "lbw", "run out", "stumped", "retired hurt",
                     "hit wicket"]
FORMATS = ["T20", "ODI", "Test"]
SQUAD = 11
# ---------------------------------------------------------------------------------------


def fd_raw(spark: SparkSession, sf_dir: str, keep_line: bool = False,
           match_ids: DataFrame | None = None) -> DataFrame:
    """Balls with raw (nullable) extras, before the staging defaults. ``keep_line``
    also returns the source line number as ``_ln``; ``match_ids`` leaves only the balls of
    these matches, before any window."""
    # Partition the position window by the derived (match_id, innings_number) rather
    # than the raw columns, so the ball-sequence window and per-innings aggregates
    # downstream reuse this exchange instead of shuffling the balls again.
    li = read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate", "CAST(l_suppkey AS INT) AS match_id",
        f"CAST({_INN} AS INT) AS innings_number")
    if match_ids is not None:
        li = li.join(match_ids, "match_id", "left_semi")
    seq = running_count(li, ["match_id", "innings_number"], FD_ORDER, "_pos")
    return seq.selectExpr(*FD_EXPRS, *(["l_linenumber AS _ln"] if keep_line else []))


# Balls from lineitem rows (SQL expressions: one JVM call per column, not per operator).
_INN = "IF(l_linestatus = 'F', 0, 1)"
_WIDE = "l_partkey % 17 = 0"
_OUT = "l_orderkey % 19 = 0"
_DISMISSALS = ", ".join(f"'{k}'" for k in DISMISSAL_BY_LINE)
FD_EXPRS = [
    "match_id",
    "md5(CAST(match_id AS STRING)) AS hash_id",
    "innings_number",
    "CAST((_pos - 1) DIV 6 AS INT) AS over_number",
    "CAST((_pos - 1) % 6 AS INT) AS ball_in_over",
    "concat('T', CAST((match_id + innings_number) % 10 AS STRING)) AS team",
    "CAST(NULL AS BOOLEAN) AS super_over",
    f"concat('P', CAST(l_partkey % {SQUAD} AS STRING)) AS batter",
    f"concat('P', CAST((l_partkey + 1 + l_linenumber) % {SQUAD} AS STRING)) AS non_striker",
    "concat('B', CAST(l_orderkey % 7 AS STRING)) AS bowler",
    f"CAST(IF({_WIDE}, 0, CAST(l_quantity AS INT) % 7) AS INT) AS batter_runs",
    f"CAST(IF({_WIDE}, 1, NULL) AS INT) AS wides_raw",
    "CAST(IF(l_partkey % 29 = 0, 1, NULL) AS INT) AS noballs_raw",
    f"CAST(IF(l_orderkey % 23 = 0 AND NOT ({_WIDE}), 1, NULL) AS INT) AS byes_raw",
    f"CAST(IF(l_orderkey % 31 = 0 AND NOT ({_WIDE}), 1, NULL) AS INT) AS legbyes_raw",
    f"IF({_OUT}, concat('P', CAST(l_partkey % {SQUAD} AS STRING)), NULL) AS player_out",
    f"IF({_OUT}, element_at(array({_DISMISSALS}), l_linenumber), NULL) AS dismissal_kind",
]

_EXTRA_KEYS = ["wides", "noballs", "byes", "legbyes"]
_EXTRAS_TOTAL = " + ".join(f"coalesce({k}_raw, 0)" for k in _EXTRA_KEYS)
_EXTRAS_MAP = ("map_filter(map(" + ", ".join(f"'{k}', {k}_raw" for k in _EXTRA_KEYS)
               + "), (k, v) -> v IS NOT NULL)")
DELIVERY_SQL = f"""CAST(named_struct(
    'batter', batter, 'non_striker', non_striker, 'bowler', bowler,
    'runs', named_struct('batter', batter_runs, 'extras', {_EXTRAS_TOTAL},
                         'total', batter_runs + {_EXTRAS_TOTAL}),
    'extras', IF(size({_EXTRAS_MAP}) > 0, {_EXTRAS_MAP}, NULL),
    'wickets', IF(player_out IS NOT NULL,
                  array(named_struct('player_out', player_out, 'kind', dismissal_kind)), NULL)
) AS {schemas.DELIVERY.simpleString()})"""


# F-D straight to the staged ball columns (what the staging projection yields from the
# raw delivery object, without building the object per row).
FD_STAGED_EXPRS = [
    "match_id", "hash_id", "innings_number", "team", "over_number", "ball_in_over",
    "super_over",
    f"CAST(batter_runs + {_EXTRAS_TOTAL} AS INT) AS runs",
    "batter_runs",
    *[f"CAST(coalesce({k}_raw, 0) AS INT) AS {k}" for k in _EXTRA_KEYS],
    f"CAST({_EXTRAS_TOTAL} AS INT) AS extras",
    "batter", "non_striker", "bowler",
    "wides_raw IS NULL AND noballs_raw IS NULL AS is_legal",
    "player_out", "dismissal_kind AS dismissal_mode",
]


def delivery_struct() -> Column:
    """The raw per-ball object: extras holds only the keys that are present."""
    return F.expr(DELIVERY_SQL)


def fd_deliveries_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-D in the raw deliveries-table shape (typed delivery struct)."""
    return fd_raw(spark, sf_dir).select(
        "match_id", "hash_id", F.col("innings_number").alias("n_innings"), "team",
        F.col("over_number").alias("n_over"), F.col("ball_in_over").alias("n_delivery"),
        "super_over", delivery_struct().alias("delivery"))


def fd_deliveries_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-D as raw rows whose ``delivery`` is JSON text, as a loader would store it."""
    return fd_deliveries_raw(spark, sf_dir).withColumn(
        "delivery", F.to_json("delivery"))


def fm_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-M: one row per match with flat attributes. nation (25 rows) and region (5 rows)
    have a fixed size in this schema, so they are broadcast."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    j = (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
         .join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    return j.selectExpr(
        "*", "concat('T', CAST(s_suppkey % 10 AS STRING)) AS team_a",
        "concat('T', CAST((s_suppkey + 1) % 10 AS STRING)) AS team_b").selectExpr(*FM_EXPRS)


_NO_WIN = "s_suppkey % 11 = 0"
_NO_TOSS = "s_suppkey % 13 = 0"
_FORMATS = ", ".join(f"'{f}'" for f in FORMATS)
FM_EXPRS = [
    "CAST(s_suppkey AS INT) AS match_id",
    "md5(CAST(CAST(s_suppkey AS INT) AS STRING)) AS hash_id",
    "n_name AS venue", "r_name AS city", "team_a", "team_b",
    f"element_at(array({_FORMATS}), CAST(s_nationkey % 3 + 1 AS INT)) AS format",
    "IF(s_suppkey % 2 = 0, 'male', 'female') AS gender",
    "date_add(DATE'2024-01-01', CAST(s_suppkey * 37 % 730 AS INT)) AS start_date",
    "r_name AS event_name",
    "CAST(s_suppkey % 60 + 1 AS INT) AS event_match_number",
    "IF(s_suppkey % 60 = 59, 'Final', NULL) AS event_stage",
    f"IF({_NO_TOSS}, NULL, IF(s_suppkey % 2 = 0, team_a, team_b)) AS toss_winner",
    f"IF({_NO_TOSS}, NULL, IF(s_suppkey % 3 = 0, 'field', 'bat')) AS toss_decision",
    f"IF({_NO_WIN}, NULL, IF(s_suppkey % 4 % 2 = 0, team_a, team_b)) AS winner",
    f"IF({_NO_WIN}, IF(s_suppkey % 2 = 0, 'tie', 'no result'), NULL) AS result",
    f"CAST(IF(NOT ({_NO_WIN}) AND s_suppkey % 4 < 2, s_suppkey % 50 + 1, NULL) AS INT) AS margin_runs",
    f"CAST(IF(NOT ({_NO_WIN}) AND s_suppkey % 4 >= 2, s_suppkey % 10 + 1, NULL) AS INT) AS margin_wickets",
    f"CAST(IF(NOT ({_NO_WIN}) AND s_suppkey % 8 = 0, 1, NULL) AS INT) AS margin_innings",
    f"IF({_NO_WIN}, NULL, array(concat('P', CAST(s_suppkey % {SQUAD} AS STRING)))) AS player_of_match",
]


def _squad(prefix: str) -> str:
    """[prefix0 .. prefix10] built from a sequence, not literals."""
    return f"transform(sequence(0, {SQUAD - 1}), i -> concat('{prefix}', CAST(i AS STRING)))"


_REGISTERED = (f"filter(concat({_squad('P')}, {_squad('Q')}), "
               f"x -> NOT endswith(x, '{SQUAD - 1}'))")
INFO_SQL = f"""CAST(named_struct(
    'match_type', format, 'gender', gender,
    'dates', array(date_format(start_date, 'yyyy-MM-dd')),
    'venue', venue, 'city', city,
    'event', named_struct('name', event_name, 'match_number', event_match_number,
                          'stage', event_stage),
    'toss', named_struct('winner', toss_winner, 'decision', toss_decision),
    'outcome', named_struct('winner', winner, 'result', result,
                            'by', IF(winner IS NOT NULL,
                                     named_struct('runs', margin_runs, 'wickets', margin_wickets,
                                                  'innings', margin_innings), NULL)),
    'player_of_match', player_of_match,
    'teams', array(team_a, team_b),
    'players', map(team_a, {_squad('P')}, team_b, {_squad('Q')}),
    'registry', named_struct('people', map_from_arrays({_REGISTERED},
                             transform({_REGISTERED}, x -> concat('id_', x))))
) AS {schemas.INFO.simpleString()})"""


def info_struct() -> Column:
    """The match document's ``info`` object built from F-M columns. Each team lists
    P0..P10 / Q0..Q10; the registry maps every name but the last of each squad to
    'id_<name>' (so two players of a match have no id)."""
    return F.expr(INFO_SQL)


def fm_match_info_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON match-info document per match (the raw matches table shape)."""
    return fm_matches(spark, sf_dir).select(
        "match_id", "hash_id", F.to_json(F.struct(info_struct().alias("info"))).alias("data"))


def match_documents(spark: SparkSession, sf_dir: str, fd: DataFrame | None = None,
                    fm: DataFrame | None = None) -> DataFrame:
    """Whole match documents ``{"info": ..., "innings": [{team, overs: [{over,
    deliveries: [...]}]}]}`` as (match_id, hash_id, doc struct).

    Nesting is rebuilt level by level (balls of an over, overs of an innings, innings of
    a match); array order = ball order. A document is one source file, i.e. one match:
    its size is bounded by the match, not by the table."""
    fd = fd if fd is not None else fd_raw(spark, sf_dir)
    fm = fm if fm is not None else fm_matches(spark, sf_dir)
    def by_first(arr, key: str):
        """Sort an array of structs by one orderable field (the payload holds maps,
        which have no ordering)."""
        return F.array_sort(arr, lambda a, b: F.when(a[key] < b[key], -1)
                            .when(a[key] > b[key], 1).otherwise(0))

    balls = fd.select("match_id", "innings_number", "team", "super_over", "over_number",
                      "ball_in_over", delivery_struct().alias("d"))
    overs = (balls.groupBy("match_id", "innings_number", "over_number")
             .agg(F.first("team").alias("team"), F.first("super_over").alias("super_over"),
                  by_first(F.collect_list(F.struct("ball_in_over", "d")), "ball_in_over")
                  .alias("b"))
             .select("match_id", "innings_number", "team", "super_over",
                     F.struct(F.col("over_number").alias("over"),
                              F.transform("b", lambda x: x["d"]).alias("deliveries"))
                     .alias("o"), "over_number"))
    innings = (overs.groupBy("match_id", "innings_number")
               .agg(F.first("team").alias("team"), F.first("super_over").alias("super_over"),
                    by_first(F.collect_list(F.struct("over_number", "o")), "over_number")
                    .alias("os"))
               .select("match_id", "innings_number",
                       F.struct("team", "super_over",
                                F.transform("os", lambda x: x["o"]).alias("overs"))
                       .alias("inn")))
    per_match = (innings.groupBy("match_id")
                 .agg(by_first(F.collect_list(F.struct("innings_number", "inn")),
                               "innings_number").alias("is"))
                 .select("match_id", F.transform("is", lambda x: x["inn"]).alias("innings")))
    return (fm.join(per_match, "match_id", "left")
            .select("match_id", "hash_id",
                    F.struct(info_struct().alias("info"), F.col("innings"))
                    .cast(schemas.MATCH_DOC).alias("doc")))


def match_files(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None,
                root: str = "landing") -> DataFrame:
    """Documents as file rows ``(path, content)`` named ``<match_id>.json``."""
    docs = docs if docs is not None else match_documents(spark, sf_dir)
    return docs.select(
        F.concat(F.lit(f"{root}/"), F.col("match_id").cast("string"), F.lit(".json"))
        .alias("path"),
        F.encode(F.to_json("doc"), "UTF-8").alias("content"),
        "match_id")
