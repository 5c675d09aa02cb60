"""Mart models: ball sequence, batting/bowling orders, dismissals, scorecards, match
summary.

Every row depends on one match only. Scorecards aggregate balls per (match, innings,
player) *before* joining the order tables, so the join sees one row per player instead
of one per ball (same result: each ball matches exactly one order row). Both sides of such a
join grow with the matches, so it is a shuffled one by a hint: the planner would judge a stored
table by the size of its files, and an order takes a byte a row there, some hundred in a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.functions import (BOWLER_WICKETS, count_when, half_up_decimal, ordered_concat,
                              overs_display, result_text)
from crease.operators.sequence import appearance_order, running_count

INNINGS_KEY = ["match_id", "innings_number"]


def fct_deliveries_sequence(deliveries: DataFrame) -> DataFrame:
    seq = running_count(deliveries, INNINGS_KEY, ["over_number", "ball_in_over"],
                        "ball_in_innings")
    return seq.select("match_id", "innings_number", "ball_in_innings", "batter",
                      "non_striker", "bowler")


def fct_batting_order(sequence: DataFrame) -> DataFrame:
    """Striker (priority 1) before non-striker (2) when both first appear on one ball."""
    return appearance_order(sequence, INNINGS_KEY, "ball_in_innings",
                            [("batter", 1), ("non_striker", 2)],
                            "player_name", "batting_position")


def fct_bowling_order(sequence: DataFrame) -> DataFrame:
    return appearance_order(sequence, INNINGS_KEY, "ball_in_innings", [("bowler", 1)],
                            "bowler", "bowling_position")


def fct_dismissed_players(deliveries: DataFrame) -> DataFrame:
    return (deliveries.filter(F.col("player_out").isNotNull())
            .select("match_id", "innings_number", "player_out").distinct())


def fct_batting_scorecard(deliveries: DataFrame, batting_order: DataFrame,
                          dismissed: DataFrame) -> DataFrame:
    """Players who never faced a ball are absent (inner join); a ball counts as faced
    unless it is a wide; a player is dismissed if out on any ball of the innings."""
    # team is constant within an innings (see int_innings): a key, not a string aggregate
    stats = deliveries.groupBy("match_id", "innings_number", "team",
                               F.col("batter").alias("player_name")).agg(
        F.min("super_over").alias("_so"),
        F.sum("batter_runs").cast("bigint").alias("runs"),
        count_when(F.col("wides") == 0).alias("balls"))
    out = dismissed.select("match_id", "innings_number",
                           F.col("player_out").alias("player_name"),
                           F.lit(True).alias("_out"))
    return (batting_order.hint("merge").join(stats, ["match_id", "innings_number", "player_name"])
            .join(out.hint("merge"), ["match_id", "innings_number", "player_name"], "left")
            .select("match_id", "innings_number", "batting_position",
                    F.coalesce("_so", F.lit(False)).alias("is_super_over"),
                    "team", "player_name",
                    F.coalesce("runs", F.lit(0)).cast("bigint").alias("runs"),
                    "balls",
                    F.col("_out").isNotNull().alias("is_dismissed")))


def fct_bowling_scorecard(deliveries: DataFrame, bowling_order: DataFrame) -> DataFrame:
    """Balls = legal deliveries; runs conceded = batter runs + wides + no-balls; only
    bowler-credited dismissal kinds count; a dot is a legal ball with no batter runs;
    wides/noballs count deliveries, not runs; economy = round(6*runs/balls, 2)."""
    stats = deliveries.groupBy("match_id", "innings_number", "bowler").agg(
        F.min("super_over").alias("_so"),
        count_when(F.col("is_legal")).alias("balls"),
        (F.sum("batter_runs") + F.sum("wides") + F.sum("noballs")).cast("bigint")
        .alias("runs"),
        count_when(F.col("player_out").isNotNull()
                   & F.col("dismissal_mode").isin(*BOWLER_WICKETS)).alias("wickets"),
        count_when(F.col("is_legal") & (F.col("batter_runs") == 0)).alias("dots"),
        count_when(F.col("wides") > 0).alias("wides"),
        count_when(F.col("noballs") > 0).alias("noballs"))
    return bowling_order.hint("merge").join(stats, ["match_id", "innings_number", "bowler"]).select(
        "match_id", "innings_number",
        F.coalesce("_so", F.lit(False)).alias("is_super_over"),
        "bowling_position", "bowler", "balls", "runs", "wickets", "dots",
        half_up_decimal("runs", "balls", factor=6).alias("economy"),
        "wides", "noballs")


def fct_match_summary(matches: DataFrame, innings: DataFrame) -> DataFrame:
    """'<team> <runs>/<wkts> (<overs>)[ & ...] vs <team> ...' and the result text."""
    # one shuffle of innings rows by match serves both string aggregations: (match, team)
    # and (match) groups are each inside one match partition
    inn = innings.repartition("match_id").withColumn("_overs",
                                                     overs_display("legal_deliveries"))
    score = F.concat(F.col("runs_scored").cast("string"), F.lit("/"),
                     F.col("wickets_lost").cast("string"), F.lit(" ("), F.col("_overs"),
                     F.lit(")"))
    team_scores = inn.groupBy("match_id", "team").agg(
        F.min("innings_number").alias("ordering"),
        ordered_concat(score, " & ", F.col("innings_number")).alias("scores"))
    match_scores = team_scores.groupBy("match_id").agg(
        ordered_concat(F.concat(F.col("team"), F.lit(" "), F.col("scores")), " vs ",
                       F.col("ordering")).alias("scoreline"))
    return matches.join(match_scores.hint("merge"), "match_id", "left").select(
        "match_id", "start_date", "scoreline",
        result_text(F.col("winner"), F.col("outcome_margin.runs"),
                    F.col("outcome_margin.wickets")).alias("result"))
