"""The two published analytical queries: top run scorers and top dot-ball bowlers of
one event in one year. Both are top-k reports (the LIMIT is the feature); a name
tie-breaker makes the cut deterministic, and DESC puts NULLs first as in PostgreSQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.functions import count_when, half_up_rate, overs_display


def event_matches(matches: DataFrame, event_name: str, year: int) -> DataFrame:
    return matches.filter((F.col("event_name") == event_name)
                          & (F.year("start_date") == year)).select("match_id")


def top_batters(batting_scorecard: DataFrame, matches: DataFrame, event_name: str,
                year: int, k: int = 10) -> DataFrame:
    ids = event_matches(matches, event_name, year)
    return rank_batters(batting_scorecard.join(ids, "match_id", "left_semi"), k)


def rank_batters(batting_scorecard: DataFrame, k: int = 10) -> DataFrame:
    stats = (batting_scorecard
             .groupBy(F.col("player_name").alias("batter"))
             .agg(F.count(F.lit(1)).alias("innings"),
                  F.sum("runs").cast("bigint").alias("runs"),
                  F.sum("balls").cast("bigint").alias("balls"),
                  count_when(F.col("is_dismissed")).alias("dismissals")))
    return (stats.select(
        "batter", "innings",
        (F.col("innings") - F.col("dismissals")).alias("not_outs"),
        "runs",
        half_up_rate("runs", "dismissals").alias("average"),
        half_up_rate("runs", "balls", factor=100).alias("strike_rate"))
        .orderBy(F.col("runs").desc_nulls_first(), F.col("batter").asc_nulls_last())
        .limit(k))


def top_bowlers(bowling_scorecard: DataFrame, matches: DataFrame, event_name: str,
                year: int, k: int = 10) -> DataFrame:
    ids = event_matches(matches, event_name, year)
    return rank_bowlers(bowling_scorecard.join(ids, "match_id", "left_semi"), k)


def rank_bowlers(bowling_scorecard: DataFrame, k: int = 10) -> DataFrame:
    stats = (bowling_scorecard
             .groupBy("bowler")
             .agg(F.count(F.lit(1)).alias("innings"),
                  F.sum("runs").cast("bigint").alias("runs"),
                  F.sum("balls").cast("bigint").alias("balls"),
                  F.sum("wickets").cast("bigint").alias("wickets"),
                  F.sum("dots").cast("bigint").alias("dots")))
    return (stats.select(
        "bowler", "innings", "wickets",
        overs_display("balls").alias("overs"),
        half_up_rate("runs", "wickets").alias("average"),
        half_up_rate("runs", "balls", factor=6).alias("economy"),
        "dots",
        half_up_rate("dots", "balls", factor=100).alias("dot_ball_pct"))
        .orderBy(F.col("dots").desc_nulls_first(), F.col("dot_ball_pct").desc_nulls_first(),
                 F.col("bowler").asc_nulls_last())
        .limit(k))
