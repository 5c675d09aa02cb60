"""Intermediate models: venues, matches, innings, teams, players and the two junctions.

Everything keyed by match is computed from the staging row of that match. Dimension
joins (venues, teams) are left to the planner's size-checked broadcast (see
``spark.sql.autoBroadcastJoinThreshold``): small seeds broadcast, a large one stays a shuffled join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.functions import batted_first, count_when, opponent, outcome_type, surrogate_key
from crease.operators.dedupe import distinct_on
from crease.sources.venues import UNKNOWN_COUNTRY


def int_venues(venue_city: DataFrame, city_country: DataFrame) -> DataFrame:
    """venue_city ⋈ city_country USING (city); one row per venue, preferring a known
    country when the city seed holds duplicates."""
    j = venue_city.join(city_country, "city")
    j = j.withColumn("_unknown", F.col("country") == F.lit(UNKNOWN_COUNTRY))
    one = distinct_on(j, ["venue_name"], ["_unknown", "country", "city"],
                      columns=["venue_name", "city", "country"])
    return one.select(surrogate_key("venue_name").alias("venue_id"), "venue_name", "city",
                      "country", F.current_timestamp().alias("last_update"))


def int_matches(stg_match_info: DataFrame, venues: DataFrame) -> DataFrame:
    """Match attributes out of the nested info object; venue resolved by name (left
    join: an unknown venue gives a NULL venue_id). Staging is unique by match_id and
    venues by name, so the join cannot duplicate a match."""
    i = F.col("info")
    s = stg_match_info.select(
        "match_id", "hash_id", i["venue"].alias("_venue"),
        F.try_to_date(F.get(i["dates"], 0), "yyyy-MM-dd").alias("start_date"),
        i["match_type"].alias("format"),
        i["gender"].alias("gender"),
        i["event"]["name"].alias("event_name"),
        i["event"]["match_number"].cast("int").alias("event_match_number"),
        i["event"]["stage"].alias("event_stage"),
        i["toss"]["winner"].alias("toss_winner"),
        i["toss"]["decision"].alias("toss_decision"),
        outcome_type(i["outcome"]["winner"], i["outcome"]["result"]).alias("outcome_type"),
        i["outcome"]["by"].alias("outcome_margin"),
        i["outcome"]["winner"].alias("winner"),
        F.to_json(i["player_of_match"]).alias("player_of_match"),
    )
    v = venues.select(F.col("venue_name").alias("_venue"), "venue_id")
    return s.join(v, "_venue", "left").select(
        "match_id", "hash_id", "venue_id", "start_date", "format", "gender", "event_name",
        "event_match_number", "event_stage", "toss_winner", "toss_decision", "outcome_type",
        "outcome_margin", "winner", "player_of_match",
        F.current_timestamp().alias("last_update"))


def int_deliveries(stg_deliveries: DataFrame) -> DataFrame:
    return stg_deliveries


def int_innings(deliveries: DataFrame) -> DataFrame:
    """Innings totals; partial aggregation per map task, then one row per innings.

    ``hash_id`` and ``team`` are the same on every ball of an innings (all balls of an
    innings are flattened from one innings object of one file), so they are grouping
    keys rather than string aggregates: every buffer is fixed-width and the aggregate
    stays a hash aggregate instead of a sort aggregate."""
    return deliveries.groupBy("match_id", "innings_number", "hash_id", "team").agg(
        F.min("super_over").alias("super_over"),
        F.sum("runs").cast("bigint").alias("runs_scored"),
        F.count("player_out").alias("wickets_lost"),
        count_when(F.col("is_legal")).alias("legal_deliveries"),
        F.sum("wides").cast("bigint").alias("wides"),
        F.sum("noballs").cast("bigint").alias("noballs"),
        F.sum("byes").cast("bigint").alias("byes"),
        F.sum("legbyes").cast("bigint").alias("legbyes"),
        F.sum("extras").cast("bigint").alias("extras"),
    )


def int_match_teams(stg_match_info: DataFrame, venues: DataFrame) -> DataFrame:
    """Two rows per match (team, opponent, toss, result); only matches whose venue is in
    the venue table (semi join). Toss and winner are read from the same staging row the
    matches table is projected from (a 1:1 join on match_id in SQL). A team listed twice
    keeps its first position — no shuffle needed for the de-duplication."""
    i = F.col("info")
    known = stg_match_info.join(
        venues.select(F.col("venue_name").alias("_venue")),
        i["venue"] == F.col("_venue"), "left_semi")
    t = known.select("match_id", "hash_id", i["match_type"].alias("format"),
                     i["teams"].alias("teams"),
                     i["toss"]["winner"].alias("toss_winner"),
                     i["toss"]["decision"].alias("toss_decision"),
                     i["outcome"]["winner"].alias("winner"),
                     F.posexplode(i["teams"]).alias("pos", "team"))
    first = t.filter(F.array_position("teams", F.col("team")) == F.col("pos") + 1)
    return first.select(
        surrogate_key("match_id", "team").alias("match_team_id"),
        "hash_id", "match_id", "format", "team",
        opponent("teams", "pos").alias("opponent"),
        batted_first("toss_winner", "toss_decision", "team").alias("batted_first"),
        (F.col("winner") == F.col("team")).alias("won_match"),
    )


def int_match_players(stg_match_info: DataFrame) -> DataFrame:
    """(team -> names) map exploded to one row per listed player; player_id looked up
    in the registry by name (NULL when absent). One row per (match, player_id): players
    without an id in one match collapse to the first by (team, name)."""
    i = F.col("info")
    teams = stg_match_info.select("match_id", "hash_id", i["match_type"].alias("format"),
                                  i["registry"]["people"].alias("people"),
                                  F.explode(i["players"]).alias("team", "names"))
    rows = teams.select("match_id", "hash_id", "format", "people", "team",
                        F.explode("names").alias("player_name"))
    rows = rows.select(
        surrogate_key("match_id", "player_name").alias("match_player_id"),
        "match_id", "hash_id",
        F.try_element_at("people", F.col("player_name")).alias("player_id"),
        "player_name", "team", "format")
    return distinct_on(rows, ["match_id", "player_id"], ["team", "player_name"])


def int_teams(match_teams: DataFrame, keep_source: bool = False) -> DataFrame:
    """One row per (team, format); attributes from its latest match. ``keep_source``
    adds ``source_match_id`` (the survivor's match), used for incremental upkeep."""
    latest = distinct_on(match_teams, ["team", "format"], ["match_id", "hash_id"],
                         descending=True, columns=["team", "format", "hash_id", "match_id"])
    out = latest.select(surrogate_key("team", "format").alias("team_id"), "hash_id",
                        "team", "format", F.current_timestamp().alias("last_update"),
                        F.col("match_id").alias("source_match_id"))
    return out if keep_source else out.drop("source_match_id")


def int_players(match_players: DataFrame, teams: DataFrame,
                keep_source: bool = False) -> DataFrame:
    """One row per (team_id, player_id), from the player's latest match."""
    j = match_players.join(teams.select("team_id", "team", "format"), ["team", "format"])
    latest = distinct_on(j, ["team_id", "player_id"], ["match_id", "player_name"],
                         descending=True,
                         columns=["team_id", "player_id", "hash_id", "player_name", "team",
                                  "format", "match_id"])
    out = latest.withColumnRenamed("match_id", "source_match_id")
    return out if keep_source else out.drop("source_match_id")


#: What a dimension keeps of its junction: (junction, keys, order of the latest row first).
CANDIDATES = {
    "int_teams": ("int_match_teams", ["team", "format"], ["match_id", "hash_id"]),
    "int_players": ("int_match_players", ["team", "format", "player_id"], ["match_id", "player_name"]),
}


def dimension_candidates(name: str, junction: DataFrame, bucket: str = "bucket") -> DataFrame:
    """The latest row of each key in each bucket of matches. The latest row of a key is the latest
    of these, whatever other buckets hold, so a dimension is kept up from the candidates of the
    buckets that changed and the stored ones of the others: the junction is not read again, and
    a match that is corrected or emptied gives way to the next latest one."""
    _, keys, order = CANDIDATES[name]
    columns = list(dict.fromkeys([bucket, *keys, *order, "hash_id"]))
    return distinct_on(junction, [bucket, *keys], order, descending=True, columns=columns)
