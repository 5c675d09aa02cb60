"""Staging models: typed projections of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease import schemas
from crease.operators.dedupe import distinct_on

DELIVERY_COLUMNS = ["match_id", "hash_id", "innings_number", "team", "over_number",
                    "ball_in_over", "super_over", "runs", "batter_runs", "wides", "noballs",
                    "byes", "legbyes", "extras", "batter", "non_striker", "bowler",
                    "is_legal", "player_out", "dismissal_mode"]


def parse_delivery_json(raw_json: DataFrame) -> DataFrame:
    """Raw rows whose ``delivery`` is JSON text -> typed struct."""
    return raw_json.withColumn("delivery", F.from_json("delivery", schemas.DELIVERY))


def typed_deliveries(raw: DataFrame) -> DataFrame:
    """Raw rows whose ``delivery`` is the whole ball (VARIANT) -> typed struct. A key that is
    present with a JSON null stays a key of ``extras``."""
    return raw.withColumn("delivery", F.try_variant_get("delivery", "$", schemas.DELIVERY.simpleString()))


def _extra(k: str) -> str:
    return f"CAST(coalesce(try_element_at(delivery.extras, '{k}'), 0) AS INT) AS {k}"


def _present(k: str) -> str:
    return f"coalesce(map_contains_key(delivery.extras, '{k}'), false)"


STG_DELIVERY_EXPRS = [
    "CAST(match_id AS INT) AS match_id", "hash_id",
    "CAST(n_innings AS INT) AS innings_number", "team",
    "CAST(n_over AS INT) AS over_number", "CAST(n_delivery AS INT) AS ball_in_over",
    "super_over",
    "CAST(coalesce(delivery.runs.total, 0) AS INT) AS runs",
    "CAST(coalesce(delivery.runs.batter, 0) AS INT) AS batter_runs",
    _extra("wides"), _extra("noballs"), _extra("byes"), _extra("legbyes"),
    "CAST(coalesce(delivery.runs.extras, 0) AS INT) AS extras",
    "delivery.batter AS batter", "delivery.non_striker AS non_striker",
    "delivery.bowler AS bowler",
    # legal = neither key present (decided before the 0 defaults above)
    f"NOT {_present('wides')} AND NOT {_present('noballs')} AS is_legal",
    # first wicket only; get() is NULL for a missing/empty array
    "get(delivery.wickets, 0).player_out AS player_out",
    "get(delivery.wickets, 0).kind AS dismissal_mode",
]


def stg_deliveries(raw: DataFrame) -> DataFrame:
    """One row per ball, 20 columns. Numbers default to 0 when absent; ``is_legal`` is
    decided on key presence in ``extras`` before any default is applied. Same rules as
    ``crease.functions.legal_ball`` / ``first_of``, written as one SQL projection."""
    return raw.selectExpr(*STG_DELIVERY_EXPRS)


def stg_match_info(raw_matches: DataFrame) -> DataFrame:
    """One row per match: the newest loaded document wins (then the larger hash)."""
    cols = ["match_id", "hash_id", "info", "ingested_at"]
    latest = distinct_on(raw_matches.select(*cols), ["match_id"],
                         ["ingested_at", "hash_id"], descending=True)
    return match_info(latest)


def match_info(raw_matches: DataFrame) -> DataFrame:
    """The same for a table that holds one row per match already, as the warehouse's does: no
    document is shuffled."""
    return raw_matches.select("match_id", "hash_id", "info", F.current_timestamp().alias("last_update"))
