"""The query world: every model input derived by Spark from the driver's tables.

* balls   = F-D (``lineitem``), as typed raw rows -> staging projection;
* matches = F-M (``supplier`` ⋈ ``nation`` ⋈ ``region``) as staging match-info rows;
* seeds   = venue -> city from ``nation``/``region`` (the seed scenarios load the nations
            from ``SEEDED_NATIONS`` on as new venues), city -> country from ``region`` with an
            extra 'UNKNOWN' row per region (duplicates the venue table must resolve).

Methods build lazily and memoise per world, so one query plan reuses its inputs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.plans import intermediate as im
from crease.plans import marts as mt
from crease.plans import staging as st
from crease.sources import adapters as ad
from crease.session import document_writer, read_table, scratch_path, together
from crease.sources.venues import UNKNOWN_COUNTRY


# --- fixed scenario values ---------------------------------------------------------------
SEEDED_NATIONS = 15        # venues (nations) with key below this are in the venue seed
COUNTRY_REGIONS = 3        # regions with key below this have a real country name
COUNTRY_SUFFIX = " LAND"
REPORT_EVENT = "EUROPE"        # an event with matches in the report year at every scale
REPORT_YEAR = 2024
LOADED_AT = "2025-01-01 00:00:00"
#: Quality scenario: integer by which a model's rows are dealt to five parts (else match_id).
PLANT_KEYS = {"int_venues": "ascii(right(venue_name, 1))", "int_teams": "CAST(substr(team, 2) AS INT)",
              "int_players": "CAST(substr(player_name, 2) AS INT)"}
# ---------------------------------------------------------------------------------------


def store(df: DataFrame, name: str, documents: bool = False) -> DataFrame:
    """Write ``df``, rows of whole ``documents`` or not, below the shared checkpoint folder and read
    it back."""
    path = scratch_path(df.sparkSession, name)
    (document_writer(df) if documents else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class World:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def only(self, match_ids: DataFrame) -> World:
        """This world with the balls of ``match_ids`` only. Every ball window is inside one
        match, so the cut goes below all of them."""
        cut = World(self.spark, self.sf_dir)
        cut.fd_raw = ad.fd_raw(self.spark, self.sf_dir, match_ids=match_ids)
        return cut

    def stored(self) -> World:
        """This world with the tables that many models read written once and read back: a step reads
        what the steps before it stored, and its tables are written at the same time."""
        kept = World(self.spark, self.sf_dir)
        for step in (["stg_match_info", "deliveries"],
                     ["sequence", "matches", "match_teams", "match_players", "dismissed"],
                     ["teams", "batting_order", "bowling_order"]):
            built = [(name, getattr(kept, name)) for name in step]
            for name, rows in zip(step, together([lambda n=n, df=df: store(df, n) for n, df in built])):
                setattr(kept, name, rows)
        return kept

    # raw inputs -------------------------------------------------------------------------
    @cached_property
    def fd_raw(self) -> DataFrame:
        return ad.fd_raw(self.spark, self.sf_dir)

    @cached_property
    def fm(self) -> DataFrame:
        return ad.fm_matches(self.spark, self.sf_dir)

    @cached_property
    def raw_matches(self) -> DataFrame:
        return self.fm.select("match_id", "hash_id",
                              F.lit(LOADED_AT).cast("timestamp").alias("ingested_at"),
                              ad.info_struct().alias("info"))

    @cached_property
    def venue_city(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        return (n.filter(F.col("n_nationkey") < SEEDED_NATIONS)
                .join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
                .select(F.col("n_name").alias("venue_name"), F.col("r_name").alias("city")))

    @cached_property
    def city_country(self) -> DataFrame:
        r = self.table("region")
        known = r.filter(F.col("r_regionkey") < COUNTRY_REGIONS).select(
            F.col("r_name").alias("city"),
            F.concat(F.col("r_name"), F.lit(COUNTRY_SUFFIX)).alias("country"))
        unknown = r.select(F.col("r_name").alias("city"),
                           F.lit(UNKNOWN_COUNTRY).alias("country"))
        return known.unionByName(unknown)

    # models ---------------------------------------------------------------------------
    @cached_property
    def deliveries(self) -> DataFrame:
        """Staged balls projected straight from F-D. The raw-object route (typed or
        JSON delivery -> staging projection) gives the same rows; the stg_deliveries
        and raw_roundtrip_flatten queries exercise it against the same oracle."""
        return im.int_deliveries(
            self.fd_raw.selectExpr(*ad.FD_STAGED_EXPRS))

    @cached_property
    def stg_match_info(self) -> DataFrame:
        return st.stg_match_info(self.raw_matches)

    @cached_property
    def venues(self) -> DataFrame:
        """All nations are seeded; the split into old and new seeds is for the seed queries."""
        n, r = self.table("nation"), self.table("region")
        cities = n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_name").alias("venue_name"), F.col("r_name").alias("city"))
        return im.int_venues(cities, self.city_country)

    @cached_property
    def matches(self) -> DataFrame:
        return im.int_matches(self.stg_match_info, self.venues)

    @cached_property
    def innings(self) -> DataFrame:
        return im.int_innings(self.deliveries)

    @cached_property
    def match_teams(self) -> DataFrame:
        return im.int_match_teams(self.stg_match_info, self.venues)

    @cached_property
    def match_players(self) -> DataFrame:
        return im.int_match_players(self.stg_match_info)

    @cached_property
    def teams(self) -> DataFrame:
        return im.int_teams(self.match_teams)

    @cached_property
    def players(self) -> DataFrame:
        return im.int_players(self.match_players, self.teams)

    @cached_property
    def sequence(self) -> DataFrame:
        return mt.fct_deliveries_sequence(self.deliveries)

    @cached_property
    def batting_order(self) -> DataFrame:
        return mt.fct_batting_order(self.sequence)

    @cached_property
    def bowling_order(self) -> DataFrame:
        return mt.fct_bowling_order(self.sequence)

    @cached_property
    def dismissed(self) -> DataFrame:
        return mt.fct_dismissed_players(self.deliveries)

    @cached_property
    def batting_scorecard(self) -> DataFrame:
        return mt.fct_batting_scorecard(self.deliveries, self.batting_order, self.dismissed)

    @cached_property
    def bowling_scorecard(self) -> DataFrame:
        return mt.fct_bowling_scorecard(self.deliveries, self.bowling_order)

    @cached_property
    def match_summary(self) -> DataFrame:
        return mt.fct_match_summary(self.matches, self.innings)
