"""Venue source table and the two lookup seeds (venue -> city, city -> country).

* ``upsert_venues``       insert-if-absent, first city wins: within a run the first
                          document by file name decides; existing rows always win.
* ``new_seed_venues``     venues not yet in the venue seed (EXCEPT), fetched with a semi
                          join; city defaults to '<venue>-CITY' when NULL or empty.
* ``new_seed_cities``     cities not yet in the country seed get country 'UNKNOWN'
                          (compared on the city column, so a second run adds nothing).
* ``merged_edits``        a seed edited by hand: what changed since it was handed out is applied
                          to the stored seed, which may have gained rows meanwhile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease import schemas
from crease.operators.dedupe import distinct_on

# --- fixed values -------------------------------------------------------------------
CITY_SUFFIX = "-CITY"
UNKNOWN_COUNTRY = "UNKNOWN"
# ---------------------------------------------------------------------------------------


def batch_venues(docs: DataFrame) -> DataFrame:
    """(venue_name, city) of loadable documents, first file name wins per venue."""
    rows = docs.select(F.col("doc.info.venue").alias("venue_name"),
                       F.col("doc.info.city").alias("city"), "filename")
    return distinct_on(rows, ["venue_name"], ["filename"], columns=["venue_name", "city"])


def upsert_venues(src_venues: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert venues that are not present yet; never overwrite. A NULL venue name
    never conflicts (UNIQUE ignores NULL), so NULL-named rows are appended."""
    fresh = incoming.join(src_venues.select("venue_name"), "venue_name", "left_anti")
    return src_venues.unionByName(fresh.select(*src_venues.columns))


def new_venue_names(src_venues: DataFrame, venue_city: DataFrame) -> DataFrame:
    """SELECT venue_name FROM src EXCEPT SELECT venue_name FROM seed (distinct)."""
    return src_venues.select("venue_name").subtract(venue_city.select("venue_name"))


def new_seed_venues(src_venues: DataFrame, venue_city: DataFrame) -> DataFrame:
    names = new_venue_names(src_venues, venue_city)
    rows = src_venues.join(names, "venue_name", "left_semi")
    city = F.coalesce(F.nullif(F.col("city"), F.lit("")),
                      F.concat(F.col("venue_name"), F.lit(CITY_SUFFIX)))
    return rows.select("venue_name", city.alias("city"))


def refresh_venue_city(src_venues: DataFrame, venue_city: DataFrame) -> DataFrame:
    return venue_city.unionByName(new_seed_venues(src_venues, venue_city))


def new_seed_cities(venue_city: DataFrame, city_country: DataFrame) -> DataFrame:
    cities = (venue_city.select("city")
              .filter(F.col("city").isNotNull() & (F.col("city") != "")).distinct())
    fresh = cities.join(city_country.select("city"), "city", "left_anti")
    return fresh.select("city", F.lit(UNKNOWN_COUNTRY).alias("country"))


def refresh_city_country(venue_city: DataFrame, city_country: DataFrame) -> DataFrame:
    return city_country.unionByName(new_seed_cities(venue_city, city_country))


def merged_edits(stored: DataFrame, handed_out: DataFrame, edited: DataFrame, key: str) -> DataFrame:
    """Three-way merge of a seed: rows that the edit took away go, rows that it added come, and what
    the stored seed gained meanwhile stays, unless the edit says something about its ``key``.

    Rows are compared whole and NULL-safe, so an edited row is one taken away and one added;
    repeated rows count once."""
    columns = stored.columns
    before, after = handed_out.select(*columns), edited.select(*columns)
    added = after.subtract(before)
    said = added.select(F.col(key).alias("__key")).distinct()
    kept = stored.subtract(before.subtract(after))
    # rows the edit left as they were stay beside an added row of their key
    news = kept.subtract(before).join(said, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    return kept.intersect(before).unionByName(news).unionByName(added.subtract(kept.intersect(before)))


def read_seed(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_venue_city(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, schemas.VENUE_CITY)


def read_city_country(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, schemas.CITY_COUNTRY)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def write_seed(df: DataFrame, path: str) -> None:
    """Write a seed as a CSV directory with a header line in every part file (read back
    with ``read_seed``)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def init_seeds(spark: SparkSession, venue_city_path: str, city_country_path: str) -> None:
    """Header-only seed files (the state before any refresh)."""
    write_seed(empty(spark, schemas.VENUE_CITY), venue_city_path)
    write_seed(empty(spark, schemas.CITY_COUNTRY), city_country_path)
