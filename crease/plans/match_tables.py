"""Match-grain tables of parts, merged on read.

A table is a list of parts. A part is a directory of buckets (match-id ranges), written once;
replacing some matches only adds a part with their new rows. Which rows of older parts are
dead follows from the change feed: every feed entry is a list of changed match ids with a
number; a part made when the feed stood at entry s holds the rows of its matches as of s, so
a row is live if no entry after s, up to the one the table has taken in (its watermark), names
its match. A correction of one match therefore writes that match only, however large its
bucket is. A bucket that lies in more than MAX_PARTS parts is rewritten as one.

State of a table (JSON): {"schema", "watermark", "parts": [{"dir", "seq", "buckets", "written"}]}.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.operators.incremental import BUCKET_COL, with_bucket
from crease.plans.snapshots import Store, new_id
from crease.session import WHOLE_VARIANTS, document_writer

PART, ENTRY = "part", "entry"
FEED = "feed"
#: Column of whole documents (``raw/matches``).
DOCUMENT = "document"
#: A bucket is rewritten when more parts than these hold rows of it.
MAX_PARTS = 6
#: Rows of at most so many buckets (a run of new matches fills the newest one) are not shuffled
#: for the write: that makes at most so many files a task.
DIRECT_BUCKETS = 4
#: Changed ids are broadcast up to so many (4 bytes each, and their number).
BROADCAST_IDS = 1_000_000
FEED_SCHEMA = T.StructType([T.StructField("match_id", T.IntegerType()), T.StructField(ENTRY, T.StringType())])


def add_part(store: Store, table: str, rows: DataFrame, width: int, buckets: int) -> dict:
    """Write ``rows``, which lie in so many ``buckets``, as a part of ``table``; it counts only
    once a commit names it.

    Of few buckets each task writes its own rows, a file per bucket. Of many, rows are dealt by
    bucket first; the REBALANCE hint splits a hot bucket over several tasks and merges small ones."""
    name = f"p{new_id()}"
    path = f"{store.root}/{table}/{PART}={name}"
    rows = with_bucket(rows, width)
    if buckets > DIRECT_BUCKETS:
        rows = rows.hint("rebalance", BUCKET_COL)
    writer = document_writer(rows) if DOCUMENT in rows.columns else rows.write.options(**WHOLE_VARIANTS)
    writer.partitionBy(BUCKET_COL).parquet(path)
    buckets = sorted(int(n.split("=")[1]) for n in store.names(path)
                     if n.startswith(f"{BUCKET_COL}=") and not n.endswith("__"))
    return {"dir": name, "buckets": buckets, "written": len(buckets)}


def _numbered(column: str, numbers: dict[str, int]):
    """The number of a directory name, from the state; a few names."""
    pairs = [F.lit(x) for name, n in sorted(numbers.items()) for x in (name, n)]
    return F.element_at(F.create_map(*pairs), F.col(column))


def changed_ids(store: Store, entries: list[dict]) -> DataFrame:
    """(match_id, seq) of feed entries; a match changed twice stands twice."""
    spark = store.spark
    if not entries:
        return spark.createDataFrame([], "match_id int, seq int")
    base = f"{store.root}/{FEED}"
    rows = (spark.read.schema(FEED_SCHEMA).option("basePath", base)
            .parquet(*[f"{base}/{ENTRY}={e['dir']}" for e in entries]))
    return rows.select("match_id", _numbered(ENTRY, {e["dir"]: e["seq"] for e in entries}).alias("seq"))


def hides(entry: dict, table: str) -> bool:
    """Whether a feed entry tells of new rows of ``table``: raw tables change by loads alone."""
    return entry["loads"] or not table.startswith("raw/")


def live_rows(store: Store, table: str, state: dict, feed: list[dict],
              buckets: list[int] | None = None) -> DataFrame:
    """The live rows of ``table``, of some buckets only if given: only their files are listed."""
    spark, schema = store.spark, T.StructType.fromJson(json.loads(state["schema"]))
    base, paths, seqs, read = f"{store.root}/{table}", [], {}, set()
    for part in state["parts"]:
        own = part["buckets"] if buckets is None else sorted(set(part["buckets"]) & set(buckets))
        if not own:
            continue
        seqs[part["dir"]] = part["seq"]
        read.update(own)
        top = f"{base}/{PART}={part['dir']}"
        paths += [top] if len(own) == part["written"] else [f"{top}/{BUCKET_COL}={b}" for b in own]
    if not paths:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField(PART, T.StringType()),
                         T.StructField(BUCKET_COL, T.IntegerType())])
    rows = spark.read.schema(full).option("basePath", base).parquet(*paths)
    later = [e for e in feed if hides(e, table) and read & set(e["buckets"])
             and min(seqs.values()) < e["seq"] <= state["watermark"]]
    if later:
        dead = changed_ids(store, later).groupBy("match_id").agg(F.max("seq").alias("__after"))
        if sum(e["rows"] for e in later) <= BROADCAST_IDS:
            dead = F.broadcast(dead)
        rows = rows.withColumn("__seq", _numbered(PART, seqs))
        rows = rows.join(dead.withColumnRenamed("match_id", "__match"),
                         (F.col("match_id") == F.col("__match")) & (F.col("__after") > F.col("__seq")), "left_anti")
    return rows.select(*schema.names)


def crowded_buckets(state: dict, max_parts: int = MAX_PARTS) -> list[int]:
    count: dict[int, int] = {}
    for part in state["parts"]:
        for b in part["buckets"]:
            count[b] = count.get(b, 0) + 1
    return sorted(b for b, n in count.items() if n > max_parts)


def without_buckets(state: dict, buckets: list[int]) -> None:
    """Parts of ``state`` no longer count for ``buckets``; empty parts go."""
    gone = set(buckets)
    for part in state["parts"]:
        part["buckets"] = [b for b in part["buckets"] if b not in gone]
    state["parts"] = [p for p in state["parts"] if p["buckets"]]


def needed_entries(feed: list[dict], tables: list[tuple[str, dict]]) -> list[dict]:
    """Feed entries that some model has yet to take in, or that may hide rows of some part."""
    def needed(entry: dict, name: str, table: dict) -> bool:
        if not name.startswith("raw/") and table["watermark"] < entry["seq"]:
            return True
        own = set(entry["buckets"])
        return hides(entry, name) and any(p["seq"] < entry["seq"] and own & set(p["buckets"])
                                          for p in table.get("parts", []))
    return [e for e in feed if any(needed(e, n, t) for n, t in tables)]
