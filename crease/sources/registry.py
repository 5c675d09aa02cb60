"""Registry of ingested files as an append-only log.

Each run appends a segment in two layouts: ``by_name`` (filename, file_hash) answers which hash a
name has now, ``by_hash`` (file_hash, filename, active) which names hold a content now; a name
that gets a new hash also appends its old hash, inactive. The newest row of a key counts. A
segment is dealt into a power of two of shards by the key's hash, ROWS_PER_SHARD rows each, and
a lookup reads, per segment, only the shards that its own keys fall into: its cost follows the
files of the run, not the registry. When there are more than MAX_SEGMENTS, the smaller ones are
merged (all, once these reach half of the largest).

State (JSON): {"segments": [{"dir", "seq", "rows", "shards"}], "next"}.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease import schemas
from crease.plans.snapshots import Store, new_id

BY_NAME, BY_HASH = "registry/by_name", "registry/by_hash"
ROWS_PER_SHARD = 100_000
MAX_SHARDS = 4096
MAX_SEGMENTS = 8
EMPTY = {"segments": [], "next": 1}
S, L = T.StringType(), T.LongType()
#: ``seq`` is null in a segment of one run, whose number stands in the state.
SCHEMAS = {
    BY_NAME: T.StructType([T.StructField("filename", S), T.StructField("file_hash", S),
                           T.StructField("ingested_at", T.TimestampType()), T.StructField("seq", L)]),
    BY_HASH: T.StructType([T.StructField("file_hash", S), T.StructField("filename", S),
                           T.StructField("active", T.BooleanType()), T.StructField("seq", L)]),
}
KEY = {BY_NAME: "filename", BY_HASH: "file_hash"}


def shard(key: str, shards: int):
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def shards_for(rows: int) -> int:
    n = 1
    while n < MAX_SHARDS and n * ROWS_PER_SHARD < rows:
        n *= 2
    return n


def _write(store: Store, layout: str, name: str, rows: DataFrame, shards: int) -> None:
    out = rows.select(*SCHEMAS[layout].names).withColumn("shard", shard(KEY[layout], shards))
    out.hint("rebalance", "shard").write.partitionBy("shard").parquet(f"{store.root}/{layout}/segment={name}")


def _read(store: Store, layout: str, segments: list[dict], keys: DataFrame | None = None) -> DataFrame:
    """Rows of ``segments``; with ``keys`` (one column, the layout's key) of their shards only."""
    spark, base, paths = store.spark, f"{store.root}/{layout}", []
    touched: dict[int, list[int]] = {}
    for s in segments:
        top = f"{base}/segment={s['dir']}"
        if keys is None or s["shards"] == 1:
            paths.append(top)
            continue
        if s["shards"] not in touched:  # at most as many numbers as shards
            touched[s["shards"]] = [r[0] for r in keys.select(shard(KEY[layout], s["shards"])).distinct().collect()]
        written = set(store.names(top))
        paths += [f"{top}/shard={n}" for n in touched[s["shards"]] if f"shard={n}" in written]
    if not paths:
        return spark.createDataFrame([], SCHEMAS[layout])
    full = T.StructType([*SCHEMAS[layout].fields, T.StructField("segment", S), T.StructField("shard", T.IntegerType())])
    rows = spark.read.schema(full).option("basePath", base).parquet(*paths)
    number = F.create_map(*[F.lit(x) for s in segments for x in (s["dir"], s["seq"])])
    return rows.withColumn("seq", F.coalesce("seq", F.element_at(number, F.col("segment")).cast("long"))).drop(
        "segment", "shard")


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "seq").alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def names(store: Store, state: dict, wanted: DataFrame | None = None) -> DataFrame:
    """(filename, file_hash, ingested_at) as of now; of the ``wanted`` names (filename) only."""
    rows = _read(store, BY_NAME, state["segments"], wanted)
    if wanted is not None:
        rows = rows.join(wanted.distinct(), "filename", "left_semi")
    return _newest(rows, ["filename"]).select(*schemas.REGISTRY.names)


def known_hashes(store: Store, state: dict, wanted: DataFrame) -> DataFrame:
    """(file_hash) of the ``wanted`` ones that some name holds now."""
    rows = _read(store, BY_HASH, state["segments"], wanted).join(wanted.distinct(), "file_hash", "left_semi")
    return _newest(rows, ["file_hash", "filename"]).filter("active").select("file_hash").distinct()


def append(store: Store, state: dict, added: DataFrame, rows: int) -> tuple[dict, list]:
    """A segment of ``added`` (filename, file_hash; one row per name, ``rows`` of them): its entry,
    which counts once a commit has put it into the state with a ``seq``, and the two writes."""
    name, shards = f"s{new_id()}", shards_for(rows)
    null = F.lit(None).cast("long").alias("seq")
    by_name = added.select("filename", "file_hash", F.current_timestamp().alias("ingested_at"), null)
    by_hash = added.select("file_hash", "filename", F.lit(True).alias("active"), null)
    if state["segments"]:
        before = names(store, state, added.select("filename")).join(
            added.select("filename", F.col("file_hash").alias("__new")), "filename").filter("file_hash <> __new")
        by_hash = by_hash.unionByName(before.select("file_hash", "filename", F.lit(False).alias("active"), null))
    return {"dir": name, "rows": rows, "shards": shards}, [
        lambda: _write(store, BY_NAME, name, by_name, shards), lambda: _write(store, BY_HASH, name, by_hash, shards)]


def add_segment(state: dict, entry: dict) -> None:
    state["segments"].append(entry | {"seq": state["next"]})
    state["next"] += 1


def merge_candidates(state: dict) -> list[dict]:
    """Segments to merge: none as long as there are few."""
    if len(state["segments"]) <= MAX_SEGMENTS:
        return []
    by_size = sorted(state["segments"], key=lambda s: s["rows"])
    small = by_size[:-1]
    return by_size if 2 * sum(s["rows"] for s in small) >= by_size[-1]["rows"] else small


def merged(store: Store, state: dict, segments: list[dict]) -> dict:
    """Write ``segments`` as one: the newest row of each key, with its number."""
    name, rows = f"s{new_id()}", sum(s["rows"] for s in segments)
    shards = shards_for(rows)
    whole = len(segments) == len(state["segments"])
    by_hash = _newest(_read(store, BY_HASH, segments), ["file_hash", "filename"])
    _write(store, BY_NAME, name, _newest(_read(store, BY_NAME, segments), ["filename"]), shards)
    _write(store, BY_HASH, name, by_hash.filter("active") if whole else by_hash, shards)
    return {"dir": name, "rows": rows, "shards": shards, "seq": max(s["seq"] for s in segments)}
