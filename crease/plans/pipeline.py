"""Batch + incremental pipeline over a warehouse directory.

Layout under ``root`` (a shared folder, e.g. under ``spark.checkpoint.dir``):

    _commits/<n>.json        states (``snapshots``): what the warehouse consists of
    feed/entry=..            changed match ids of each commit, numbered in the state
    raw/matches, raw/deliveries, models/<name>    match-grain tables of parts (``match_tables``)
    raw/quarantine/part=..   (filename, file_hash, reason)
    registry/by_name, registry/by_hash            log of ingested files (``sources.registry``)
    raw/src_venues/v=.., seeds/../v=.., models/<dimension>/v=..    small tables, one directory each

``ingest`` writes all files of a run and then commits once: matches, balls, venues, registry
segment and a feed entry with the changed match ids appear together, or not at all. If another
run was committed meanwhile, the ingest starts over against the new registry.

Every model keeps a watermark, the last feed entry it has taken in, committed together with its
rows. ``build`` brings each model from its own watermark to the end of the feed, so whatever
a killed run left behind is done by the next one, and what is done is not done again. Readers
see the models as of the last ``build`` that ended (all of them at one place of the feed).

A change of the venue seeds puts the matches whose venue became known (or unknown) into the
feed. The team and player dimensions keep the latest row of each key and bucket; a run renews
those of the buckets it touched (``intermediate.dimension_candidates``).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease import schemas
from crease.operators import quality
from crease.operators.incremental import BUCKET_COL, BUCKET_WIDTH_DEFAULT, with_bucket
from crease.plans import intermediate as im
from crease.plans import marts as mt
from crease.plans import match_tables as parts
from crease.plans import staging as st
from crease.plans.snapshots import Conflict, Snapshot, Store, new_id
from crease.session import document_writer, together
from crease.sources import files as fs
from crease.sources import registry as rg
from crease.sources import venues as vn

#: Match-grain models in steps: a model reads raw tables and models of earlier steps.
STEPS = [
    ["int_deliveries", "int_matches", "int_match_teams", "int_match_players"],
    ["int_innings", "fct_deliveries_sequence", "fct_dismissed_players", "int_teams"],
    ["fct_batting_order", "fct_bowling_order", "fct_match_summary", "int_players"],
    ["fct_batting_scorecard", "fct_bowling_scorecard"],
]
DIM_MODELS = ["int_venues", "int_teams", "int_players"]
MATCH_MODELS = [m for step in STEPS for m in step if m not in DIM_MODELS]
RAW_TABLES = ["raw/matches", "raw/deliveries"]
#: Times an ingest starts over after another run was committed.
ATTEMPTS = 5
EMPTY = {"epoch": 0, "feed": [], "next": 1, "work": {}, "live": {}, "small": {}, "quarantine": [],
         "registry": rg.EMPTY}


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    bucket_width: int = BUCKET_WIDTH_DEFAULT

    def path(self, *names: str) -> str:
        return "/".join([self.root.rstrip("/"), *names])

    @cached_property
    def store(self) -> Store:
        return Store(self.spark, self.root, EMPTY)

    # --- reading, as of a state ---------------------------------------------------------------
    def small(self, name: str, schema, at: Snapshot | None = None) -> DataFrame:
        """A small table: one directory."""
        entry = (at or self.store.head()).state["small"].get(name)
        if entry is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(entry["dir"]))

    def table(self, name: str, state: dict, shelf: str = "work",
              buckets: list[int] | None = None) -> DataFrame | None:
        entry = state[shelf].get(name)
        if entry is None:
            return None
        if "dir" in entry:  # a dimension
            return self.spark.read.schema(_schema(entry)).parquet(self.path(entry["dir"]))
        return parts.live_rows(self.store, name, entry, state["feed"], buckets)

    def registry(self) -> DataFrame:
        return rg.names(self.store, self.store.head().state["registry"])

    def src_venues(self) -> DataFrame:
        return self.small("raw/src_venues", schemas.SRC_VENUES)

    def venue_city(self) -> DataFrame:
        return self.small("seeds/venue_city", schemas.VENUE_CITY)

    def city_country(self) -> DataFrame:
        return self.small("seeds/city_country", schemas.CITY_COUNTRY)

    def read_table(self, name: str, at: Snapshot | None = None) -> DataFrame | None:
        """A raw table as of the newest state (or a held one), or a model as of its build."""
        state = (at or self.store.head()).state
        return self.table(name, state, "live" if name.startswith("models/") else "work")

    def model_or_none(self, name: str, at: Snapshot | None = None) -> DataFrame | None:
        return self.read_table(f"models/{name}", at)

    def model(self, name: str, at: Snapshot | None = None) -> DataFrame:
        """A model as of the last build that ended; ``at``: as of a state held by the reader."""
        found = self.model_or_none(name, at)
        if found is None:
            raise FileNotFoundError(name)
        return found


def _schema(entry: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry["schema"]))


def _write(wh: Warehouse, name: str, df: DataFrame) -> dict:
    """A new directory for a small table; it counts once a commit names it."""
    path = f"{name}/v={new_id()}"
    df.write.parquet(wh.path(path))
    return {"dir": path}


def _unchanged(base: Snapshot, state: dict, *keys: str) -> None:
    for key in ("epoch", *keys):
        if state[key] != base.state[key]:
            raise Conflict(key)


# --- ingest ----------------------------------------------------------------------------------

def ingest(wh: Warehouse, files: DataFrame, on_changed: str = "replace") -> DataFrame:
    """Load new and changed match files; returns the changed match ids (a written table).

    ``files``: (path, content) rows, e.g. ``spark.read.format("binaryFile")``. They are stored
    once, so that a file rewritten meanwhile keeps the hash of what was loaded."""
    batch = wh.path("batches", new_id())
    document_writer(fs.fingerprint(files.select("path", "content"))).parquet(f"{batch}/files")
    stored = wh.spark.read.parquet(f"{batch}/files")
    return _ingest(wh, stored, on_changed, batch)


def _ingest(wh: Warehouse, stored: DataFrame, on_changed: str, batch: str) -> DataFrame:
    try:
        for _ in range(ATTEMPTS):
            try:
                return _ingest_once(wh, stored, on_changed, f"{batch}/{new_id()}")
            except Conflict:
                continue
        raise Conflict("other runs were committed during every attempt")
    finally:
        wh.store.delete(batch)


def _ingest_once(wh: Warehouse, stored: DataFrame, on_changed: str, batch: str) -> DataFrame:
    spark, store, base = wh.spark, wh.store, wh.store.head()
    log = base.state["registry"]
    listed = stored.select("path", "filename", "file_hash")
    named = fs.one_per_name(listed)
    known = rg.known_hashes(store, log, listed.select("file_hash"))
    named.join(known, "file_hash", "left_anti").write.parquet(f"{batch}/fresh")
    fresh = spark.read.schema(listed.schema).parquet(f"{batch}/fresh")
    size = listed.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("filename").alias("names")).first()
    if on_changed == "error":
        if rg.names(store, log, fresh.select("filename")).limit(1).count() > 0:
            raise ValueError("changed content under an already registered file name")
    elif on_changed != "replace":
        raise ValueError(f"on_changed must be 'replace' or 'error', not {on_changed!r}")

    # of the names that give one match id (7.json, 007.json) the least is loaded
    first = fresh.select("path", "filename", fs.match_id_from_filename("filename").alias("match_id")).select(
        "path", F.expr("min(filename) OVER (PARTITION BY match_id)").alias("__first"))
    if size["n"] <= parts.BROADCAST_IDS:
        first = F.broadcast(first)  # short rows: contents do not move
    parsed = fs.parse_documents(stored.join(first, "path"), keep=["__first"])
    parsed = parsed.withColumn("reason", F.coalesce("reason", F.when(
        F.col("filename") != F.col("__first"), F.lit(fs.REASON_MATCH_TWICE)))).drop("__first")
    document_writer(parsed).parquet(f"{batch}/parsed")  # one parse per run: every later step reads this table
    parsed = spark.read.schema(parsed.schema).parquet(f"{batch}/parsed")
    found = with_bucket(parsed, wh.bucket_width).groupBy(BUCKET_COL, F.col("reason").isNull().alias("ok")).count().collect()
    n_parsed, n_loaded = sum(r["count"] for r in found), sum(r["count"] for r in found if r["ok"])

    refused = fs.quarantine(parsed)
    if size["names"] < size["n"]:
        refused = refused.unionByName(
            listed.join(named.select("path"), "path", "left_anti")
            .join(named.select("filename", F.col("file_hash").alias("__kept")), "filename")
            .filter("file_hash <> __kept")
            .select("filename", "file_hash", F.lit(fs.REASON_NAME_TWICE).alias("reason")))
    n_refused = 0
    if n_loaded < n_parsed or size["names"] < size["n"]:
        if base.state["quarantine"]:
            refused = refused.join(_quarantine(wh, base.state), ["filename", "file_hash"], "left_anti")
        n_refused = refused.count()
    docs = fs.loadable(parsed)
    entry = f"{parts.FEED}/{parts.ENTRY}=e{new_id()}"
    docs.select("match_id").write.parquet(wh.path(entry))  # ids are unique, see above
    changed = spark.read.schema("match_id int").parquet(wh.path(entry))
    if not n_parsed and not n_refused:
        return changed

    def part(name: str, rows: DataFrame) -> Callable:
        return lambda: new.update({name: (rows.schema.json(), parts.add_part(store, name, rows, wh.bucket_width, n_buckets))})

    def venue_rows() -> None:
        before = wh.small("raw/src_venues", schemas.SRC_VENUES, base)
        incoming = vn.batch_venues(docs)
        if incoming.join(before.select("venue_name"), "venue_name", "left_anti").limit(1).count():
            small["raw/src_venues"] = _write(wh, "raw/src_venues", vn.upsert_venues(before, incoming))

    new, small, refusals = {}, {}, []
    n_buckets = len({r[BUCKET_COL] for r in found if r["ok"]})
    segment, jobs = rg.append(store, log, parsed.select("filename", "file_hash"), n_parsed)
    if n_loaded:
        jobs += [part("raw/matches", fs.match_rows(docs)), part("raw/deliveries", fs.flatten_deliveries(docs)), venue_rows]
    if n_refused:
        jobs.append(lambda: refusals.append(_write(wh, "raw/quarantine", refused)["dir"]))
    together(jobs)
    feed = {"dir": entry.split("=")[1], "rows": n_loaded,
            "buckets": sorted(r[BUCKET_COL] for r in found if r["ok"])}

    def change(state: dict) -> None:
        _unchanged(base, state, "registry", "quarantine")
        if state["small"].get("raw/src_venues") != base.state["small"].get("raw/src_venues"):
            raise Conflict("raw/src_venues")
        if n_loaded:
            seq = _add_entry(state, feed, loads=True)
            for name, (schema, written) in new.items():
                table = state["work"].setdefault(name, {"parts": [], "watermark": 0})
                table["schema"], table["watermark"] = schema, seq
                if written["buckets"]:
                    table["parts"].append(written | {"seq": seq})
        state["quarantine"] += refusals
        state["small"].update(small)
        rg.add_segment(state["registry"], segment)

    store.commit(change)
    _merge_registry(wh)
    return changed


def _quarantine(wh: Warehouse, state: dict) -> DataFrame:
    return (wh.spark.read.schema(schemas.QUARANTINE).parquet(*[wh.path(p) for p in state["quarantine"]])
            .select("filename", "file_hash").distinct())


def _feed_entry(wh: Warehouse, path: str, ids: DataFrame) -> dict:
    """Rows and buckets of a written feed entry (as many numbers as buckets)."""
    count = with_bucket(ids, wh.bucket_width).groupBy(BUCKET_COL).count().collect()
    return {"dir": path.split("=")[1], "rows": sum(r["count"] for r in count),
            "buckets": sorted(r[BUCKET_COL] for r in count)}


def _add_entry(state: dict, feed: dict, loads: bool = False) -> int:
    """Number a feed entry; only one that ``loads`` new raw rows hides older ones."""
    seq = state["next"]
    state["feed"].append(feed | {"seq": seq, "loads": loads})
    state["next"] = seq + 1
    return seq


def _merge_registry(wh: Warehouse) -> None:
    base = wh.store.head()
    chosen = rg.merge_candidates(base.state["registry"])
    if not chosen:
        return
    one = rg.merged(wh.store, base.state["registry"], chosen)
    gone = {s["dir"] for s in chosen}

    def change(state: dict) -> None:
        _unchanged(base, state, "registry")
        kept = [s for s in state["registry"]["segments"] if s["dir"] not in gone]
        state["registry"]["segments"] = sorted([*kept, one], key=lambda s: s["seq"])

    try:
        wh.store.commit(change)
    except Conflict:  # the next run merges
        pass


# --- batches of bounded size -------------------------------------------------------------------

def ingest_directory(wh: Warehouse, directory: str, max_bytes: int = 1 << 30, max_files: int = 10_000,
                     glob: str = "*.json", on_changed: str = "replace") -> int:
    """Load a landing directory in batches of at most ``max_bytes`` and ``max_files``, each one
    commit; returns the number of batches. A file above ``max_bytes`` is a batch alone.

    Names, not contents, are listed first; a batch reads its own files only. A run that was killed
    finds the files of its committed batches registered and goes on with the others."""
    spark = wh.spark
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory).select("path", "length")
    plan = wh.path("batches", new_id())
    try:
        found.withColumn("filename", fs.file_name("path")).write.parquet(f"{plan}/files")
        listed = spark.read.parquet(f"{plan}/files")
        # files of one name stay together: only one of them counts (``one_per_name``)
        names = listed.groupBy("filename").agg(F.sum("length").alias("length"), F.count("path").alias("files"))
        dealt = listed.join(fs.dealt_to_batches(names, max_bytes, max_files), "filename")
        dealt.select("path", "batch").write.partitionBy("batch").parquet(f"{plan}/dealt")
        batches = sorted(int(n.split("=")[1]) for n in wh.store.names(f"{plan}/dealt") if n.startswith("batch="))
        for batch in batches:
            # short strings, at most ``max_files`` names
            own = [r["path"] for r in spark.read.parquet(f"{plan}/dealt/batch={batch}").select("path").collect()]
            ingest(wh, spark.read.format("binaryFile").load([_glob_free(p) for p in own]), on_changed)
    finally:
        wh.store.delete(plan)
    return len(batches)


def _glob_free(path: str) -> str:
    """A file's path as a pattern that matches it alone."""
    return "".join("\\" + c if c in "{}[]*?,\\" else c for c in path)


# --- seeds -------------------------------------------------------------------------------------

def _set_small(wh: Warehouse, base: Snapshot, tables: dict[str, DataFrame]) -> None:
    written = {name: _write(wh, name, df) for name, df in tables.items()}

    def change(state: dict) -> None:
        for name in ("raw/src_venues", *written):
            if state["small"].get(name) != base.state["small"].get(name):
                raise Conflict(name)
        state["small"].update(written)

    wh.store.commit(change)


def refresh_seeds(wh: Warehouse) -> None:
    """New venues and cities get their seed rows; seeds without news are not written."""
    for _ in range(ATTEMPTS):
        base = wh.store.head()
        old_vc = wh.small("seeds/venue_city", schemas.VENUE_CITY, base)
        old_cc = wh.small("seeds/city_country", schemas.CITY_COUNTRY, base)
        src, new = wh.small("raw/src_venues", schemas.SRC_VENUES, base), {}
        if vn.new_seed_venues(src, old_vc).limit(1).count():
            new["seeds/venue_city"] = vn.refresh_venue_city(src, old_vc)
        vc = new.get("seeds/venue_city", old_vc)
        if vn.new_seed_cities(vc, old_cc).limit(1).count():
            new["seeds/city_country"] = vn.refresh_city_country(vc, old_cc)
        if not new:
            return
        try:
            return _set_small(wh, base, new)
        except Conflict:
            continue
    raise Conflict("seeds")


#: Seeds, their key columns and schemas.
SEEDS = {"seeds/venue_city": ("venue_name", schemas.VENUE_CITY), "seeds/city_country": ("city", schemas.CITY_COUNTRY)}


def export_seeds(wh: Warehouse, directory: str) -> None:
    """Write both seeds as CSV to edit, and remember which versions were handed out."""
    base = wh.store.head()
    for name, (_, schema) in SEEDS.items():
        vn.write_seed(wh.small(name, schema, base), f"{directory}/{name.split('/')[1]}")
    out = {f"handed/{name}": base.state["small"][name] for name in SEEDS if name in base.state["small"]}
    wh.store.commit(lambda state: state["small"].update(out))


def import_seeds(wh: Warehouse, directory: str) -> None:
    """Merge seeds edited by hand (CSV, as ``export_seeds`` wrote them) into the stored ones. The
    next build takes them to int_venues and to the matches concerned; a refresh adds placeholders
    only for venues and cities that the merged seeds lack."""
    for _ in range(ATTEMPTS):
        base, new = wh.store.head(), {}
        for name, (key, schema) in SEEDS.items():
            edited = vn.read_seed(wh.spark, f"{directory}/{name.split('/')[1]}", schema)
            new[name] = vn.merged_edits(wh.small(name, schema, base), wh.small(f"handed/{name}", schema, base), edited, key)
        try:
            return _set_small(wh, base, new)
        except Conflict:
            continue
    raise Conflict("seeds")


def seed_initial(wh: Warehouse, venue_city: DataFrame, city_country: DataFrame) -> None:
    _set_small(wh, wh.store.head(), {"seeds/venue_city": venue_city.select("venue_name", "city"),
                                     "seeds/city_country": city_country.select("city", "country")})


# --- models ------------------------------------------------------------------------------------

def build(wh: Warehouse, changed: DataFrame | None = None) -> None:
    """Bring every model to the end of the feed and show the result to readers.

    ``changed``: further match ids to recompute; what ``ingest`` returns is in the feed already
    and is not taken in twice."""
    _refresh_venues(wh)
    if changed is not None:
        _recompute(wh, changed)
    state = wh.store.head().state
    target = _end_of_feed(state)
    if any(name not in state["work"] for name in RAW_TABLES):
        return  # nothing was ever loaded
    build_steps(wh, STEPS, target)
    compact(wh)
    _show(wh, target)


def build_steps(wh: Warehouse, steps: list[list[str]], target: int | None = None) -> None:
    """Bring the models of ``steps`` to the end of the feed, without showing them to readers."""
    _refresh_venues(wh)
    target = _end_of_feed(wh.store.head().state) if target is None else target
    for step in steps:
        together([lambda name=name: _bring(wh, name, target) for name in step])


def rebuild(wh: Warehouse) -> None:
    """Recompute every match."""
    matches = wh.read_table("raw/matches")
    if matches is not None:
        _recompute(wh, matches.select("match_id"), waiting=False)
    build(wh)


def _end_of_feed(state: dict) -> int:
    return state["next"] - 1


def _models(state: dict) -> dict[str, dict]:
    return {n: t for n, t in state["work"].items() if n.startswith("models/") and "watermark" in t}


def _recompute(wh: Warehouse, ids: DataFrame, waiting: bool = True) -> None:
    """Put ids into the feed, for the models; with ``waiting`` only those not waiting there."""
    base = wh.store.head()
    marks = [t["watermark"] for t in _models(base.state).values()] or [0]
    pending = [e for e in base.state["feed"] if e["seq"] > min(marks)]
    if waiting and pending:
        ids = ids.join(parts.changed_ids(wh.store, pending).select("match_id"), "match_id", "left_anti")
    path = f"{parts.FEED}/{parts.ENTRY}=e{new_id()}"
    ids.select(F.col("match_id").cast("int")).distinct().write.parquet(wh.path(path))
    feed = _feed_entry(wh, path, wh.spark.read.schema("match_id int").parquet(wh.path(path)))

    def change(state: dict) -> None:
        _unchanged(base, state)
        _add_entry(state, feed)

    if feed["rows"]:
        wh.store.commit(change)


def _refresh_venues(wh: Warehouse) -> None:
    """int_venues follows the seeds; matches whose venue became known or unknown are recomputed."""
    base = wh.store.head()
    seeds = {n: base.state["small"].get(n) for n in ("seeds/venue_city", "seeds/city_country")}
    entry = base.state["work"].get("models/int_venues")
    if entry is not None and entry["seeds"] == seeds:
        return
    venues = im.int_venues(wh.small("seeds/venue_city", schemas.VENUE_CITY, base),
                           wh.small("seeds/city_country", schemas.CITY_COUNTRY, base))
    written = _write(wh, "models/int_venues", venues) | {"schema": venues.schema.json(), "seeds": seeds}
    feed = None
    prior = wh.table("models/int_matches", base.state)
    if prior is not None:
        now = wh.spark.read.schema(venues.schema).parquet(wh.path(written["dir"])).select(
            F.col("venue_name").alias("__venue"), F.lit(True).alias("__known"))
        stale = (wh.table("raw/matches", base.state).select("match_id", F.col("info.venue").alias("__venue"))
                 .join(now, "__venue", "left").join(prior.select("match_id", "venue_id"), "match_id")
                 .filter(F.col("__known").isNotNull() != F.col("venue_id").isNotNull()))
        path = f"{parts.FEED}/{parts.ENTRY}=e{new_id()}"
        stale.select("match_id").distinct().write.parquet(wh.path(path))
        feed = _feed_entry(wh, path, wh.spark.read.schema("match_id int").parquet(wh.path(path)))

    def change(state: dict) -> None:
        _unchanged(base, state, "feed")
        if state["work"].get("models/int_venues") != entry:
            raise Conflict("int_venues")
        state["work"]["models/int_venues"] = written
        if feed and feed["rows"]:
            _add_entry(state, feed)

    try:
        wh.store.commit(change)
    except Conflict:  # another run loaded matches or refreshed the seeds meanwhile
        _refresh_venues(wh)


def _candidates(wh: Warehouse, name: str, state: dict, entry: dict | None, buckets: list[int]) -> dict:
    """The stored candidates of a dimension, those of ``buckets`` anew."""
    junction = wh.table(f"models/{im.CANDIDATES[name][0]}", state, buckets=buckets)
    rows = im.dimension_candidates(name, with_bucket(junction, wh.bucket_width), BUCKET_COL)
    if entry:
        old = wh.spark.read.schema(rows.schema).parquet(wh.path(entry["candidates"]))
        rows = old.filter(~F.col(BUCKET_COL).isin(buckets)).unionByName(rows)
    return _write(wh, f"models/{name}_candidates", rows) | {"schema": rows.schema.json()}


def _rows(name: str, read: Callable, whole: Callable) -> DataFrame:
    """The rows of a match-grain model for the changed matches; ``read`` gives those of its inputs."""
    if name == "int_deliveries":
        return im.int_deliveries(st.stg_deliveries(st.typed_deliveries(read("raw/deliveries"))))
    if name == "int_matches":
        return im.int_matches(st.match_info(read("raw/matches")), whole("int_venues"))
    if name == "int_match_teams":
        return im.int_match_teams(st.match_info(read("raw/matches")), whole("int_venues"))
    if name == "int_match_players":
        return im.int_match_players(st.match_info(read("raw/matches")))
    if name == "int_innings":
        return im.int_innings(read("int_deliveries"))
    if name == "fct_deliveries_sequence":
        return mt.fct_deliveries_sequence(read("int_deliveries"))
    if name == "fct_dismissed_players":
        return mt.fct_dismissed_players(read("int_deliveries"))
    if name == "fct_batting_order":
        return mt.fct_batting_order(read("fct_deliveries_sequence"))
    if name == "fct_bowling_order":
        return mt.fct_bowling_order(read("fct_deliveries_sequence"))
    if name == "fct_match_summary":
        return mt.fct_match_summary(read("int_matches"), read("int_innings"))
    if name == "fct_batting_scorecard":
        return mt.fct_batting_scorecard(read("int_deliveries"), read("fct_batting_order"),
                                        read("fct_dismissed_players"))
    if name == "fct_bowling_scorecard":
        return mt.fct_bowling_scorecard(read("int_deliveries"), read("fct_bowling_order"))
    raise KeyError(name)


def _bring(wh: Warehouse, name: str, target: int) -> None:
    """Recompute the matches that the feed names after the model's watermark; commit rows and
    watermark together."""
    base, key = wh.store.head(), f"models/{name}"
    entry = base.state["work"].get(key)
    mark = entry["watermark"] if entry else 0
    if mark >= target:
        return
    pending = [e for e in base.state["feed"] if mark < e["seq"] <= target]
    buckets = sorted({b for e in pending for b in e["buckets"]})
    ids = parts.changed_ids(wh.store, pending).select("match_id")
    ids = ids.distinct() if len(pending) > 1 else ids
    if sum(e["rows"] for e in pending) <= parts.BROADCAST_IDS:
        ids = F.broadcast(ids)

    def full(table: str) -> str:
        return table if table.startswith("raw/") else f"models/{table}"

    def read(table: str) -> DataFrame:
        found = wh.table(full(table), base.state, buckets=buckets)
        return found.join(ids, "match_id", "left_semi")

    def whole(table: str) -> DataFrame:
        return wh.table(full(table), base.state)

    if name in DIM_MODELS and (pending or entry is None):
        held = _candidates(wh, name, base.state, entry, buckets)
        rows = wh.spark.read.schema(_schema(held)).parquet(wh.path(held["dir"]))
        rows = (im.int_teams(rows, keep_source=True) if name == "int_teams"
                else im.int_players(rows, whole("int_teams"), keep_source=True))
        new = _write(wh, key, rows) | {"schema": rows.schema.json(), "watermark": target, "candidates": held["dir"]}
    elif pending:
        rows = _rows(name, read, whole)
        part = parts.add_part(wh.store, key, rows, wh.bucket_width, len(buckets))
        old = entry["parts"] if entry else []
        added = [part | {"seq": target}] if part["buckets"] else []
        new = {"schema": rows.schema.json(), "watermark": target, "parts": [*old, *added]}
    else:
        new = entry | {"watermark": target}

    def change(state: dict) -> None:
        _unchanged(base, state)
        if state["work"].get(key) != entry:
            raise Conflict(key)
        state["work"][key] = new

    wh.store.commit(change)


QUALITY = T.StructType([T.StructField("test", T.StringType()), T.StructField("model", T.StringType()),
                        T.StructField("column_name", T.StringType()), T.StructField(BUCKET_COL, T.IntegerType()),
                        T.StructField("failures", T.LongType())])


def check(wh: Warehouse, suite: quality.Suite = quality.DECLARED) -> DataFrame:
    """The declared tests on the models that readers see: (test, model, column_name, failures).

    Failures of tests that one match decides are stored per bucket; only buckets that changed since
    the last check are read again. The others (dimensions, references to them, dates) run whole."""
    spark, base = wh.spark, wh.store.head()
    state, stored = base.state, base.state.get("quality")
    shown = {n.split("/")[1]: t for n, t in state["live"].items()}
    local, rest = suite.split([m for m in shown if m in MATCH_MODELS])
    target = min(t["watermark"] for m, t in shown.items() if "watermark" in t)
    mark = stored["watermark"] if stored and stored["epoch"] == state["epoch"] else 0
    if mark == 0:
        touched = sorted({b for t in shown.values() for p in t.get("parts", []) for b in p["buckets"]})
    else:
        touched = sorted({b for e in state["feed"] if mark < e["seq"] <= target for b in e["buckets"]})
    models = {m: wh.table(f"models/{m}", state, "live") for m in shown}
    result = rest.run(models)
    if touched or not mark:
        own = {m: with_bucket(wh.table(f"models/{m}", state, "live", touched), wh.bucket_width) for m in MATCH_MODELS}
        ids = own["int_matches"].select("match_id").distinct()
        counts = spark.createDataFrame([], QUALITY)
        for m in MATCH_MODELS:
            found = quality.by_bucket(own[m], m, local, ids)
            counts = counts if found is None else counts.unionByName(found)
        if mark:
            old = spark.read.schema(QUALITY).parquet(wh.path(stored["dir"]))
            counts = counts.unionByName(old.filter(~F.col(BUCKET_COL).isin(touched)))
        written = _write(wh, "quality", counts.select(*QUALITY.names)) | {"watermark": target, "epoch": state["epoch"]}

        def change(state: dict) -> None:
            _unchanged(base, state)
            if state.get("quality") != stored:
                raise Conflict("quality")
            state["quality"] = written

        wh.store.commit(change)
        stored = written
    declared = spark.createDataFrame(local.tests(), "test string, model string, column_name string")
    sums = (spark.read.schema(QUALITY).parquet(wh.path(stored["dir"])).groupBy("test", "model", "column_name")
            .agg(F.sum("failures").alias("failures")))
    return result.unionByName(declared.join(sums, ["test", "model", "column_name"], "left").select(
        "test", "model", "column_name", F.coalesce("failures", F.lit(0)).alias("failures")))


def compact(wh: Warehouse, max_parts: int = parts.MAX_PARTS) -> None:
    """Rewrite the buckets that lie in more than ``max_parts`` parts."""
    def one(name: str) -> None:
        base = wh.store.head()
        entry = base.state["work"][name]
        buckets = parts.crowded_buckets(entry, max_parts)
        if not buckets:
            return
        rows = wh.table(name, base.state, buckets=buckets)
        part = parts.add_part(wh.store, name, rows, wh.bucket_width, len(buckets)) | {"seq": entry["watermark"]}

        def change(state: dict) -> None:
            _unchanged(base, state)
            if state["work"].get(name) != entry:
                raise Conflict(name)
            parts.without_buckets(state["work"][name], buckets)
            if part["buckets"]:
                state["work"][name]["parts"].append(part)

        try:
            wh.store.commit(change)
        except Conflict:  # it has been written to meanwhile; the next build looks again
            pass

    tables = [n for n, t in wh.store.head().state["work"].items() if "parts" in t]
    together([lambda n=n: one(n) for n in tables])


def _show(wh: Warehouse, target: int) -> None:
    """Readers see the models of this build; feed entries that nothing needs any more go."""
    def change(state: dict) -> None:
        if all(t["watermark"] >= target for t in _models(state).values()):
            state["live"] = {n: t for n, t in state["work"].items() if n.startswith("models/")}
        if len(_models(state)) == sum(map(len, STEPS)):
            tables = [(n, t) for shelf in ("work", "live") for n, t in state[shelf].items() if "watermark" in t]
            if state.get("quality"):  # a check still has to read what changed
                tables.append(("quality", state["quality"]))
            state["feed"] = parts.needed_entries(state["feed"], tables)

    wh.store.commit(change)


def run(wh: Warehouse, files: DataFrame, seeds: bool = True) -> None:
    """One pipeline run: ingest, optional seed refresh, build of whatever is not built yet."""
    ingest(wh, files)
    if seeds:
        refresh_seeds(wh)
    build(wh)


def reset(wh: Warehouse) -> None:
    """Start over: no raw tables, models, quarantine, registry or source venues. Seeds stay."""
    def change(state: dict) -> None:
        state["epoch"] += 1
        state.update(feed=[], work={}, live={}, quarantine=[],
                     registry=rg.EMPTY | {"next": state["registry"]["next"]})
        state["small"].pop("raw/src_venues", None)
        state.pop("quality", None)

    wh.store.commit(change)
    vacuum(wh, keep=1)


def vacuum(wh: Warehouse, keep: int = 10) -> list[str]:
    """Remove the files that none of the last ``keep`` states names. Not during a run."""
    def named(state: dict) -> set[str]:
        out = {t["dir"] for t in state["small"].values()} | set(state["quarantine"])
        out |= {state["quality"]["dir"]} if state.get("quality") else set()
        out |= {f"{parts.FEED}/{parts.ENTRY}={e['dir']}" for e in state["feed"]}
        out |= {f"{layout}/segment={s['dir']}" for s in state["registry"]["segments"]
                for layout in (rg.BY_NAME, rg.BY_HASH)}
        for shelf in ("work", "live"):
            for name, table in state[shelf].items():
                out |= {table["candidates"]} if "candidates" in table else set()
                out |= {table["dir"]} if "dir" in table else {f"{name}/{parts.PART}={p['dir']}" for p in table["parts"]}
        return out

    folders = [*RAW_TABLES, "raw/quarantine", "raw/src_venues", "seeds/venue_city", "seeds/city_country",
               parts.FEED, rg.BY_NAME, rg.BY_HASH, "batches", "quality",
               *[f"models/{m}" for m in (*MATCH_MODELS, *DIM_MODELS, *[f"{d}_candidates" for d in im.CANDIDATES])]]
    return wh.store.vacuum(named, folders, keep)
