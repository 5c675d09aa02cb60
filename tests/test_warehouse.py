"""The warehouse as committed states: interrupted runs, concurrent runs, readers, corrections,
file names, bounded batches, whole documents, edited seeds."""

import glob
import json
import os
import random
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import match_files as mf
from crease.operators.sequence import running_sums
from crease.plans import intermediate as im
from crease.plans import marts as mt
from crease.plans import match_tables, pipeline
from crease.plans import staging as st
from crease.plans.snapshots import Conflict, Store
from crease.plans.world import store
from crease.session import DOCUMENT_ROWS, scratch_path
from crease.sources import files as fs
from crease.sources import registry as rg
from crease.streaming import landing


def warehouse(spark, width=8):
    wh = pipeline.Warehouse(spark, scratch_path(spark, "test-wh"), bucket_width=width)
    pipeline.seed_initial(wh, spark.createDataFrame([], "venue_name string, city string"),
                          spark.createDataFrame([], "city string, country string"))
    return wh


def frame(spark, files):
    """(path, content) rows from {path: document or text}."""
    rows = []
    for p, d in files.items():
        if not isinstance(d, str):  # no two matches have the same content
            d = json.loads(json.dumps(d))
            d["info"]["event"]["match_number"] = int(os.path.basename(p).split(".")[0])
            d = json.dumps(d)
        rows.append((p, bytearray(d.encode())))
    return spark.createDataFrame(rows, "path string, content binary")


def match(runs=1, venue="Eden Gardens", overs=2):
    """A small match: ``overs`` overs of two balls, ``runs`` each."""
    doc = mf.match_1001()
    ball = {"batter": "a1", "non_striker": "a2", "bowler": "b1", "runs": {"batter": runs, "extras": 0, "total": runs}}
    doc["innings"] = [{"team": "A", "overs": [{"over": o, "deliveries": [ball, ball]} for o in range(overs)]}]
    doc["info"]["venue"] = venue
    return doc


def rows(df, drop=("last_update", "hash_id")):
    kept = [c for c in sorted(df.columns) if c not in drop]
    return sorted(map(repr, df.select(*kept).collect()))


def from_raw(wh, name):
    """A model computed at one go from the raw tables."""
    raw_m, raw_d = wh.read_table("raw/matches"), wh.read_table("raw/deliveries")
    venues = im.int_venues(wh.venue_city(), wh.city_country())
    info = st.match_info(raw_m)
    balls = st.stg_deliveries(st.typed_deliveries(raw_d))
    seq = mt.fct_deliveries_sequence(balls)
    teams = im.int_teams(im.int_match_teams(info, venues), keep_source=True)
    return {
        "int_deliveries": lambda: balls, "int_matches": lambda: im.int_matches(info, venues),
        "int_match_teams": lambda: im.int_match_teams(info, venues),
        "int_match_players": lambda: im.int_match_players(info), "int_innings": lambda: im.int_innings(balls),
        "fct_deliveries_sequence": lambda: seq, "fct_dismissed_players": lambda: mt.fct_dismissed_players(balls),
        "fct_batting_order": lambda: mt.fct_batting_order(seq), "fct_bowling_order": lambda: mt.fct_bowling_order(seq),
        "fct_match_summary": lambda: mt.fct_match_summary(im.int_matches(info, venues), im.int_innings(balls)),
        "fct_batting_scorecard": lambda: mt.fct_batting_scorecard(
            balls, mt.fct_batting_order(seq), mt.fct_dismissed_players(balls)),
        "fct_bowling_scorecard": lambda: mt.fct_bowling_scorecard(balls, mt.fct_bowling_order(seq)),
        "int_teams": lambda: teams,
        "int_players": lambda: im.int_players(im.int_match_players(info), teams, keep_source=True),
    }[name]()


ALL_MODELS = [m for step in pipeline.STEPS for m in step]


# --- commits ------------------------------------------------------------------------------------

def test_commits_of_many_writers_all_land(spark):
    store = Store(spark, scratch_path(spark, "store"), {"n": 0, "by": []})

    def writer(k):
        def change(state):
            state["n"] += 1
            state["by"].append(k)
        store.commit(change)

    threads = [threading.Thread(target=writer, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    head = store.head()
    assert head.number == head.state["n"] == 8 and sorted(head.state["by"]) == list(range(8))
    assert not [n for n in store.names(f"{store.root}/_commits") if "draft" in n]


def test_a_taken_number_is_not_overwritten(spark):
    store = Store(spark, scratch_path(spark, "store"), {"n": 0})
    assert store._publish(1, '{"n": 1}') is True
    assert store._publish(1, '{"n": 9}') is False
    assert store.head().state == {"n": 1}


def test_a_change_based_on_an_old_state_gives_up(spark):
    wh = warehouse(spark)
    base = wh.store.head()
    pipeline.seed_initial(wh, spark.createDataFrame([("Oval", "London")], "venue_name string, city string"),
                          spark.createDataFrame([], "city string, country string"))
    with pytest.raises(Conflict):
        pipeline._set_small(wh, base, {"seeds/venue_city": wh.venue_city()})
    assert wh.venue_city().count() == 1


# --- interrupted runs ------------------------------------------------------------------------------

class Killed(Exception):
    pass


def test_a_run_killed_before_its_commit_leaves_the_old_state(spark, monkeypatch):
    wh = warehouse(spark)
    pipeline.run(wh, frame(spark, {"l/1.json": match()}))
    before = wh.store.head()

    def kill(*a, **k):
        raise Killed
    with monkeypatch.context() as m:
        m.setattr(rg, "append", kill)
        with pytest.raises(Killed):
            pipeline.run(wh, frame(spark, {"l/1.json": match(runs=4), "l/2.json": match()}))
    assert wh.store.head() == before
    assert [r.match_id for r in wh.read_table("raw/matches").collect()] == [1]
    assert {r.runs for r in wh.read_table("models/int_deliveries").collect()} == {1}
    assert wh.registry().count() == 1
    pipeline.run(wh, frame(spark, {"l/1.json": match(runs=4), "l/2.json": match()}))
    assert {(r.match_id, r.runs) for r in wh.model("int_deliveries").collect()} == {(1, 4), (2, 1)}


def test_a_run_killed_in_any_model_is_caught_up(spark, monkeypatch):
    """The first run ends before any model; then a build is killed in each model in turn, while
    corrections and new matches arrive: every model stands at another place of the feed."""
    wh = warehouse(spark)
    pipeline.ingest(wh, frame(spark, {"l/1.json": mf.match_1001(), "l/2.json": match(2)}))
    pipeline.refresh_seeds(wh)
    assert wh.model_or_none("int_matches") is None
    pipeline.build(wh)
    shown = {m: rows(wh.model(m)) for m in ("int_innings", "fct_match_summary")}
    bring = pipeline._bring
    for k, name in enumerate(ALL_MODELS):
        def killed(wh_, model, target, name=name):
            if model == name:
                raise Killed
            bring(wh_, model, target)
        if k % 3 == 0:
            pipeline.ingest(wh, frame(spark, {"l/1.json": match(k % 6, overs=1 + k % 3), f"l/{100 + k}.json": match(k % 5)}))
        with monkeypatch.context() as m:
            m.setattr(pipeline, "_bring", killed)
            with pytest.raises(Killed):
                pipeline.build(wh)
    assert {m: rows(wh.model(m)) for m in shown} == shown  # readers still see the former build
    pipeline.build(wh)
    marks = {t["watermark"] for t in pipeline._models(wh.store.head().state).values()}
    assert marks == {pipeline._end_of_feed(wh.store.head().state)}
    for name in ALL_MODELS:
        assert rows(wh.model(name)) == rows(from_raw(wh, name)), name


def test_a_build_without_news_writes_no_model(spark):
    wh = warehouse(spark)
    pipeline.run(wh, frame(spark, {"l/1.json": match()}))
    before = wh.store.head().state["work"]
    pipeline.run(wh, frame(spark, {"l/1.json": match()}))
    assert wh.store.head().state["work"] == before


def test_rebuild_recomputes_every_match(spark):
    wh = warehouse(spark)
    pipeline.run(wh, frame(spark, {"l/1.json": match(), "l/9.json": match(3)}))
    few = ALL_MODELS[::4]
    before = {m: rows(wh.model(m)) for m in few}
    seqs = {p["seq"] for p in wh.store.head().state["work"]["models/int_innings"]["parts"]}
    pipeline.rebuild(wh)
    assert {m: rows(wh.model(m)) for m in few} == before
    assert {p["seq"] for p in wh.store.head().state["work"]["models/int_innings"]["parts"]} != seqs
    assert wh.read_table("raw/matches").count() == 2  # a recomputation hides no raw rows
    pipeline.run(wh, frame(spark, {"l/17.json": match()}))
    assert wh.read_table("raw/matches").count() == 3 and wh.model("int_matches").count() == 3


# --- concurrent runs and readers ------------------------------------------------------------------------

def test_an_ingest_that_loses_the_race_starts_over(spark, monkeypatch):
    wh = warehouse(spark)
    append, calls = rg.append, []

    def other_run_first(store, state, added, n):
        calls.append(1)
        if len(calls) == 1:  # meanwhile another run commits, with one file in common
            pipeline.ingest(wh, frame(spark, {"l/1.json": match(), "l/2.json": match()}))
        return append(store, state, added, n)

    monkeypatch.setattr(rg, "append", other_run_first)
    changed = pipeline.ingest(wh, frame(spark, {"l/2.json": match(), "l/3.json": match(5)}))
    assert [r.match_id for r in changed.collect()] == [3]  # 2 was loaded by the other
    assert sorted(r.match_id for r in wh.read_table("raw/matches").collect()) == [1, 2, 3]
    assert wh.read_table("raw/deliveries").count() == 12 and wh.registry().count() == 3


def test_a_reader_keeps_its_state(spark):
    wh = warehouse(spark)
    pipeline.run(wh, frame(spark, {"l/1.json": match(1)}))
    held = wh.store.head()
    pipeline.ingest(wh, frame(spark, {"l/1.json": match(6, overs=1), "l/2.json": match(6)}))
    # matches and balls of one commit; the models of the former build
    assert sorted(r.match_id for r in wh.read_table("raw/matches").collect()) == [1, 2]
    assert {(r.match_id, r.n) for r in wh.read_table("raw/deliveries").groupBy("match_id").agg(
        F.count("*").alias("n")).collect()} == {(1, 2), (2, 4)}
    assert {r.runs for r in wh.model("int_deliveries").collect()} == {1}
    pipeline.build(wh)
    assert {(r.match_id, r.runs) for r in wh.model("int_deliveries").collect()} == {(1, 6), (2, 6)}
    assert wh.model("int_deliveries", held).count() == 4
    assert [r.match_id for r in wh.read_table("raw/matches", held).collect()] == [1]


# --- corrections ----------------------------------------------------------------------------------------

def files_below(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path.removeprefix("file:")) for f in names if f.endswith(".parquet")}


def test_random_corrections_equal_a_rewrite(spark):
    wh, rng, now = warehouse(spark, width=4), random.Random(5), {}
    for step in range(4):
        ids = list(range(1, 13)) if step == 0 else rng.sample(range(1, 16), 3)
        for i in ids:
            now[i] = match(rng.randrange(7), overs=rng.randrange(1, 5))
        old = files_below(wh.path("raw/deliveries"))
        pipeline.ingest(wh, frame(spark, {f"l/{i}.json": now[i] for i in ids}))
        new = files_below(wh.path("raw/deliveries"))
        assert old.items() <= new.items()  # nothing is rewritten: a correction adds its own rows
        got = {(r.match_id, r.n, r.t) for r in wh.read_table("raw/deliveries").groupBy("match_id").agg(
            F.count("*").alias("n"), F.sum(F.expr("variant_get(delivery, '$.runs.total', 'int')")).alias("t")).collect()}
        want = {(i, 2 * len(d["innings"][0]["overs"]),
                 sum(b["runs"]["total"] for o in d["innings"][0]["overs"] for b in o["deliveries"])) for i, d in now.items()}
        assert got == want
    before = rows(wh.read_table("raw/deliveries"))
    pipeline.build(wh)
    pipeline.compact(wh, max_parts=1)
    assert not match_tables.crowded_buckets(wh.store.head().state["work"]["raw/deliveries"], 1)
    assert rows(wh.read_table("raw/deliveries")) == before
    for name in ("int_deliveries", "fct_batting_scorecard", "fct_match_summary"):
        assert rows(wh.model(name)) == rows(from_raw(wh, name))
    pipeline.build(wh)
    assert wh.store.head().state["feed"] == []  # one part a bucket, all taken in: no entry is needed
    gone = pipeline.vacuum(wh, keep=1)
    assert any(g.startswith("raw/deliveries/part=") for g in gone)
    assert rows(wh.read_table("raw/deliveries")) == before
    assert rows(wh.model("fct_batting_scorecard")) == rows(from_raw(wh, "fct_batting_scorecard"))


def test_an_emptied_match_leaves_no_rows(spark):
    wh = warehouse(spark)
    pipeline.run(wh, frame(spark, {"l/1.json": match()}))
    empty = match()
    empty["innings"] = []
    pipeline.run(wh, frame(spark, {"l/1.json": empty}))
    assert wh.read_table("raw/deliveries").count() == 0 and wh.model("int_deliveries").count() == 0
    assert wh.model("fct_batting_scorecard").count() == 0 and wh.model("int_matches").count() == 1


def test_dimensions_survive_additions_and_removals(spark, monkeypatch):
    """Random corrections change teams and squads; only junction rows of touched buckets are read."""
    wh, rng, read = warehouse(spark, width=4), random.Random(9), []
    live = match_tables.live_rows

    def seen(store, table, state, feed, buckets=None):
        read.append((table, buckets))
        return live(store, table, state, feed, buckets)

    monkeypatch.setattr(match_tables, "live_rows", seen)
    for step in range(4):
        files = {}
        for i in (range(1, 15) if step == 0 else rng.sample(range(1, 15), 2)):
            d = match(rng.randrange(7))
            a, b = rng.sample("ABCD", 2)
            squad = {t: rng.sample([f"{t}{k}" for k in range(5)], 3) for t in (a, b)}
            d["info"] |= {"teams": [a, b], "players": squad, "venue": rng.choice(["Oval", "Lords"]),
                          "registry": {"people": {p: f"id-{p}" for s in squad.values() for p in s[1:]}}}
            files[f"l/{i}.json"] = d
        read.clear()
        pipeline.run(wh, frame(spark, files))
        touched = sorted({int(p[2:-5]) // 4 for p in files})
        junctions = [b for t, b in read if t.startswith("models/int_match_")]
        assert junctions and all(b == touched for b in junctions)
        for name in ("int_teams", "int_players"):
            assert rows(wh.model(name)) == rows(from_raw(wh, name)), (step, name)


# --- names and registry ----------------------------------------------------------------------------------

def test_one_file_per_name_and_per_match(spark):
    wh = warehouse(spark)
    seen = {"a/7.json": match(1), "b/7.json": match(2), "c/07.json": match(3), "c/8.json": match(4), "d/8.json": match(4)}
    for _ in range(2):  # the choice stays the same in every run that sees the files
        pipeline.ingest(wh, frame(spark, seen))
        assert [(r.match_id, r.filename) for r in wh.read_table("raw/matches").join(
            wh.registry(), F.col("hash_id") == F.col("file_hash")).orderBy("match_id", "filename").collect()] == [
            (7, "07.json"), (8, "8.json")]
        assert wh.registry().count() == 3
    refused = [(r.filename, r.reason) for r in spark.read.parquet(wh.path("raw/quarantine")).collect()]
    assert sorted(refused) == sorted([("7.json", fs.REASON_MATCH_TWICE), ("7.json", fs.REASON_NAME_TWICE)])


def test_registry_follows_corrections_and_returns(spark, monkeypatch):
    monkeypatch.setattr(rg, "MAX_SEGMENTS", 2)
    monkeypatch.setattr(rg, "ROWS_PER_SHARD", 2)
    wh, now = warehouse(spark), {}
    steps = [{i: 0 for i in range(1, 9)}, {1: 1}, {1: 0}, {2: 3, 9: 1}, {1: 2, 2: 0}]
    for step in steps:
        changed = pipeline.ingest(wh, frame(spark, {f"l/{i}.json": match(r, venue=f"v{i}") for i, r in step.items()}))
        new = {i for i, r in step.items() if now.get(i) != r}
        assert {r.match_id for r in changed.collect()} == new
        now |= step
    again = pipeline.ingest(wh, frame(spark, {f"l/{i}.json": match(r, venue=f"v{i}") for i, r in now.items()}))
    assert again.count() == 0
    assert wh.registry().count() == len(now)
    state = wh.store.head().state["registry"]
    assert len(state["segments"]) <= 2 + 1 and any(s["shards"] > 1 for s in state["segments"])
    # a lookup reads the shards of its own keys
    one = spark.createDataFrame([("l",)], "x string").select(F.md5(F.lit("?")).alias("file_hash"))
    lots = [s for s in state["segments"] if s["shards"] > 1]
    read = rg._read(wh.store, rg.BY_HASH, lots, one).inputFiles()
    assert len(read) <= len(lots) and len(rg._read(wh.store, rg.BY_HASH, lots).inputFiles()) > len(lots)


def test_changed_content_can_be_an_error(spark):
    wh = warehouse(spark)
    pipeline.ingest(wh, frame(spark, {"l/1.json": match()}))
    with pytest.raises(ValueError):
        pipeline.ingest(wh, frame(spark, {"l/1.json": match(2)}), on_changed="error")
    with pytest.raises(ValueError):
        pipeline.ingest(wh, frame(spark, {"l/2.json": match(2)}), on_changed="ignore")
    assert wh.store.names(wh.path("batches")) == []  # staged copies go with the run


def test_registry_append_names_once(spark):
    reg = spark.createDataFrame([("1.json", "x")], "filename string, file_hash string").withColumn(
        "ingested_at", F.current_timestamp())
    fresh = spark.createDataFrame([("7.json", "b"), ("7.json", "a"), ("1.json", "y")], "filename string, file_hash string")
    got = {(r.filename, r.file_hash) for r in fs.registry_append(reg, fresh).collect()}
    assert got == {("1.json", "y"), ("7.json", "a")}


# --- bounded batches -----------------------------------------------------------------------------------------

def test_running_sums_over_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 11).alias("v")).repartition(7)
    got = {r.k: r["__v"] for r in running_sums(df, "k", ["v"]).collect()}
    total = 0
    for k, v in sorted((i * 7919 % 5003, i % 11) for i in range(5000)):
        total += v
        assert got[k] == total
    assert running_sums(df.limit(0), "k", ["v"]).count() == 0


@pytest.mark.parametrize("bounds", [(1000, 50), (5000, 7), (100, 1)])
def test_batches_keep_their_bounds(spark, bounds):
    rng = random.Random(3)
    sizes = {f"f{i:04}": rng.choice([0, 5, 90, 400, 700, 3000]) for i in range(300)}
    df = spark.createDataFrame([(n, s, 1) for n, s in sizes.items()], "filename string, length long, files int")
    dealt = {}
    for r in fs.dealt_to_batches(df, *bounds).collect():
        dealt.setdefault(r.batch, []).append(sizes[r.filename])
    assert sum(map(len, dealt.values())) == 300
    for members in dealt.values():
        assert len(members) == 1 or (sum(members) <= bounds[0] and len(members) <= bounds[1])


def test_a_directory_is_loaded_in_batches_and_resumed(spark, tmpdir_path, monkeypatch):
    docs = {i: match(i % 7, overs=1 + i % 4) for i in range(1, 13)}
    for i, d in docs.items():
        d["info"]["event"]["match_number"] = i
        mf.write(tmpdir_path, f"{i}.json", d)
    mf.write(os.path.join(tmpdir_path, "x[1]"), "13.json", match())
    wh, ingest, calls = warehouse(spark), pipeline.ingest, []

    def killed_in_third(wh_, files, on_changed):
        calls.append(files.count())
        if len(calls) == 3:
            raise Killed
        return ingest(wh_, files, on_changed)

    with monkeypatch.context() as m:
        m.setattr(pipeline, "ingest", killed_in_third)
        with pytest.raises(Killed):
            pipeline.ingest_directory(wh, tmpdir_path, max_files=4)
    done = wh.read_table("raw/matches").count()
    assert 0 < done == sum(calls[:2]) and max(calls) <= 4
    loaded = []

    def counted(wh_, files, on_changed):
        changed = ingest(wh_, files, on_changed)
        loaded.append(changed.count())
        return changed

    monkeypatch.setattr(pipeline, "ingest", counted)
    assert pipeline.ingest_directory(wh, tmpdir_path, max_files=4) == len(loaded) > 2
    assert sum(loaded) == 12 - done and wh.read_table("raw/matches").count() == 12


# --- whole documents -------------------------------------------------------------------------------------------

def test_unknown_keys_survive_and_are_reported(spark):
    wh, doc = warehouse(spark), match()
    doc["info"]["event"]["match_number"] = 1
    doc["source"] = {"revision": 2}
    doc["info"]["officials"] = {"umpires": ["u1", "u2"]}
    balls = doc["innings"][0]["overs"][0]["deliveries"]
    balls[0] = balls[0] | {"review": {"by": "A", "decision": "upheld"}, "wickets": [
        {"player_out": "a1", "kind": "caught", "fielders": [{"name": "b7"}]}], "extras": {"wides": None}}
    doc["innings"][0]["target"] = {"runs": 9}
    pipeline.run(wh, frame(spark, {"l/1.json": doc, "l/2.json": match()}))
    whole = wh.read_table("raw/matches").filter("match_id = 1").select(F.to_json("document").alias("d")).first().d
    assert json.loads(whole) == doc
    got = wh.read_table("raw/deliveries").filter("match_id = 1 AND n_over = 0").select(
        F.expr("variant_get(delivery, '$.review.decision', 'string')").alias("r"),
        F.expr("variant_get(delivery, '$.wickets[0].fielders[0].name', 'string')").alias("f")).collect()
    assert sorted(map(tuple, got), key=repr) == [("upheld", "b7"), (None, None)]
    first = wh.model("int_deliveries").filter("match_id = 1 AND over_number = 0 AND ball_in_over = 0").first()
    # a key that is present with a null still counts as present
    assert (first.player_out, first.dismissal_mode, first.wides, first.is_legal) == ("a1", "caught", 0, False)
    drift = {(r.level, r["key"]): (r.n_objects, r.n_documents, r.value_type) for r in
             fs.unknown_keys(wh.read_table("raw/matches")).collect()}
    ball = "$.innings[].overs[].deliveries[]"
    assert drift[("$", "source")] == (1, 1, "OBJECT<revision: BIGINT>")
    assert drift[("$.innings[]", "target")] == (1, 1, "OBJECT<runs: BIGINT>")
    assert drift[(ball, "review")] == (1, 1, "OBJECT<by: STRING, decision: STRING>")
    assert drift[(ball + ".wickets[]", "fielders")] == (1, 1, "ARRAY<OBJECT<name: STRING>>")
    assert (ball, "batter") not in drift and ("$.info", "venue") not in drift


def test_documents_are_read_a_few_at_a_time(spark):
    """A reader takes up to 4096 rows of a row group at once, and a document holds a whole match."""
    def most_rows(folder):
        groups = [pq.ParquetFile(f).metadata for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)]
        return max(m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups))

    wh = warehouse(spark, width=1000)
    files = frame(spark, {f"l/{i}.json": match(runs=i % 7) for i in range(150)}).coalesce(1)
    kept = store(files, "files", documents=True)
    assert kept.count() == 150 and most_rows(_local(kept.inputFiles()[0])) <= DOCUMENT_ROWS
    pipeline.run(wh, files)
    assert most_rows(_local(wh.path("raw/matches"))) <= DOCUMENT_ROWS
    assert most_rows(_local(wh.path("raw/deliveries"))) > DOCUMENT_ROWS  # balls are short rows
    assert wh.model("int_matches").count() == 150


def test_variants_are_stored_as_they_are(spark):
    """Spark would keep the first documents of a file and look through all their values for a layout."""
    wh = warehouse(spark, width=1000)
    pipeline.run(wh, frame(spark, {f"l/{i}.json": match(runs=i % 7) for i in range(20)}))
    for table, column in (("raw/matches", "document"), ("raw/deliveries", "delivery")):
        for f in glob.glob(f"{_local(wh.path(table))}/**/*.parquet", recursive=True):
            fields = {c.path for c in map(pq.ParquetFile(f).schema.column, range(len(pq.ParquetFile(f).schema)))}
            assert {c for c in fields if c.split(".")[0] == column} == {f"{column}.metadata", f"{column}.value"}
    balls = wh.read_table("raw/deliveries").select(F.try_variant_get("delivery", "$.batter", "string").alias("b"))
    assert balls.count() and balls.filter("b IS NULL").isEmpty()


def _local(path):
    """The folder of a file, or a folder, as the local file system knows it."""
    path = path.removeprefix("file://").removeprefix("file:")
    return os.path.dirname(path) if path.endswith(".parquet") else path


# --- quality ----------------------------------------------------------------------------------------------------

def test_quality_counts_follow_corrections(spark, monkeypatch):
    from crease.operators import quality

    def report(df):
        return {(r.test, r.model, r.column_name): r.failures for r in df.collect()}
    wh, now = warehouse(spark, width=4), {}

    def doc(i, bad):
        d = match(i % 5)
        if bad:
            d["info"]["gender"] = None
            d["innings"][0]["overs"][0]["deliveries"][0] = {"runs": {"batter": 1, "extras": 0, "total": 1}}
        return d

    read = []
    live = match_tables.live_rows

    def seen(store, table, state, feed, buckets=None):
        read.append((table, tuple(buckets) if buckets is not None else None))
        return live(store, table, state, feed, buckets)

    for step in ({i: i % 3 == 0 for i in range(1, 13)}, {3: False, 5: True}, {}, {14: True}):
        now |= step
        if step:
            pipeline.run(wh, frame(spark, {f"l/{i}.json": doc(i, bad) for i, bad in step.items()}))
        read.clear()
        with monkeypatch.context() as m:
            m.setattr(match_tables, "live_rows", seen)
            got = report(pipeline.check(wh))
        buckets = {b for t, b in read if t == "models/int_deliveries" and b is not None}
        assert buckets == ({(0, 1, 2, 3)} if len(step) > 2 else {tuple(sorted({i // 4 for i in step}))} if step else set())
        want = report(quality.DECLARED.run({m: wh.model(m) for m in (*pipeline.MATCH_MODELS, *pipeline.DIM_MODELS)}))
        assert got == want and len(got) == 89
        bad = sum(now.values())
        assert got[("not_null", "int_matches", "gender")] == bad == got[("not_null", "int_deliveries", "batter")]


# --- seeds ------------------------------------------------------------------------------------------------------

def test_matches_follow_the_venue_seeds(spark):
    wh = warehouse(spark)
    pipeline.run(wh, frame(spark, {"l/1.json": match(venue="Oval"), "l/2.json": match(venue="Lords")}), seeds=False)
    assert {r.venue_id for r in wh.model("int_matches").collect()} == {None}
    assert wh.model("int_match_teams").count() == 0 and wh.model("int_teams").count() == 0
    pipeline.refresh_seeds(wh)
    pipeline.build(wh)  # no new files, but both venues are known now
    assert all(r.venue_id for r in wh.model("int_matches").collect())
    for name in ("int_match_teams", "int_teams", "int_players"):
        assert rows(wh.model(name)) == rows(from_raw(wh, name)), name


def test_seeds_edited_by_hand_reach_the_venues(spark, tmpdir_path):
    wh = warehouse(spark)
    first = {"l/1.json": match(venue="Oval"), "l/2.json": match(venue="Lords")}
    for d in first.values():
        d["info"]["city"] = ""
    pipeline.run(wh, frame(spark, first))
    before = {r.venue_name: (r.city, r.country) for r in wh.model("int_venues").collect()}
    assert before == {"Oval": ("Oval-CITY", "UNKNOWN"), "Lords": ("Lords-CITY", "UNKNOWN")}
    pipeline.export_seeds(wh, tmpdir_path)
    pipeline.run(wh, frame(spark, {"l/3.json": match(venue="Gabba")}))  # the stored seed goes on meanwhile
    for name, text in (("venue_city", "venue_name,city\nOval,London\nLords,Lords-CITY\n"),
                       ("city_country", "city,country\nLondon,England\nLords-CITY,UNKNOWN\n")):
        for f in os.listdir(os.path.join(tmpdir_path, name)):
            os.remove(os.path.join(tmpdir_path, name, f))
        with open(os.path.join(tmpdir_path, name, "edited.csv"), "w") as f:
            f.write(text)
    pipeline.import_seeds(wh, tmpdir_path)
    for _ in range(2):  # a refresh does not undo the edit
        pipeline.refresh_seeds(wh)
        pipeline.build(wh)
        after = {r.venue_name: (r.city, r.country) for r in wh.model("int_venues").collect()}
        assert after == {"Oval": ("London", "England"), "Lords": ("Lords-CITY", "UNKNOWN"), "Gabba": ("Kolkata", "UNKNOWN")}
    assert {r.city for r in wh.city_country().collect()} == {"London", "Lords-CITY", "Kolkata"}


def test_merged_edits(spark):
    from crease.sources import venues as vn

    def seed(*pairs):
        return spark.createDataFrame(list(pairs), "venue_name string, city string")
    handed = seed(("a", "1"), ("b", "2"), ("c", None), ("d", "4"))
    edited = seed(("a", "1"), ("b", "9"), ("d", "4"), ("e", "5"), ("e", "5"))     # b changed, c gone, e new
    stored = seed(("a", "1"), ("b", "2"), ("c", None), ("d", "4"), ("e", "e-CITY"), ("f", "f-CITY"), (None, "x"))
    got = sorted(map(tuple, vn.merged_edits(stored, handed, edited, "venue_name").collect()), key=repr)
    assert got == sorted([("a", "1"), ("b", "9"), ("d", "4"), ("e", "5"), ("f", "f-CITY"), (None, "x")], key=repr)
    assert vn.merged_edits(stored, handed, handed, "venue_name").count() == 7      # no edit


# --- stream -----------------------------------------------------------------------------------------------------

def test_a_replayed_micro_batch_catches_up(spark, tmpdir_path, monkeypatch):
    mf.write(os.path.join(tmpdir_path, "in"), "5.json", match(3))
    wh, checkpoint = warehouse(spark), scratch_path(spark, "stream-ckpt")
    with monkeypatch.context() as m:
        def kill(*a, **k):
            raise Killed
        m.setattr(pipeline, "build", kill)
        with pytest.raises(Exception):
            landing.start(wh, os.path.join(tmpdir_path, "in"), checkpoint, refresh_seeds=True).awaitTermination(300)
    assert wh.read_table("raw/matches").count() == 1 and wh.model_or_none("int_matches") is None
    landing.start(wh, os.path.join(tmpdir_path, "in"), checkpoint, refresh_seeds=True).awaitTermination(300)
    assert rows(wh.model("fct_batting_scorecard")) == rows(from_raw(wh, "fct_batting_scorecard"))
    assert wh.model("fct_batting_scorecard").count() > 0
