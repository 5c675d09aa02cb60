"""End to end on hand-written match files: scan -> ingest -> seeds -> incremental build.
Expected values computed by hand from the files in ``match_files.py``."""

import os

import pytest
from pyspark.sql import functions as F

import match_files as mf
from crease.plans import pipeline
from crease.session import scratch_path
from crease.sources import files as fs
from crease.streaming import landing


def _wh(spark):
    wh = pipeline.Warehouse(spark, scratch_path(spark, "test-wh"), bucket_width=8)
    empty_vc = spark.createDataFrame([], "venue_name string, city string")
    empty_cc = spark.createDataFrame([], "city string, country string")
    pipeline.seed_initial(wh, empty_vc, empty_cc)
    return wh


@pytest.fixture(scope="module")
def first_run(spark):
    import tempfile
    landing_dir = tempfile.mkdtemp(prefix="crease-landing-")
    mf.write(landing_dir, "1001.json", mf.match_1001())
    mf.write(landing_dir, "1003.json", mf.match_1001())          # same content, other name
    mf.write(landing_dir, "1002.json", mf.match_no_overs())
    mf.write(landing_dir, "abc.json", mf.match_1001())
    mf.write(landing_dir, "1004.json", mf.match_super_over_tie())
    wh = _wh(spark)
    pipeline.run(wh, fs.scan_files(spark, landing_dir))
    return wh, landing_dir


def _one(df, **eq):
    for k, v in eq.items():
        df = df.filter(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_quarantine_reasons(spark, first_run):
    wh, _ = first_run
    q = {r.filename: r.reason for r in spark.read.parquet(wh.path("raw/quarantine")).collect()}
    assert q == {"1002.json": "innings without overs", "abc.json": "match id not integer"}
    loaded = {r.match_id for r in wh.model("int_matches").collect()}
    assert loaded == {1001, 1003, 1004}


def test_innings_totals(first_run):
    wh, _ = first_run
    inn = wh.model("int_innings")
    a = _one(inn, match_id=1001, innings_number=0)
    assert (a.runs_scored, a.wickets_lost, a.legal_deliveries, a.wides, a.noballs, a.byes,
            a.legbyes, a.extras) == (8, 2, 5, 1, 1, 1, 0, 3)
    b = _one(inn, match_id=1001, innings_number=1)
    assert (b.runs_scored, b.wickets_lost, b.legal_deliveries) == (3, 1, 3)


def test_batting_scorecard(first_run):
    wh, _ = first_run
    bs = wh.model("fct_batting_scorecard").filter("match_id = 1001 AND innings_number = 0")
    got = sorted((r.batting_position, r.player_name, r.runs, r.balls, r.is_dismissed,
                  r.is_super_over, r.team) for r in bs.collect())
    assert got == [(1, "a1", 1, 2, False, False, "A"), (2, "a2", 4, 3, True, False, "A"),
                   (3, "a3", 0, 1, True, False, "A")]
    second = wh.model("fct_batting_scorecard").filter("match_id = 1001 AND innings_number = 1")
    names = {r.player_name: r.batting_position for r in second.collect()}
    # the quoted, non-ASCII non-striker never faced a ball: absent, position kept as a gap
    assert names == {"b1": 1, "b3": 3}


def test_bowling_scorecard(first_run):
    wh, _ = first_run
    r = _one(wh.model("fct_bowling_scorecard"), match_id=1001, innings_number=0)
    assert (r.bowler, r.bowling_position, r.balls, r.runs, r.wickets, r.dots, r.wides,
            r.noballs, float(r.economy)) == ("b1", 1, 5, 7, 1, 3, 1, 1, 8.4)
    r1 = _one(wh.model("fct_bowling_scorecard"), match_id=1001, innings_number=1)
    assert r1.wickets == 1   # only the first wicket of a two-wicket ball is kept


def test_match_summary_and_super_over(first_run):
    wh, _ = first_run
    s = {r.match_id: (r.scoreline, r.result) for r in wh.model("fct_match_summary").collect()}
    assert s[1001] == ("A 8/2 (0.5) vs B 3/1 (0.3)", "A won by 5 runs")
    assert s[1004] == ("A 8/2 (0.5) & 6/0 (0.1) vs B 3/1 (0.3) & 4/0 (0.1)", None)
    so = wh.model("fct_batting_scorecard").filter("match_id = 1004 AND innings_number = 2")
    assert [r.is_super_over for r in so.collect()] == [True]


def test_dimensions_and_junctions(first_run):
    wh, _ = first_run
    mt = {(r.match_id, r.team): (r.opponent, r.batted_first, r.won_match)
          for r in wh.model("int_match_teams").collect()}
    assert mt[(1001, "A")] == ("B", True, True)
    assert mt[(1001, "B")] == ("A", False, False)
    assert mt[(1004, "A")] == ("B", None, None)       # no toss, no winner
    mp = wh.model("int_match_players").filter("match_id = 1001")
    ids = {r.player_name: r.player_id for r in mp.collect()}
    assert ids[mf.B2] == "id-b2" and ids["b3"] is None
    venues = {r.venue_name: (r.city, r.country) for r in wh.model("int_venues").collect()}
    assert venues == {"Eden Gardens": ("Kolkata", "UNKNOWN"),
                      "New Ground": ("New Ground-CITY", "UNKNOWN")}
    m = {r.match_id: r.venue_id for r in wh.model("int_matches").collect()}
    assert all(v is not None for v in m.values())
    teams = {(r.team, r.format) for r in wh.model("int_teams").collect()}
    assert teams == {("A", "T20"), ("B", "T20")}


def test_corrected_file_replaces_whole_match(spark, first_run):
    wh, landing_dir = first_run
    mf.write(landing_dir, "1001.json", mf.match_1001(short_second_innings=True))
    pipeline.run(wh, fs.scan_files(spark, landing_dir))
    balls = wh.model("int_deliveries").filter("match_id = 1001 AND innings_number = 1")
    assert balls.count() == 1                           # no stale balls left behind
    inn = _one(wh.model("int_innings"), match_id=1001, innings_number=1)
    assert (inn.runs_scored, inn.wickets_lost) == (2, 0)
    other = _one(wh.model("int_innings"), match_id=1003, innings_number=1)
    assert other.runs_scored == 3                       # untouched match unchanged
    reg = {r.filename: r.file_hash for r in wh.registry().collect()}
    assert len(reg) == 5
    # incremental dimensions equal a full rebuild from the junction tables
    from crease.plans import intermediate as im
    full_teams = im.int_teams(wh.model("int_match_teams"), keep_source=True)
    cols = ["team_id", "hash_id", "team", "format", "source_match_id"]
    assert sorted(map(tuple, wh.model("int_teams").select(cols).collect())) == sorted(
        map(tuple, full_teams.select(cols).collect()))
    full_players = im.int_players(wh.model("int_match_players"), wh.model("int_teams"),
                                  keep_source=True)
    pcols = ["team_id", "player_id", "hash_id", "player_name", "source_match_id"]
    assert sorted(map(repr, wh.model("int_players").select(pcols).collect())) == sorted(
        map(repr, full_players.select(pcols).collect()))


def test_unchanged_rerun_is_a_no_op(spark, first_run):
    wh, landing_dir = first_run
    before = wh.model("fct_batting_scorecard").count()
    changed = pipeline.ingest(wh, fs.scan_files(spark, landing_dir))
    assert changed.count() == 0
    assert wh.model("fct_batting_scorecard").count() == before


def test_landing_stream_available_now(spark, tmpdir_path):
    landing_dir = os.path.join(tmpdir_path, "landing")
    mf.write(landing_dir, "2001.json", mf.match_1001())
    wh = _wh(spark)
    q = landing.start(wh, landing_dir, scratch_path(spark, "stream-ckpt"), refresh_seeds=True)
    q.awaitTermination(300)
    s = {r.match_id: r.result for r in wh.model("fct_match_summary").collect()}
    assert s == {2001: "A won by 5 runs"}


def test_seed_csv_round_trip(spark, tmpdir_path):
    from crease.sources import venues as vn
    vc, cc = os.path.join(tmpdir_path, "venue_city"), os.path.join(tmpdir_path, "city_country")
    vn.init_seeds(spark, vc, cc)
    assert vn.read_venue_city(spark, vc).count() == 0
    src = spark.createDataFrame([("Eden Gardens", "Kolkata"), ("Lord's", None),
                                 ("Oval", "")], "venue_name string, city string")
    vn.write_seed(vn.refresh_venue_city(src, vn.read_venue_city(spark, vc)), vc + "_v2")
    got = {r.venue_name: r.city for r in vn.read_venue_city(spark, vc + "_v2").collect()}
    assert got == {"Eden Gardens": "Kolkata", "Lord's": "Lord's-CITY", "Oval": "Oval-CITY"}
    cities = vn.refresh_city_country(vn.read_venue_city(spark, vc + "_v2"),
                                     vn.read_city_country(spark, cc))
    assert {r.city: r.country for r in cities.collect()} == {
        "Kolkata": "UNKNOWN", "Lord's-CITY": "UNKNOWN", "Oval-CITY": "UNKNOWN"}
    again = vn.refresh_city_country(vn.read_venue_city(spark, vc + "_v2"), cities)
    assert again.count() == 3      # a second refresh adds nothing


def test_strict_parity_keeps_leading_innings(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "strict")
    mf.write(d, "1002.json", mf.match_no_overs())
    parsed = fs.parse_documents(fs.scan_files(spark, d))
    assert fs.flatten_deliveries(fs.loadable(parsed)).count() == 0    # default: quarantined
    lead = fs.flatten_leading_innings(parsed)
    assert {r.n_innings for r in lead.collect()} == {0}
    assert lead.count() == 7


def test_changed_file_under_known_name_can_fail(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "changed")
    mf.write(d, "1001.json", mf.match_1001())
    files = fs.scan_files(spark, d)
    registry = fs.registry_append(
        spark.createDataFrame([], "filename string, file_hash string, ingested_at timestamp"),
        files)
    registry = spark.createDataFrame(registry.collect(), registry.schema)   # state at run start
    mf.write(d, "1001.json", mf.match_1001(short_second_innings=True))
    changed = fs.scan_files(spark, d)
    assert fs.new_files(changed, registry).count() == 1               # replace (default)
    with pytest.raises(ValueError):
        fs.new_files(changed, registry, on_changed="error")


def test_landing_stream_in_small_micro_batches(spark, tmpdir_path):
    landing_dir = os.path.join(tmpdir_path, "landing")
    mf.write(landing_dir, "3001.json", mf.match_1001())
    mf.write(landing_dir, "3002.json", mf.match_super_over_tie())
    wh = _wh(spark)
    q = landing.start(wh, landing_dir, scratch_path(spark, "stream-ckpt"),
                      max_files_per_trigger=1, refresh_seeds=True)
    q.awaitTermination(600)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2
    s = {r.match_id: r.result for r in wh.model("fct_match_summary").collect()}
    assert s == {3001: "A won by 5 runs", 3002: None}


def test_replay_after_lost_registry_is_idempotent(spark, tmpdir_path):
    """A run that dies after writing data but before the registry re-ingests the same
    files next time; replace-by-match makes that replay leave the tables unchanged."""
    d = os.path.join(tmpdir_path, "replay")
    mf.write(d, "4001.json", mf.match_1001())
    mf.write(d, "4002.json", mf.match_super_over_tie())
    wh = _wh(spark)
    pipeline.run(wh, fs.scan_files(spark, d))
    cols = ["match_id", "innings_number", "batting_position", "player_name", "runs", "balls"]
    before = sorted(map(tuple, wh.model("fct_batting_scorecard").select(cols).collect()))
    balls_before = wh.model("int_deliveries").count()
    pipeline.reset(wh)                                   # registry as if never written
    assert pipeline.ingest(wh, fs.scan_files(spark, d)).count() == 2
    pipeline.build(wh)
    after = sorted(map(tuple, wh.model("fct_batting_scorecard").select(cols).collect()))
    assert after == before
    assert wh.model("int_deliveries").count() == balls_before


def test_reset_forgets_the_former_files(spark, tmpdir_path):
    first, second = (os.path.join(tmpdir_path, x) for x in ("first", "second"))
    mf.write(first, "6001.json", mf.match_1001())
    mf.write(second, "6002.json", mf.match_1001())
    wh = _wh(spark)
    pipeline.ingest(wh, fs.scan_files(spark, first))
    pipeline.reset(wh)
    pipeline.ingest(wh, fs.scan_files(spark, second))
    assert [r[0] for r in wh.read_table("raw/matches").select("match_id").collect()] == [6002]


def test_build_without_known_venues(spark, tmpdir_path):
    """No venue seeded and no seed refresh: the match-teams junction stays empty (its
    venue join drops every match) and the build still completes."""
    d = os.path.join(tmpdir_path, "noseed")
    mf.write(d, "5001.json", mf.match_1001())
    wh = _wh(spark)
    pipeline.run(wh, fs.scan_files(spark, d), seeds=False)
    assert wh.model("fct_batting_scorecard").count() == 5
    assert wh.model("int_teams").count() == 0
    assert [r.venue_id for r in wh.model("int_matches").collect()] == [None]


def test_reads_prune_to_touched_buckets(spark, first_run):
    from crease.operators.incremental import in_buckets, touched_buckets
    wh, _ = first_run
    ids = spark.createDataFrame([(1003,)], "match_id int")
    q = in_buckets(spark.read.parquet(wh.path("raw/deliveries")),
                   touched_buckets(ids, wh.bucket_width))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert f"(bucket#" in plan and f"= {1003 // wh.bucket_width})" in plan
    assert {r.match_id for r in q.select("match_id").distinct().collect()} <= {
        m for m in range(1000, 1008)}
