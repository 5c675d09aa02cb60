"""Plan shape: the scale properties the design relies on, checked on physical plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMALL_SF
from crease.plans import layout, reports
from crease.plans import marts as mt
from crease.plans.world import World


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hash_exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", _plan(df)))


@pytest.mark.parametrize("key", ["fct_deliveries_sequence", "fct_batting_order",
                                 "fct_bowling_order"])
def test_window_chain_uses_one_exchange(spark, key):
    # position window, ball sequence and appearance order all partition by
    # (match_id, innings_number) or finer: one shuffle of the balls
    assert _hash_exchanges(entry.queries()[key](spark, SMALL_SF)) == 1


def test_aggregate_prunes_scan_columns(spark):
    df = entry.queries()["int_innings"](spark, SMALL_SF)
    plan = df._jdf.queryExecution().simpleString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    lineitem = [s for s in schemas if "l_partkey" in s]
    assert lineitem and all("l_extendedprice" not in s and "l_shipdate" not in s
                            for s in lineitem)
    assert "Window" not in _plan(df)        # the ball order is not needed for totals


def test_scorecard_join_sees_players_not_balls(spark):
    df = entry.queries()["fct_batting_scorecard"](spark, SMALL_SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the ball-level aggregate sits below the join with the batting order
    join_at = plan.find("Join Inner")
    agg_at = plan.find("Aggregate [match_id", join_at)
    assert join_at >= 0 and agg_at > join_at


def test_report_filter_reaches_parquet_scan(spark, tmpdir_path):
    w = World(spark, SMALL_SF)
    path = f"{tmpdir_path}/int_matches"
    w.matches.drop("outcome_margin").write.parquet(path)
    top = reports.top_batters(w.batting_scorecard, spark.read.parquet(path), "ASIA", 2025)
    scan = [ln for ln in _plan(top).splitlines() if "int_matches" in ln][0]
    assert "PushedFilters" in scan and "EqualTo(event_name,ASIA)" in scan
    assert "ReadSchema: struct<match_id:int,start_date:date,event_name:string>" in scan


def test_report_cuts_balls_before_every_window(spark):
    df = entry.queries()["q_top_bowlers"](spark, SMALL_SF)
    lines = _plan(df).splitlines()
    depth = {name: [len(ln) - len(ln.lstrip(" :+-*(0123456789)")) for ln in lines if name in ln]
             for name in (" Window [", " LeftSemi")}
    assert depth[" Window ["] and max(depth[" Window ["]) < max(depth[" LeftSemi"])


def test_distinct_on_is_an_aggregate_without_window(spark):
    df = entry.queries()["distinct_on"](spark, SMALL_SF)
    plan = _plan(df)
    assert "Window" not in plan and "Aggregate" in plan and "partial_max_by" in plan


def test_scorecards_of_stored_balls_need_no_shuffle(spark, tmpdir_path):
    w = World(spark, SMALL_SF)
    tables = layout.MatchTables(spark, tmpdir_path, 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are large
    try:
        balls = tables.store("int_deliveries", w.deliveries)
        again = layout.attach(spark, "crease_attached", tables.path("int_deliveries"), 4, balls.schema)
        for stored in (balls, again):
            found = layout.scorecards(stored)
            for card, plain in zip(found, (w.batting_scorecard, w.bowling_scorecard)):
                with layout.in_buckets(spark):
                    for rows in (card, card.repartition(4, "match_id")):  # as stored
                        assert "Exchange" not in _plan(rows) and "Join" in _plan(rows)
                assert sorted(map(str, card.collect())) == sorted(map(str, plain.collect()))
        # two stored models meet without a shuffle as well
        order = tables.store("fct_batting_order", w.batting_order)
        card = tables.store("fct_batting_scorecard", found[0])
        keys = ["match_id", "innings_number", "player_name"]
        both = card.join(order, keys)
        with layout.in_buckets(spark):
            assert "Exchange" not in _plan(both) and both.count() == card.count()
        files = [p for p in spark.read.parquet(tables.path("int_deliveries")).inputFiles()]
        assert len(files) <= 4  # a file a bucket
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS crease_attached")
        tables.drop()


def test_bucketed_tables_of_odd_rows(spark, tmpdir_path):
    tables = layout.MatchTables(spark, tmpdir_path, 3)
    odd = spark.createDataFrame([(None, 1), (None, 2), (5, 3), (5, 3)], "match_id int, v int")
    assert sorted(tables.store("odd", odd).collect(), key=str) == sorted(odd.collect(), key=str)
    assert tables.store("none", odd.limit(0)).count() == 0
    assert tables.store("odd", odd.filter("v = 3")).count() == 2  # replaced
    with pytest.raises(ValueError):
        tables.store("keyless", odd.select("v"))
    with pytest.raises(ValueError):
        layout.MatchTables(spark, tmpdir_path, 0)
    tables.drop()
    assert not spark.catalog.listTables(pattern="crease_*")


def test_buckets_grow_with_the_balls(spark, monkeypatch):
    assert [layout.buckets_for(n) for n in (0, 600_000, 36_000_000, 216_000_000)] == [8, 8, 72, 432]
    monkeypatch.setattr(layout, "BUCKET_ROWS", 300)
    made = []
    monkeypatch.setattr(layout.MatchTables, "path", lambda self, name: made.append(self) or f"{self.root}/{name}")
    before = spark.catalog.listTables(pattern="crease_*")
    w = World(spark, SMALL_SF)
    for query, plain in (("batting_scorecard_from_buckets", w.batting_scorecard),
                         ("bowling_scorecard_from_buckets", w.bowling_scorecard)):
        made.clear()
        found = entry.queries()[query](spark, SMALL_SF)
        assert made[0].buckets == 20  # 6,000 balls
        as_text = [F.col(c).cast("double").alias(c) if c == "economy" else c for c in plain.columns]
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.select(*as_text).collect()))
        assert spark.catalog.listTables(pattern="crease_*") == before  # names are not left behind


def test_scorecards_of_small_files_broadcast_no_order(spark, tmpdir_path):
    # an order takes a byte a row in its file: the planner would send it to the driver at any size
    w = World(spark, SMALL_SF)
    for name, rows in (("balls", w.deliveries), ("batting", w.batting_order), ("bowling", w.bowling_order),
                       ("out", w.dismissed), ("matches", w.matches), ("innings", w.innings)):
        rows.write.parquet(f"{tmpdir_path}/{name}")
    balls, batting, bowling, out, matches, innings = (
        spark.read.parquet(f"{tmpdir_path}/{n}") for n in ("balls", "batting", "bowling", "out", "matches", "innings"))
    for found, plain in ((mt.fct_batting_scorecard(balls, batting, out), w.batting_scorecard),
                         (mt.fct_bowling_scorecard(balls, bowling), w.bowling_scorecard),
                         (mt.fct_match_summary(matches, innings), w.match_summary)):
        assert "Join" in _plan(found) and "Broadcast" not in _plan(found)
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
