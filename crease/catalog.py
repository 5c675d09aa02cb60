"""Query catalog: one entry per operator/model key, each ``(spark, sf_dir) -> DataFrame``.

Outputs are the model columns minus ``last_update`` (a run timestamp), with struct and
decimal columns flattened to scalars so they compare exactly against the oracle SQL in
``crease.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crease import schemas
from crease.functions import count_when, opponent, overs_display, surrogate_key
from crease.operators.dedupe import distinct_on
from crease.operators.sequence import role_first_steps, running_count, running_count_ranges
from crease.operators import quality
from crease.plans import layout, pipeline, reports
from crease.plans import scenarios as sc
from crease.plans import staging as st
from crease.plans.world import PLANT_KEYS, REPORT_EVENT, REPORT_YEAR, World, store
from crease.session import document_writer, scratch_path, together
from crease.sources import adapters as ad
from crease.streaming import landing as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Callable[[World], DataFrame]) -> Callable[[World], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(World(spark, sf_dir))
        return fn
    return register


# --- models -----------------------------------------------------------------------------

@query("stg_deliveries")
def _stg_deliveries(w: World) -> DataFrame:
    """F-D balls stored as JSON text (as a loader writes them), parsed and projected."""
    raw = st.parse_delivery_json(ad.fd_deliveries_json(w.spark, w.sf_dir))
    return st.stg_deliveries(raw)


@query("int_deliveries")
def _int_deliveries(w: World) -> DataFrame:
    return w.deliveries


@query("fct_deliveries_sequence")
def _sequence(w: World) -> DataFrame:
    return w.sequence


@query("fct_batting_order")
def _batting_order(w: World) -> DataFrame:
    return w.batting_order


@query("fct_bowling_order")
def _bowling_order(w: World) -> DataFrame:
    return w.bowling_order


@query("fct_dismissed_players")
def _dismissed(w: World) -> DataFrame:
    return w.dismissed


@query("fct_batting_scorecard")
def _batting_scorecard(w: World) -> DataFrame:
    return w.batting_scorecard


@query("fct_bowling_scorecard")
def _bowling_scorecard(w: World) -> DataFrame:
    return w.bowling_scorecard.withColumn("economy", F.col("economy").cast("double"))


@query("int_innings")
def _innings(w: World) -> DataFrame:
    return w.innings


@query("fct_match_summary")
def _match_summary(w: World) -> DataFrame:
    return w.match_summary


@query("int_venues")
def _venues(w: World) -> DataFrame:
    return w.venues.drop("last_update")


@query("int_matches")
def _matches(w: World) -> DataFrame:
    return w.matches.select(
        "match_id", "hash_id", "venue_id", "start_date", "format", "gender", "event_name",
        "event_match_number", "event_stage", "toss_winner", "toss_decision", "outcome_type",
        F.col("outcome_margin.runs").alias("margin_runs"),
        F.col("outcome_margin.wickets").alias("margin_wickets"),
        F.col("outcome_margin.innings").alias("margin_innings"), "winner", "player_of_match")


# --- reports ----------------------------------------------------------------------------

def _event_world(w: World) -> World:
    """The balls of the report's matches; the others are left out before any ball window."""
    return w.only(reports.event_matches(w.matches, REPORT_EVENT, REPORT_YEAR))


@query("q_top_batters")
def _top_batters(w: World) -> DataFrame:
    return reports.rank_batters(_event_world(w).batting_scorecard)


@query("q_top_bowlers")
def _top_bowlers(w: World) -> DataFrame:
    return reports.rank_bowlers(_event_world(w).bowling_scorecard)


# --- models: junctions and dimensions ------------------------------------------------------

@query("stg_match_info")
def _stg_match_info(w: World) -> DataFrame:
    return sc.stg_match_info(w)


@query("int_match_teams")
def _match_teams(w: World) -> DataFrame:
    return w.match_teams


@query("int_match_players")
def _match_players(w: World) -> DataFrame:
    return w.match_players


@query("int_teams")
def _teams(w: World) -> DataFrame:
    return w.teams.drop("last_update")


@query("int_players")
def _players(w: World) -> DataFrame:
    return w.players


# --- operators exercised on model data ---------------------------------------------------

@query("outcome_type_case")
def _outcome_type(w: World) -> DataFrame:
    return w.matches.select("match_id", "outcome_type")


@query("count_filter")
def _count_filter(w: World) -> DataFrame:
    return w.deliveries.groupBy("match_id", "innings_number").agg(
        F.count_if(F.col("is_legal")).alias("legal_deliveries"))


@query("conditional_sums")
def _conditional_sums(w: World) -> DataFrame:
    return w.deliveries.groupBy("match_id", "innings_number", "bowler").agg(
        count_when(F.col("is_legal")).alias("balls"),
        count_when(F.col("is_legal") & (F.col("batter_runs") == 0)).alias("dots"),
        count_when(F.col("wides") > 0).alias("wide_balls"),
        count_when(F.col("noballs") > 0).alias("noball_balls"),
        count_when(F.col("wides") == 0).alias("faced"))


@query("first_appearance")
def _first_appearance(w: World) -> DataFrame:
    return w.sequence.groupBy("match_id", "innings_number", "batter").agg(
        F.min("ball_in_innings").alias("first_appearance"))


@query("first_value_window")
def _first_value_window(w: World) -> DataFrame:
    """FIRST_VALUE(first_appearance) OVER (PARTITION BY match, innings, player ORDER BY
    first_appearance) on every role row (before the batting-order filter)."""
    firsts = role_first_steps(w.sequence, ["match_id", "innings_number"], "ball_in_innings",
                              [("batter", 1), ("non_striker", 2)], earliest_only=False)
    per_player = Window.partitionBy("match_id", "innings_number", "_actor").orderBy("_first")
    return firsts.select(
        "match_id", "innings_number", F.col("_actor").alias("player"),
        F.col("_priority").alias("priority"), F.col("_first").alias("first_appearance"),
        F.first("_first").over(per_player).alias("min_first_appearance"))


@query("union_distinct")
def _union_distinct(w: World) -> DataFrame:
    return role_first_steps(w.sequence, ["match_id", "innings_number"], "ball_in_innings",
                            [("batter", 1), ("non_striker", 2)], earliest_only=False).select(
        "match_id", "innings_number", F.col("_actor").alias("player"),
        F.col("_priority").alias("priority"), F.col("_first").alias("first_appearance"))


@query("match_scoreline")
def _scoreline(w: World) -> DataFrame:
    return w.match_summary.select("match_id", "scoreline")


@query("match_result_text")
def _result_text(w: World) -> DataFrame:
    return w.match_summary.select("match_id", "result")


@query("overs_display")
def _overs(w: World) -> DataFrame:
    return w.innings.select("match_id", "innings_number", "legal_deliveries",
                            overs_display("legal_deliveries").alias("overs"))


@query("economy_rate")
def _economy(w: World) -> DataFrame:
    return w.bowling_scorecard.select("match_id", "innings_number", "bowler", "balls", "runs",
                                      F.col("economy").cast("double").alias("economy"))


@query("surrogate_key")
def _surrogate_key(w: World) -> DataFrame:
    return w.match_players.select("match_id", "player_name", "match_player_id",
                                  surrogate_key("player_id", "team").alias("player_team_key"))


@query("distinct_on")
def _distinct_on(w: World) -> DataFrame:
    """Latest event per user (DISTINCT ON user ORDER BY ts DESC, event_id DESC)."""
    e = w.table("events")
    return distinct_on(e, ["user_id"], ["ts", "event_id"], descending=True,
                       columns=["user_id", "event_id", "event_type", "value"])


@query("running_count_ties")
def _running_count_ties(w: World) -> DataFrame:
    """COUNT(*) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber): duplicated line
    numbers are peers and share a value."""
    li = w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return running_count(li, ["l_orderkey"], ["l_linenumber"], "n")


@query("running_count_hot_keys")
def _running_count_hot_keys(w: World) -> DataFrame:
    """COUNT(*) OVER (PARTITION BY flag ORDER BY l_orderkey) with three keys, one of them NULL."""
    li = w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                    F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"))
    return running_count_ranges(li, ["flag"], ["l_orderkey"], "n")


@query("lateral_map_explode")
def _map_explode(w: World) -> DataFrame:
    return w.stg_match_info.select(
        "match_id", F.explode("info.players").alias("team", "names")).select(
        "match_id", "team", F.size("names").alias("n_listed"))


@query("map_dynamic_lookup")
def _map_lookup(w: World) -> DataFrame:
    t = w.stg_match_info.select("match_id", F.col("info.registry.people").alias("people"),
                                F.explode("info.players").alias("team", "names"))
    return t.select("match_id", F.explode("names").alias("player_name"), "people").select(
        "match_id", "player_name",
        F.try_element_at("people", F.col("player_name")).alias("player_id"))


@query("opponent_lookup")
def _opponent(w: World) -> DataFrame:
    t = w.stg_match_info.select("match_id", F.col("info.teams").alias("teams"),
                                F.posexplode("info.teams").alias("pos", "team"))
    return t.select("match_id", "team", opponent("teams", "pos").alias("opponent"))


@query("lateral_with_ordinality")
def _ordinality(w: World) -> DataFrame:
    t = w.stg_match_info.select("match_id", F.posexplode("info.teams").alias("pos", "team"))
    return t.select("match_id", "team", (F.col("pos") + 1).cast("bigint").alias("position"))


# --- sources, files, registry, seeds --------------------------------------------------------

for _name, _fn in [
    ("content_fingerprint", sc.content_fingerprint),
    ("new_files_anti_join", sc.new_files_anti_join),
    ("registry_append", sc.registry_append),
    ("not_in_null_semantics", sc.not_in_null_semantics),
    ("match_id_try_cast", sc.match_id_try_cast),
    ("to_date_parse", sc.to_date_parse),
    ("json_path_extract", sc.json_path_extract),
    ("venue_insert_if_absent", sc.upserted_src_venues),
    ("seed_new_venues", sc.seed_new_venues),
    ("seed_new_cities", sc.seed_new_cities),
    ("seeds_edited_by_hand", sc.seeds_edited_by_hand),
    ("except_distinct", sc.except_distinct),
    ("venue_semi_join", sc.venue_semi_join),
    ("raw_roundtrip_flatten", sc.raw_roundtrip_flatten),
    ("match_doc_load", sc.match_doc_load),
    ("raw_whole_balls", sc.raw_whole_balls),
    ("raw_schema_drift", sc.raw_schema_drift),
    ("registry_double_names", sc.registry_double_names),
    ("files_to_batches", sc.files_to_batches),
    ("malformed_innings_quarantine", sc.malformed_innings_quarantine),
    ("first_wicket", sc.first_wicket),
    ("legal_ball_predicate", sc.legal_ball_predicate),
    ("anti_join_new_hash", sc.anti_join_new_hash),
    ("append_new_only", sc.append_new_only),
    ("upsert_by_key", sc.upsert_by_key_scenario),
    ("replace_by_match", sc.replace_by_match_scenario),
]:
    query(_name)(_fn)


# --- data quality ---------------------------------------------------------------------------

def _models(w: World) -> dict[str, DataFrame]:
    return {
        "int_venues": w.venues, "int_matches": w.matches, "int_deliveries": w.deliveries,
        "int_innings": w.innings, "int_teams": w.teams, "int_players": w.players,
        "int_match_teams": w.match_teams, "int_match_players": w.match_players,
        "fct_batting_scorecard": w.batting_scorecard,
        "fct_bowling_scorecard": w.bowling_scorecard,
        "fct_batting_order": w.batting_order, "fct_deliveries_sequence": w.sequence,
        "fct_dismissed_players": w.dismissed, "fct_bowling_order": w.bowling_order,
        "fct_match_summary": w.match_summary,
    }


def _planted(df: DataFrame, model: str) -> DataFrame:
    """Every model gets violations, so that each declared test has something to find: of five
    parts of its keys, one is nulled, one points nowhere and one stands twice."""
    part = F.expr(PLANT_KEYS.get(model, "match_id")) % 5
    required = {c for m, cols in quality.DECLARED.not_null if m == model for c in cols}
    references = {c for m, c, _, _ in quality.DECLARED.relationships if m == model}

    def stray(c: str):
        kind = df.schema[c].dataType.typeName()
        if kind == "string":
            return F.concat(F.lit("?"), F.col(c))
        return F.add_months(c, 1200) if kind == "date" else -F.col(c)

    columns = []
    for c in df.columns:
        value = F.col(c)
        if c in references:
            value = F.when(part == 2, stray(c)).otherwise(value)
        if c in required:
            value = F.when(part == 1, F.lit(None)).otherwise(value)
        columns.append(value.alias(c))
    return df.select(*columns).unionByName(df.filter(part == 0))


def _tested(w: World, kind: str) -> DataFrame:
    """The models a kind of test reads are built once, from stored tables, and stored: of a model
    with planted rows, the columns that these tests read."""
    suite = quality.DECLARED
    used = suite.reads(kind)
    built = _models(w.stored() if len(used) > 1 else w)
    planted = {m: _planted(built[m], m) for m in sorted(used)}
    narrow = {m: df.select(*used[m]) if used[m] else df for m, df in planted.items()}
    kept = together([lambda m=m, df=df: store(df, m) for m, df in narrow.items()])
    return suite.run(dict(zip(narrow, kept)), {kind})


for _key, _kind in [("dq_unique", "unique"), ("dq_not_null", "not_null"),
                    ("dq_relationships", "relationships"),
                    ("dq_unique_combination", "unique_combination"),
                    ("dq_country_not_null", "singular")]:
    query(_key)(lambda w, _k=_kind: _tested(w, _k))


# --- incremental pipeline (writes a warehouse under spark.checkpoint.dir) -------------------

def _two_batch_warehouse(w: World) -> pipeline.Warehouse:
    """Files for all matches, loaded in two runs (even match ids, then odd), each run
    followed by an incremental build of the changed matches only."""
    wh = _warehouse(w)
    files = store(sc.match_files(w), "match-files", documents=True).withColumn(
        "_id", F.regexp_extract("path", r"(\d+)\.json$", 1).cast("int"))
    for parity in (0, 1):
        batch = files.filter(F.col("_id") % 2 == parity).drop("_id")
        pipeline.run(wh, batch, seeds=False)
    return wh


@query("incremental_two_batches")
def _incremental_two_batches(w: World) -> DataFrame:
    wh = _two_batch_warehouse(w)
    return wh.model("int_innings").drop("hash_id")


@query("mart_incremental_equals_full")
def _mart_incremental(w: World) -> DataFrame:
    wh = _two_batch_warehouse(w)
    return wh.model("fct_batting_scorecard")


def _warehouse(w: World) -> pipeline.Warehouse:
    wh = pipeline.Warehouse(w.spark, scratch_path(w.spark, "warehouse"))
    pipeline.seed_initial(wh, w.venue_city, w.city_country)
    return wh


@query("catch_up_after_interruption")
def _catch_up(w: World) -> DataFrame:
    """Even matches are loaded and only the first models built, as if the run was killed; the next
    run loads the odd ones and brings every model up from where it stood."""
    wh, files = _warehouse(w), store(sc.match_files(w), "match-files", documents=True)
    even = F.regexp_extract("path", r"(\d+)\.json$", 1).cast("int") % 2 == 0
    pipeline.ingest(wh, files.filter(even))
    pipeline.build_steps(wh, pipeline.STEPS[:1])
    pipeline.run(wh, files.filter(~even), seeds=False)
    return wh.model("fct_bowling_scorecard").withColumn("economy", F.col("economy").cast("double"))


@query("corrections_merged_on_read")
def _corrections(w: World) -> DataFrame:
    """All matches are loaded, a third of them with one ball too many in each over; their corrected
    files add a part with new rows, and the older rows of these matches are hidden on reading."""
    wh, files = _warehouse(w), store(sc.match_files(w), "match-files", documents=True)
    third = F.regexp_extract("path", r"(\d+)\.json$", 1).cast("int") % 3 == 0
    doc = F.from_json(F.col("content").cast("string"), schemas.MATCH_DOC)
    longer = lambda o: o.withField("deliveries", F.concat(o["deliveries"], F.slice(o["deliveries"], 1, 1)))
    wrong = doc.withField("innings", F.transform(doc["innings"], lambda i: i.withField(
        "overs", F.transform(i["overs"], longer))))
    stale = files.withColumn("content", F.when(third, F.encode(F.to_json(wrong), "UTF-8")).otherwise(F.col("content")))
    pipeline.run(wh, stale, seeds=False)
    pipeline.run(wh, files.filter(third), seeds=False)
    return wh.model("int_deliveries").drop("hash_id")


@query("stream_two_micro_batches")
def _stream(w: World) -> DataFrame:
    """Match files arrive in two micro-batches of a stream, which stops and goes on between them; each
    is one pipeline run."""
    wh, landing, checkpoint = _warehouse(w), scratch_path(w.spark, "arrivals"), scratch_path(w.spark, "stream")
    files = sc.match_files(w).withColumn("_odd", F.regexp_extract("path", r"(\d+)\.json$", 1).cast("int") % 2)
    files = store(files, "match-files", documents=True)
    for odd in (0, 1):
        document_writer(files.filter(F.col("_odd") == odd).drop("_odd")).mode("append").parquet(landing)
        arrivals = w.spark.readStream.schema("path string, content binary").parquet(landing)
        stream.start_stream(wh, arrivals, checkpoint).awaitTermination()
    return wh.model("int_innings").drop("hash_id")


def _scorecard_from_buckets(w: World, which: int) -> DataFrame:
    """Balls stored in buckets of matches once; order, dismissals and scorecard without a shuffle."""
    # a ball is a line, and Parquet keeps their number
    buckets = layout.buckets_for(w.table("lineitem").count())
    tables = layout.MatchTables(w.spark, scratch_path(w.spark, "buckets"), buckets)
    balls = tables.store("int_deliveries", w.deliveries)
    card = tables.store("scorecard", layout.scorecards(balls)[which])
    tables.drop()  # the session's catalog is left as it was; the files stay
    return w.spark.read.schema(card.schema).parquet(tables.path("scorecard"))


@query("batting_scorecard_from_buckets")
def _batting_from_buckets(w: World) -> DataFrame:
    return _scorecard_from_buckets(w, 0)


@query("bowling_scorecard_from_buckets")
def _bowling_from_buckets(w: World) -> DataFrame:
    return _scorecard_from_buckets(w, 1).withColumn("economy", F.col("economy").cast("double"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
