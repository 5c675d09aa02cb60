"""Scenario inputs for operators that act on files, registries, seeds and JSON.

Each builder derives its input from the driver's tables (``documents`` as file
contents, ``nation``/``region`` as venues and cities, F-D/F-M as match documents) and
runs the library operator over all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease import schemas
from crease.operators.dedupe import distinct_on
from crease.operators.incremental import new_only, not_in_counts, replace_by_match, upsert_by_key
from crease.plans import staging as st
from crease.plans.world import World, store
from crease.sources import adapters as ad
from crease.sources import files as fs
from crease.sources import venues as vn

# --- fixed scenario values ---------------------------------------------------------------
BAD_NAME_EVERY, BAD_NAME_AT = 13, 5      # matches written as 'm<id>.json'
NO_OVERS_EVERY, NO_OVERS_AT = 7, 3       # matches whose second innings lacks 'overs'
STALE_EVERY = 3                           # upsert: target rows of these matches are stale
# ---------------------------------------------------------------------------------------


# --- documents as files -----------------------------------------------------------------

def document_files(w: World) -> DataFrame:
    """Every document as a file (filename '<doc_id>.txt', content = its text)."""
    return w.table("documents").select(
        "doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.md5("text").alias("file_hash"))


def known_registry(w: World) -> DataFrame:
    """Registry state: the even-numbered documents were ingested before."""
    return document_files(w).filter(F.col("doc_id") % 2 == 0).select("filename", "file_hash")


def content_fingerprint(w: World) -> DataFrame:
    return document_files(w).select("doc_id", "file_hash")


def new_files_anti_join(w: World) -> DataFrame:
    fresh = fs.new_files(document_files(w), known_registry(w))
    return fresh.select("doc_id", "file_hash")


def registry_append(w: World) -> DataFrame:
    reg = known_registry(w).withColumn("ingested_at", F.current_timestamp())
    fresh = fs.new_files(document_files(w), reg)
    return fs.registry_append(reg, fresh).select("filename", "file_hash")


def not_in_null_semantics(w: World) -> DataFrame:
    """Registry with one NULL hash: NOT IN keeps nothing, the anti join keeps the new."""
    null_row = w.spark.createDataFrame([(None,)], "file_hash string")
    reg = known_registry(w).select("file_hash").unionByName(null_row)
    return not_in_counts(document_files(w), reg, "file_hash")


def match_id_try_cast(w: World) -> DataFrame:
    """Last path segment of each page URL as a file name -> integer id or NULL."""
    pages = w.table("pages").select("page_id", fs.file_name("url").alias("filename"))
    return pages.select("page_id", "filename",
                        fs.match_id_from_filename("filename").alias("match_id"))


def to_date_parse(w: World) -> DataFrame:
    """Order dates rendered as text (every 10th order garbled) parsed back to dates."""
    o = w.table("orders")
    text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("not-a-date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", F.try_to_date(text, "yyyy-MM-dd").alias("start_date"))


def json_path_extract(w: World) -> DataFrame:
    """Schemaless JSON payload: ``props`` parsed to VARIANT, one path extracted."""
    e = w.table("events")
    return e.select("event_id", F.expr("try_variant_get(try_parse_json(props), '$.k', 'int')")
                    .alias("k"))


# --- venues and seeds --------------------------------------------------------------------

def incoming_venues(w: World) -> DataFrame:
    """A run's documents as (filename, venue, city); the city text varies by match so
    'first file wins' is observable. Every 4th nation comes without a usable city."""
    fm = w.fm
    k = F.col("match_id")
    city = (F.when(F.col("_nk") % 4 == 0, F.lit(None).cast("string"))
            .when(F.col("_nk") % 4 == 1, F.lit(""))
            .otherwise(F.concat(F.col("city"), F.lit(" "), (k % 3).cast("string"))))
    nk = w.table("nation").select(F.col("n_name").alias("venue"), F.col("n_nationkey").alias("_nk"))
    return fm.join(nk, "venue").select(
        F.concat(k.cast("string"), F.lit(".json")).alias("filename"),
        F.col("venue").alias("venue_name"), city.alias("city"))


def existing_src_venues(w: World) -> DataFrame:
    return w.venue_city


def upserted_src_venues(w: World) -> DataFrame:
    inc = incoming_venues(w)
    first = distinct_on(inc, ["venue_name"], ["filename"], columns=["venue_name", "city"])
    return vn.upsert_venues(existing_src_venues(w), first)


def seed_new_venues(w: World) -> DataFrame:
    """venue_city seed after refresh from the full incoming venue list."""
    inc = incoming_venues(w)
    first = distinct_on(inc, ["venue_name"], ["filename"], columns=["venue_name", "city"])
    return vn.refresh_venue_city(first, w.venue_city)


def seed_new_cities(w: World) -> DataFrame:
    return vn.refresh_city_country(seed_new_venues(w), w.city_country)


def seeds_edited_by_hand(w: World) -> DataFrame:
    """The venue seed was handed out with the first nations, then gained the others. The edit gives
    every fifth city a name, takes away every fifth row after it, and names late nations itself."""
    handed = w.venue_city
    nk = w.table("nation").select(F.col("n_name").alias("venue_name"), F.col("n_nationkey").alias("_nk"))
    edited = handed.join(nk, "venue_name").filter("_nk % 5 <> 1").select("venue_name", F.when(
        F.col("_nk") % 5 == 0, F.concat(F.lit("EDITED "), F.col("venue_name"))).otherwise(F.col("city")).alias("city"))
    late = nk.filter("_nk >= 20").select("venue_name", F.lit("BY HAND").alias("city"))
    return vn.merged_edits(seed_new_venues(w), handed, edited.unionByName(late), "venue_name")


def except_distinct(w: World) -> DataFrame:
    inc = incoming_venues(w).select("venue_name", "city")
    return vn.new_venue_names(inc, w.venue_city)


def venue_semi_join(w: World) -> DataFrame:
    inc = incoming_venues(w).select("venue_name", "city", "filename")
    names = vn.new_venue_names(inc, w.venue_city)
    return inc.join(names, "venue_name", "left_semi").select("filename", "venue_name", "city")


# --- match documents ----------------------------------------------------------------------

def documents(w: World) -> DataFrame:
    """Whole match documents from F-D + F-M (match_id, hash_id, doc)."""
    return ad.match_documents(w.spark, w.sf_dir, fd=w.fd_raw, fm=w.fm)


def match_files(w: World, planted: bool = False) -> DataFrame:
    """(path, content) files. With ``planted``: some files get a non-integer name and
    some documents lose the ``overs`` of their second innings."""
    docs = documents(w)
    k = F.col("match_id")
    if planted:
        no_overs = k % NO_OVERS_EVERY == NO_OVERS_AT
        docs = docs.withColumn("doc", F.col("doc").withField("innings", F.transform(
            "doc.innings", lambda inn, i: F.when(no_overs & (i == 1),
                                                 inn.withField("overs", F.lit(None)))
            .otherwise(inn))))
        name = F.when(k % BAD_NAME_EVERY == BAD_NAME_AT,
                      F.concat(F.lit("m"), k.cast("string"))).otherwise(k.cast("string"))
    else:
        name = k.cast("string")
    return docs.select(F.concat(F.lit("landing/"), name, F.lit(".json")).alias("path"),
                       F.encode(F.to_json("doc"), "UTF-8").alias("content"))


def whole_match_files(w: World) -> DataFrame:
    """Files whose documents hold more than the typed columns: officials in ``info``, a review
    of every six, the fielder of every catch."""
    def ball(d):
        review = F.when(d["runs"]["batter"] == 6, F.struct(d["batter"].alias("by"), F.lit("upheld").alias("decision")))
        fielders = lambda x: F.when(x["kind"] == "caught", F.array(F.struct(d["bowler"].alias("name"))))
        return d.withField("review", review).withField(
            "wickets", F.transform(d["wickets"], lambda x: x.withField("fielders", fielders(x))))

    overs = lambda inn: F.transform(inn["overs"], lambda o: o.withField(
        "deliveries", F.transform(o["deliveries"], ball)))
    officials = F.struct(F.array(F.col("doc.info.venue")).alias("umpires"))
    doc = F.struct(F.col("doc.info").withField("officials", officials).alias("info"),
                   F.transform("doc.innings", lambda inn: inn.withField("overs", overs(inn))).alias("innings"))
    return documents(w).select(F.concat(F.lit("landing/"), F.col("match_id").cast("string"), F.lit(".json")).alias("path"),
                               F.encode(F.to_json(doc), "UTF-8").alias("content"))


def raw_whole_balls(w: World) -> DataFrame:
    """Keys outside the typed columns, read back from the stored raw balls."""
    docs = fs.loadable(fs.parse_documents(fs.fingerprint(whole_match_files(w))))
    raw = store(fs.flatten_deliveries(docs), "raw-balls")
    key = lambda path: F.try_variant_get("delivery", path, "string")
    found = raw.select("match_id", F.col("n_innings").alias("innings_number"), F.col("n_over").alias("over_number"),
                       F.col("n_delivery").alias("ball_in_over"), key("$.review.by").alias("review_by"),
                       key("$.review.decision").alias("decision"),
                       key("$.wickets[0].fielders[0].name").alias("fielder"))
    return found.filter("review_by IS NOT NULL OR fielder IS NOT NULL")


def raw_schema_drift(w: World) -> DataFrame:
    docs = fs.loadable(fs.parse_documents(fs.fingerprint(whole_match_files(w))))
    return fs.unknown_keys(store(fs.match_rows(docs).select("match_id", "document"), "raw-documents", documents=True))


def registry_double_names(w: World) -> DataFrame:
    """Every third document lies in two folders under one name, with different contents: the one
    with the least path is registered."""
    files = w.table("documents").select(F.concat(F.lit("a/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
                                        F.col("text").alias("content"), "doc_id")
    other = files.filter("doc_id % 3 = 0").select(F.concat(F.lit("b/"), F.substring("path", 3, 99)).alias("path"),
                                                  F.concat("content", F.lit(" again")).alias("content"), "doc_id")
    seen = fs.one_per_name(fs.fingerprint(files.unionByName(other)).drop("content"))
    reg = known_registry(w).withColumn("ingested_at", F.current_timestamp())
    return fs.registry_append(reg, fs.new_files(seen, reg)).select("filename", "file_hash")


#: Bounds of the batch scenario, in bytes and files.
BATCH_BYTES, BATCH_FILES = 20_000, 9


def files_to_batches(w: World) -> DataFrame:
    """Documents as files, dealt to batches of bounded bytes and files."""
    files = w.table("documents").select(
        F.concat(F.lit("f"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("filename"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("length"), F.lit(1).alias("files"))
    return fs.dealt_to_batches(files, BATCH_BYTES, BATCH_FILES)


def raw_roundtrip_flatten(w: World) -> DataFrame:
    """Documents -> JSON text -> typed parse -> 3-level flatten -> staging projection.
    hash_id is the F-D hash carried alongside (the file hash of generated JSON text is
    not reproducible outside Spark)."""
    docs = documents(w).select("match_id", "hash_id",
                               F.from_json(F.to_json("doc"), schemas.MATCH_DOC).alias("doc"))
    return st.stg_deliveries(fs.flatten_deliveries(docs, hash_col="hash_id"))


def match_doc_load(w: World) -> DataFrame:
    parsed = fs.parse_documents(fs.fingerprint(match_files(w)))
    docs = fs.loadable(parsed)
    return docs.select("match_id", F.col("doc.info.venue").alias("venue"),
                       F.col("doc.info.match_type").alias("format"),
                       F.get(F.col("doc.info.dates"), 0).alias("first_date"),
                       F.when(F.col("doc.innings").isNull(), F.lit(0))
                       .otherwise(F.size("doc.innings")).alias("n_innings"))


def malformed_innings_quarantine(w: World) -> DataFrame:
    """Per file: loaded (with its ball count) or quarantined with the reason."""
    parsed = fs.parse_documents(fs.fingerprint(match_files(w, planted=True)))
    balls = (fs.flatten_deliveries(fs.loadable(parsed))
             .groupBy("hash_id").agg(F.count(F.lit(1)).alias("n_balls")))
    return (parsed.join(balls, parsed.file_hash == balls.hash_id, "left")
            .select("filename", F.coalesce("reason", F.lit("loaded")).alias("status"),
                    F.coalesce("n_balls", F.lit(0)).cast("bigint").alias("n_balls")))


def stg_match_info(w: World) -> DataFrame:
    """Match-info documents as JSON text -> typed parse -> staging."""
    raw = ad.fm_match_info_json(w.spark, w.sf_dir).select(
        "match_id", "hash_id", F.lit("2025-01-01 00:00:00").cast("timestamp").alias("ingested_at"),
        F.from_json("data", schemas.MATCH_DOC)["info"].alias("info"))
    s = st.stg_match_info(raw)
    i = F.col("info")
    return s.select("match_id", "hash_id", i["match_type"].alias("format"),
                    i["venue"].alias("venue"), i["city"].alias("city"),
                    F.get(i["dates"], 0).alias("first_date"),
                    F.get(i["teams"], 0).alias("team_a"), F.get(i["teams"], 1).alias("team_b"),
                    i["toss"]["winner"].alias("toss_winner"))


def first_wicket(w: World) -> DataFrame:
    """Balls whose JSON lists two wickets (a run-out of the non-striker added on even
    line numbers): only the first counts."""
    two = F.col("delivery.wickets").isNotNull() & (F.col("_ln") % 2 == 0)
    raw = (ad.fd_raw(w.spark, w.sf_dir, keep_line=True)
           .select("match_id", "hash_id", F.col("innings_number").alias("n_innings"), "team",
                   F.col("over_number").alias("n_over"), F.col("ball_in_over").alias("n_delivery"),
                   "super_over", "_ln", ad.delivery_struct().alias("delivery")))
    raw = raw.withColumn("delivery", F.when(two, F.col("delivery").withField(
        "wickets", F.array_append(F.col("delivery.wickets"), F.struct(
            F.col("delivery.non_striker").alias("player_out"),
            F.lit("run out").alias("kind"))))).otherwise(F.col("delivery")))
    raw = st.parse_delivery_json(raw.withColumn("delivery", F.to_json("delivery")))
    return (st.stg_deliveries(raw).filter(F.col("player_out").isNotNull())
            .select("match_id", "innings_number", "over_number", "ball_in_over",
                    "player_out", "dismissal_mode"))


def legal_ball_predicate(w: World) -> DataFrame:
    """JSON where bye balls also carry ``"noballs": null``: the key is present, so the
    ball is not legal, while its no-ball count still defaults to 0."""
    raw = ad.fd_deliveries_json(w.spark, w.sf_dir)
    has_byes = (F.col("delivery").contains('"byes":')
                & ~F.col("delivery").contains('"noballs":'))
    raw = raw.withColumn("delivery", F.when(
        has_byes, F.regexp_replace("delivery", '"extras":\\{', '"extras":{"noballs":null,'))
        .otherwise(F.col("delivery")))
    s = st.stg_deliveries(st.parse_delivery_json(raw))
    return s.select("match_id", "innings_number", "over_number", "ball_in_over", "is_legal",
                    "wides", "noballs", "byes")


# --- incremental --------------------------------------------------------------------------

def anti_join_new_hash(w: World) -> DataFrame:
    """Rows of the full staging input whose hash the target (even matches) lacks."""
    target = w.deliveries.filter(F.col("match_id") % 2 == 0)
    return new_only(w.deliveries, target, "hash_id").select(
        "match_id", "innings_number", "over_number", "ball_in_over", "hash_id")


def append_new_only(w: World) -> DataFrame:
    target = w.deliveries.filter(F.col("match_id") % 2 == 0)
    return target.unionByName(new_only(w.deliveries, target, "hash_id"))


def upsert_by_key_scenario(w: World) -> DataFrame:
    """Target: even matches, with stale runs in every STALE_EVERY-th match; updates:
    corrected rows of the stale matches plus all odd matches."""
    d = w.deliveries
    stale = F.col("match_id") % STALE_EVERY == 0
    target = d.filter(F.col("match_id") % 2 == 0).withColumn(
        "batter_runs", F.when(stale, F.col("batter_runs") + 1).otherwise(F.col("batter_runs")))
    updates = d.filter(stale | (F.col("match_id") % 2 == 1))
    return upsert_by_key(target, updates,
                         ["match_id", "innings_number", "over_number", "ball_in_over"])


def replace_by_match_scenario(w: World) -> DataFrame:
    """Target has extra stale balls for stale matches (a corrected file with fewer
    balls); whole-match replacement removes them."""
    d = w.deliveries
    stale = F.col("match_id") % STALE_EVERY == 0
    extra = d.filter(stale).withColumn("over_number", F.col("over_number") + 1000)
    target = d.filter(~stale).unionByName(extra)
    return replace_by_match(target, d.filter(stale))
