"""Operators: running count, distinct_on, incremental helpers, quality."""

from pyspark.sql import functions as F

from conftest import SMALL_SF
from crease.operators import quality
from crease.operators.dedupe import distinct_on
from crease.operators.incremental import (not_in_counts, replace_by_match, replace_matches,
                                          upsert_by_key)
from crease.operators.quality import not_null, relationships, unique, unique_combination
from crease.operators.sequence import appearance_order, running_count, running_count_ranges


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def _sorted(rows):
    return sorted(rows, key=repr)


def test_running_count_peers_share_value(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 5), (None, 1), (None, 1)],
                               "p int, o int")
    got = _rows(running_count(df, ["p"], ["o"], "n"), ["p", "o", "n"])
    assert got == _sorted([(1, 1, 2), (1, 1, 2), (1, 2, 3), (2, 5, 1), (None, 1, 2),
                           (None, 1, 2)])


def test_running_count_large_group_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(1_200_000).select(F.lit(None).cast("int").alias("p"), F.col("id").alias("o"))
        wrong = running_count(df, ["p"], ["o"], "n").filter(F.col("n") != F.col("o") + 1)
        assert wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_running_count_ranges_of_hot_and_null_keys(spark):
    """One key of 300,000 rows: no range holds more than a share of them, values as the window's."""
    df = spark.range(400_000).select(F.when(F.col("id") % 4 > 0, F.lit(None).cast("int")).otherwise(
        (F.col("id") % 3).cast("int")).alias("p"), (F.col("id") * 7919 % 100_003).alias("o"), F.lit("x").alias("__own"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranges this small would be merged
    try:
        got = running_count_ranges(df, ["p"], ["o"], "n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.columns == ["p", "o", "__own", "n"]
    plain = running_count(df, ["p"], ["o"], "n")
    total = F.sum(F.xxhash64("p", "o", "n").cast("decimal(38,0)"))
    assert got.agg(total, F.max("n")).first() == plain.agg(total, F.max("n")).first()
    read = [f for f in got.inputFiles()]
    sizes = [spark.read.parquet(f).count() for f in read]
    assert len(sizes) > 4 and max(sizes) < 150_000
    empty = running_count_ranges(df.limit(0), ["p"], ["o"], "n")
    assert empty.count() == 0


def test_not_in_null_keys(spark):
    def counts(keys, known):
        def frame(values):
            return spark.createDataFrame([(v,) for v in values], "k string")
        return tuple(not_in_counts(frame(keys), frame(known), "k").first())
    assert counts([None, "a"], ["b"]) == (2, 1)
    assert counts([None, "a"], ["b", None]) == (2, 0)
    assert counts([None, "a", "b"], []) == (3, 3)


def test_replace_matches_empties_a_bucket(spark, tmpdir_path):
    path = tmpdir_path + "/table"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c")], "match_id int, v string")
    replace_matches(spark, path, old, old.select("match_id"), width=4)
    none = spark.createDataFrame([], old.schema)
    replace_matches(spark, path, none, spark.createDataFrame([(9,)], "match_id int"), width=4)
    rows = spark.read.parquet(path).select("match_id", "v").collect()
    assert sorted(map(tuple, rows)) == [(1, "a"), (2, "b")]


def test_appearance_order_striker_before_non_striker(spark):
    seq = spark.createDataFrame(
        [(1, 1, 1, "a", "b"), (1, 1, 2, "b", "a"), (1, 1, 3, "c", "a"), (1, 1, 4, "a", "c")],
        "m int, i int, s long, bat string, ns string")
    got = _rows(appearance_order(seq, ["m", "i"], "s", [("bat", 1), ("ns", 2)], "player",
                                 "pos"), ["player", "pos"])
    assert got == [("a", 1), ("b", 2), ("c", 3)]


def test_distinct_on_deterministic_survivor_and_null_group(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 5, "y"), (None, 1, "p"), (None, 2, "q")],
                               "k int, o int, v string")
    first = _rows(distinct_on(df, ["k"], ["o"]), ["k", "o", "v"])
    last = _rows(distinct_on(df, ["k"], ["o"], descending=True), ["k", "o", "v"])
    assert first == _sorted([(1, 3, "x"), (None, 1, "p")])
    assert last == _sorted([(1, 5, "y"), (None, 2, "q")])


def test_not_in_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "h string")
    reg = spark.createDataFrame([("a",)], "h string")
    reg_null = reg.unionByName(spark.createDataFrame([(None,)], "h string"))
    assert tuple(not_in_counts(df, reg, "h").first()) == (2, 2)
    assert tuple(not_in_counts(df, reg_null, "h").first()) == (2, 0)


def test_not_in_counts_broadcasts_no_keys(spark):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        df = spark.range(100).selectExpr("CAST(id AS string) AS h")
        out = not_in_counts(df, df.filter("h < '5'"), "h")
        plan = out._jdf.queryExecution().toString()
        assert "HashedRelationBroadcastMode" not in plan and "LeftAnti" in plan
        assert tuple(out.first()) == (df.filter("h >= '5'").count(),) * 2
    finally:
        spark.conf.set(limit, before)


def test_upsert_by_key_null_safe(spark):
    t = spark.createDataFrame([(1, None, "old"), (2, "x", "keep")], "a int, b string, v string")
    u = spark.createDataFrame([(1, None, "new")], "a int, b string, v string")
    assert _rows(upsert_by_key(t, u, ["a", "b"]), ["a", "v"]) == [(1, "new"), (2, "keep")]


def test_replace_by_match_drops_stale_rows(spark):
    t = spark.createDataFrame([(1, 0), (1, 1), (1, 2), (2, 0)], "match_id int, ball int")
    u = spark.createDataFrame([(1, 0)], "match_id int, ball int")
    assert _rows(replace_by_match(t, u), ["match_id", "ball"]) == [(1, 0), (2, 0)]


def test_quality_operators(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (3, None)],
                               "k int, v string")
    parent = spark.createDataFrame([(1,)], "k int")
    assert unique(df, "m", "k").first().failures == 1
    assert {r.column_name: r.failures for r in not_null(df, "m", ["k", "v"]).collect()} == {
        "k": 2, "v": 1}
    assert relationships(df, "m", "k", parent, "p", "k").first().failures == 1
    assert unique_combination(df, "m", ["k"]).first().failures == 2


def test_quality_columns_read(spark):
    suite = quality.Suite(unique=[("a", "x")], relationships=[("a", "k", "b", "i"), ("a", "x", "b", "j")],
                          unique_combination=[("a", ["x", "y"]), ("b", ["i"])], not_null=[("b", ["j", "i"])],
                          singular=[("odd", "b", "i > 3")])
    assert suite.reads("unique") == {"a": ["x"]} and suite.reads("not_null") == {"b": ["i", "j"]}
    assert suite.reads("relationships") == {"a": ["k", "x"], "b": ["i", "j"]}
    assert suite.reads("unique_combination") == {"a": ["x", "y"], "b": ["i"]}
    assert suite.reads("singular") == {"b": []}
    rows = {"a": spark.createDataFrame([(1, 1, 7, "w"), (1, 1, 8, "v"), (None, 2, 9, "u")], "x int, y int, k int, wide string"),
            "b": spark.createDataFrame([(7, 1, "t"), (7, None, "s")], "i int, j int, wide string")}
    for kind in ("unique", "not_null", "relationships", "unique_combination", "singular"):
        narrow = {m: rows[m].select(*c) if c else rows[m] for m, c in suite.reads(kind).items()}
        assert sorted(suite.run(narrow, {kind}).collect()) == sorted(suite.run(rows, {kind}).collect())


def test_quality_stores_only_the_columns_read(spark, monkeypatch):
    from crease import catalog
    kept, plain = {}, catalog.store
    monkeypatch.setattr(catalog, "store", lambda df, name: kept.setdefault(name, plain(df, name)))
    catalog.QUERIES["dq_unique_combination"](spark, SMALL_SF)
    assert kept["int_deliveries"].columns == ["ball_in_over", "innings_number", "match_id", "over_number"]
    assert kept["fct_bowling_scorecard"].columns == ["bowling_position", "innings_number", "match_id"]
