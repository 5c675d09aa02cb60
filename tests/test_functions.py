"""Column helpers: exact rounding, text formats, NULL handling."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crease.functions import (count_when, first_of, half_up_rate, legal_ball, ordered_concat,
                              overs_display, result_text, surrogate_key)


def test_overs_display(spark):
    rows = spark.createDataFrame([(0,), (5,), (6,), (17,), (120,)], "b int").select(
        overs_display("b").alias("o")).collect()
    assert [r.o for r in rows] == ["0.0", "0.5", "1.0", "2.5", "20.0"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**7), st.integers(0, 10**5)), min_size=1,
                max_size=40))
def test_half_up_rate_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", half_up_rate("n", "d", factor=6).alias("r")).collect()
    for r in got:
        if r.d == 0:
            assert r.r is None
        else:
            want = (Decimal(6 * r.n) / Decimal(r.d)).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert r.r == float(want)


def test_surrogate_key_matches_macro_text(spark):
    import hashlib
    row = spark.createDataFrame([(7, None)], "a int, b string").select(
        surrogate_key("a", "b").alias("k")).first()
    assert row.k == hashlib.md5(b"7-_dbt_utils_surrogate_key_null_").hexdigest()


def test_ordered_concat_skips_nulls_and_orders(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 1, None)],
                               "g int, k int, v string")
    got = dict(df.groupBy("g").agg(ordered_concat(F.col("v"), " & ", F.col("k")).alias("s"))
               .collect())
    assert got == {1: "a & b", 2: None}


def test_legal_ball_uses_key_presence(spark):
    df = spark.createDataFrame(
        [('{"wides": 1}',), ('{"wides": null}',), ('{"byes": 2}',), (None,), ('{}',)],
        "j string").select(F.from_json("j", "map<string,int>").alias("m"))
    assert [r.l for r in df.select(legal_ball("m").alias("l")).collect()] == [
        False, False, True, True, True]


def test_first_of_empty_or_null_array(spark):
    df = spark.createDataFrame([([("x", "bowled"), ("y", "run out")],), ([],), (None,)],
                               "w array<struct<player_out:string,kind:string>>")
    assert [r.p for r in df.select(first_of("w", "player_out").alias("p")).collect()] == [
        "x", None, None]


def test_result_text_null_propagation(spark):
    df = spark.createDataFrame([("A", 5, None), ("B", None, 3), (None, None, None),
                                ("C", None, None)], "w string, r int, k int")
    got = [r.t for r in df.select(result_text("w", "r", "k").alias("t")).collect()]
    assert got == ["A won by 5 runs", "B won by 3 wickets", None, "C won by "]


def test_count_when_zero_not_null(spark):
    df = spark.createDataFrame([(1, False), (1, False)], "g int, c boolean")
    assert df.groupBy("g").agg(count_when(F.col("c")).alias("n")).first().n == 0


def test_integer_quotients_above_2_to_the_53(spark):
    from crease.functions.columns import half_up_rate, overs_display
    df = spark.createDataFrame([(900000000000000011, 400000000000001, 3)], "b long, n long, d long")
    row = df.select(overs_display("b").alias("o"), half_up_rate("n", "d").alias("r")).first()
    assert row["o"] == "150000000000000001.5" and row["r"] == 133333333333333.67
