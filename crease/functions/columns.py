"""Column-level building blocks. All are built-in Spark expressions (JVM side,
inside whole-stage codegen); nothing here is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's for identical keys and results) ---------
# null placeholder used by the surrogate-key macro, and its separator
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_KEY_SEP = "-"
# dismissal kinds credited to the bowler
BOWLER_WICKETS = ("lbw", "bowled", "caught", "caught and bowled", "stumped", "hit wicket")
# ----------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def surrogate_key(*cols) -> Column:
    """md5 over the '-'-joined text of the columns, NULL replaced by a fixed marker."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_KEY_SEP, *parts))


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) — bigint, 0 for an empty match set."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def int_div(a, b) -> Column:
    """Integer quotient in 64-bit arithmetic, never through a double."""
    return F.call_function("div", a, b)


def overs_display(balls) -> Column:
    """Legal balls as overs text: 17 -> '2.5' (integer div / mod, not a decimal)."""
    b = _c(balls).cast("bigint")
    return F.concat(int_div(b, F.lit(6)).cast("string"), F.lit("."),
                    (b % 6).cast("string"))


def half_up_rate(num, den, factor: int = 1, scale: int = 2) -> Column:
    """round(factor * num / den, scale) with HALF_UP, exact for non-negative integers,
    NULL when den is NULL or 0; returned as DOUBLE.

    Computed in integer arithmetic: q = floor((2*factor*10^scale*num + den) / (2*den)),
    and q / 10^scale as a decimal, so there is one rounding to double, at the end.
    """
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    mult = 10 ** scale
    a = n * F.lit(2 * factor * mult) + d
    b = d * F.lit(2)
    exact = int_div(a, b).cast("decimal(20,0)") / F.lit(mult).cast("decimal(10,0)")
    return F.when(d > 0, exact.cast(f"decimal(30,{scale})").cast("double"))


def half_up_decimal(num, den, factor: int = 1, scale: int = 2, precision: int = 20) -> Column:
    """Same value as ``half_up_rate`` but as DECIMAL(precision, scale), for model tables."""
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    mult = 10 ** scale
    a = n * F.lit(2 * factor * mult) + d
    b = d * F.lit(2)
    return F.when(d > 0, (int_div(a, b).cast(f"decimal({precision},0)") / F.lit(mult))
                  .cast(f"decimal({precision},{scale})"))


def ordered_concat(value, sep: str, order) -> Column:
    """STRING_AGG(value, sep ORDER BY order): NULL values skipped, NULL for no values.

    Collects (order, value) pairs of one group; use it on pre-aggregated rows whose
    group size is bounded (innings of a team, teams of a match)."""
    pairs = F.collect_list(F.struct(_c(order).alias("k"), _c(value).alias("v")))
    ordered = F.transform(F.array_sort(pairs), lambda s: s["v"])
    joined = F.array_join(ordered, sep)
    return F.when(F.size(F.filter(ordered, lambda v: v.isNotNull())) > 0, joined)


def legal_ball(extras_map) -> Column:
    """Legal when neither 'wides' nor 'noballs' is a key of the extras object."""
    m = _c(extras_map)
    has = lambda k: F.coalesce(F.map_contains_key(m, F.lit(k)), F.lit(False))
    return ~has("wides") & ~has("noballs")


def first_of(arr, field: str) -> Column:
    """arr[0].field, NULL when the array is NULL or empty (never raises under ANSI)."""
    return F.get(_c(arr), 0)[field]


def outcome_type(winner, result) -> Column:
    return F.when(_c(winner).isNotNull(), F.lit("winner")).when(
        _c(result).isNotNull(), _c(result))


def batted_first(toss_winner, toss_decision, team) -> Column:
    """Toss winner = team -> chose to bat; otherwise -> the toss winner chose to field.
    NULL toss gives NULL."""
    return F.when(_c(toss_winner) == _c(team), _c(toss_decision) == F.lit("bat")).otherwise(
        _c(toss_decision) == F.lit("field"))


def opponent(teams, position0) -> Column:
    """Other team of a two-team array, given the 0-based position of this team."""
    return F.get(_c(teams), F.lit(1) - _c(position0))


def result_text(winner, margin_runs, margin_wickets) -> Column:
    """'<winner> won by <n> runs|wickets'; NULL when there is no winner (|| semantics)."""
    w = _c(winner)
    by = F.coalesce(F.concat(_c(margin_runs).cast("string"), F.lit(" runs")),
                    F.concat(_c(margin_wickets).cast("string"), F.lit(" wickets")), F.lit(""))
    return F.concat(w, F.lit(" won by "), by)


def match_id_from_filename(filename) -> Column:
    """'<int>.json' -> int; NULL (not an error) when the stem is not an integer."""
    stem = F.regexp_replace(_c(filename), r"\.json$", "")
    return stem.try_cast("int")


def file_name(path) -> Column:
    return F.regexp_extract(_c(path), r"([^/]+)$", 1)
