"""Data-quality tests as Spark aggregates; each returns one row
``(test, model, column_name, failures)`` so a whole suite is a union of small rows.

* unique(col)               duplicated non-NULL values (count of values seen twice+)
* not_null(cols)            NULL count per column, all columns in one pass
* relationships(col -> parent.field)   child rows (non-NULL key) with no parent row
* unique_combination(cols)  duplicated key combinations (NULLs group together)
* expression(cond)          rows matching a failure condition (singular SQL tests)
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.functions import count_when

RESULT_COLUMNS = ["test", "model", "column_name", "failures"]


def _row(df: DataFrame, test: str, model: str, column: str, failures) -> DataFrame:
    return df.select(F.lit(test).alias("test"), F.lit(model).alias("model"),
                     F.lit(column).alias("column_name"),
                     F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"))


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    dup = (df.filter(F.col(column).isNotNull()).groupBy(column).count()
           .filter(F.col("count") > 1))
    return _row(dup.agg(F.count(F.lit(1)).alias("n")), "unique", model, column, F.col("n"))


def not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """One scan and one aggregate for all columns, unpivoted to one row per column."""
    counts = df.agg(*[count_when(F.col(c).isNull()).alias(f"_n{i}")
                      for i, c in enumerate(columns)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(columns))
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, failures)").select(
        F.lit("not_null").alias("test"), F.lit(model).alias("model"), "column_name",
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))


def relationships(df: DataFrame, model: str, column: str, parent: DataFrame,
                  parent_model: str, parent_field: str) -> DataFrame:
    keys = parent.select(F.col(parent_field).alias(column)).filter(
        F.col(column).isNotNull()).distinct()
    orphans = df.filter(F.col(column).isNotNull()).select(column).join(keys, column, "left_anti")
    return _row(orphans.agg(F.count(F.lit(1)).alias("n")),
                f"relationships:{parent_model}.{parent_field}", model, column, F.col("n"))


def unique_combination(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    dup = df.groupBy(*columns).count().filter(F.col("count") > 1)
    return _row(dup.agg(F.count(F.lit(1)).alias("n")), "unique_combination", model,
                ",".join(columns), F.col("n"))


def expression(df: DataFrame, model: str, name: str, failing: str) -> DataFrame:
    return _row(df.agg(count_when(F.expr(failing)).alias("n")), name, model, "", F.col("n"))


def by_bucket(df: DataFrame, model: str, suite: "Suite", parent_ids: DataFrame, key: str = "match_id",
              bucket: str = "bucket") -> DataFrame | None:
    """Failures per bucket of the tests of ``model`` that ``Suite.is_local`` names: counts of other
    buckets stay what they are, so these rows can be stored and summed.

    ``df`` has the column ``bucket``, a function of ``key``; ``parent_ids``: the keys of the parent."""
    def shown(counts: DataFrame, test: str, column: str) -> DataFrame:
        return counts.select(F.lit(test).alias("test"), F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                             bucket, F.col("n").cast("bigint").alias("failures"))

    parts = []
    for m, columns in suite.not_null:
        if m == model:
            counts = df.groupBy(bucket).agg(*[count_when(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
            pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(columns))
            rows = counts.selectExpr(bucket, f"stack({len(columns)}, {pairs}) AS (column_name, failures)")
            parts.append(rows.select(F.lit("not_null").alias("test"), F.lit(model).alias("model"), "column_name", bucket,
                                     F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")))
    for test, tests in (("unique", [(m, [c]) for m, c in suite.unique]), ("unique_combination", suite.unique_combination)):
        for m, columns in tests:
            if m == model and key in columns:
                rows = df.filter(F.col(key).isNotNull()) if test == "unique" else df
                dup = rows.groupBy(bucket, *columns).count().filter("count > 1")
                parts.append(shown(dup.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")), test, ",".join(columns)))
    for m, c, p, f in suite.relationships:
        if m == model and c == f == key:
            orphans = df.filter(F.col(key).isNotNull()).select(bucket, key).join(parent_ids, key, "left_anti")
            parts.append(shown(orphans.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")), f"relationships:{p}.{f}", c))
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out


@dataclass
class Suite:
    """Declared tests over named model frames."""

    unique: list[tuple[str, str]] = field(default_factory=list)
    not_null: list[tuple[str, list[str]]] = field(default_factory=list)
    relationships: list[tuple[str, str, str, str]] = field(default_factory=list)
    unique_combination: list[tuple[str, list[str]]] = field(default_factory=list)
    singular: list[tuple[str, str, str]] = field(default_factory=list)

    def is_local(self, kind: str, *test, models: list[str], key: str = "match_id") -> bool:
        """Whether a test of one of ``models`` is decided inside the rows of one match: a count of
        nulls, duplicates of keys with the match id, balls or players of a match that is not there."""
        if test[0] not in models:
            return False
        return (kind == "not_null" or (kind == "unique" and test[1] == key)
                or (kind == "unique_combination" and key in test[1])
                or (kind == "relationships" and test[1] == test[3] == key))

    def split(self, models: list[str]) -> tuple["Suite", "Suite"]:
        """(tests that are local for the match-grain ``models``, the others)."""
        kinds = {"unique": self.unique, "not_null": self.not_null, "relationships": self.relationships,
                 "unique_combination": self.unique_combination}
        local = {k: [t for t in tests if self.is_local(k, *t, models=models)] for k, tests in kinds.items()}
        rest = {k: [t for t in tests if t not in local[k]] for k, tests in kinds.items()}
        return Suite(**local), Suite(**rest, singular=self.singular)

    def tests(self) -> list[tuple[str, str, str]]:
        """(test, model, column_name) of every result row."""
        return ([("unique", m, c) for m, c in self.unique] + [("not_null", m, c) for m, cs in self.not_null for c in cs]
                + [(f"relationships:{p}.{f}", m, c) for m, c, p, f in self.relationships]
                + [("unique_combination", m, ",".join(cs)) for m, cs in self.unique_combination]
                + [(n, m, "") for n, m, _ in self.singular])

    def reads(self, kind: str) -> dict[str, list[str]]:
        """The columns that the tests of a kind read of each model; none listed: any."""
        found: dict[str, set[str]] = {}
        tests = {"unique": [(m, [c]) for m, c in self.unique], "not_null": self.not_null,
                 "relationships": [x for m, c, p, f in self.relationships for x in ((m, [c]), (p, [f]))],
                 "unique_combination": self.unique_combination, "singular": [(m, []) for _, m, _ in self.singular]}
        for model, columns in tests[kind]:
            found.setdefault(model, set()).update(columns)
        return {m: sorted(columns) for m, columns in found.items()}

    def run(self, models: dict[str, DataFrame], kinds: set[str] | None = None) -> DataFrame:
        parts: list[DataFrame] = []
        want = (lambda k: kinds is None or k in kinds)
        if want("unique"):
            parts += [unique(models[m], m, c) for m, c in self.unique]
        if want("not_null"):
            parts += [not_null(models[m], m, cs) for m, cs in self.not_null]
        if want("relationships"):
            parts += [relationships(models[m], m, c, models[p], p, f)
                      for m, c, p, f in self.relationships]
        if want("unique_combination"):
            parts += [unique_combination(models[m], m, cs) for m, cs in self.unique_combination]
        if want("singular"):
            parts += [expression(models[m], m, n, cond) for n, m, cond in self.singular]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


# --- fixed values: the tests the reference declares on its models -------------------------
DECLARED = Suite(
    unique=[("int_venues", "venue_id"), ("int_matches", "match_id"),
            ("int_teams", "team_id"), ("int_match_teams", "match_team_id")],
    not_null=[
        ("int_venues", ["venue_id", "venue_name", "country", "last_update"]),
        ("int_matches", ["start_date", "format", "gender", "outcome_type"]),
        ("int_deliveries", ["innings_number", "over_number", "ball_in_over", "batter",
                            "bowler"]),
        ("int_innings", ["innings_number", "team"]),
        ("int_teams", ["team_id", "team", "format", "last_update"]),
        ("int_players", ["player_id", "player_name"]),
        ("int_match_teams", ["match_team_id", "format", "team", "opponent"]),
        ("int_match_players", ["format", "team", "player_name"]),
        ("fct_batting_scorecard", ["innings_number", "batting_position", "is_super_over",
                                   "team", "player_name", "runs", "balls", "is_dismissed"]),
        ("fct_bowling_scorecard", ["innings_number", "is_super_over", "bowling_position",
                                   "bowler", "balls", "runs", "wickets", "dots", "wides",
                                   "noballs"]),
        ("fct_batting_order", ["innings_number", "player_name", "batting_position"]),
        ("fct_deliveries_sequence", ["innings_number", "ball_in_innings", "batter",
                                     "non_striker", "bowler"]),
        ("fct_dismissed_players", ["innings_number", "player_out"]),
        ("fct_bowling_order", ["innings_number", "bowler", "bowling_position"]),
    ],
    relationships=[
        ("int_matches", "venue_id", "int_venues", "venue_id"),
        ("int_deliveries", "match_id", "int_matches", "match_id"),
        ("int_innings", "match_id", "int_matches", "match_id"),
        ("int_players", "team_id", "int_teams", "team_id"),
        ("int_match_teams", "match_id", "int_matches", "match_id"),
        ("int_match_players", "match_id", "int_matches", "match_id"),
        ("fct_batting_scorecard", "match_id", "int_matches", "match_id"),
        ("fct_bowling_scorecard", "match_id", "int_matches", "match_id"),
        ("fct_batting_order", "match_id", "int_matches", "match_id"),
        ("fct_deliveries_sequence", "match_id", "int_matches", "match_id"),
        ("fct_dismissed_players", "match_id", "int_matches", "match_id"),
        ("fct_bowling_order", "match_id", "int_matches", "match_id"),
        ("fct_match_summary", "match_id", "int_matches", "match_id"),
        ("fct_match_summary", "start_date", "int_matches", "start_date"),
    ],
    unique_combination=[
        ("int_deliveries", ["match_id", "innings_number", "over_number", "ball_in_over"]),
        ("int_innings", ["match_id", "innings_number"]),
        ("int_teams", ["team", "format"]),
        ("int_players", ["team_id", "player_id"]),
        ("int_match_teams", ["match_id", "team"]),
        ("int_match_players", ["match_id", "player_id"]),
        ("fct_batting_scorecard", ["match_id", "innings_number", "batting_position"]),
        ("fct_bowling_scorecard", ["match_id", "innings_number", "bowling_position"]),
        ("fct_batting_order", ["match_id", "innings_number", "batting_position"]),
        ("fct_deliveries_sequence", ["match_id", "innings_number", "ball_in_innings"]),
        ("fct_bowling_order", ["match_id", "innings_number", "bowling_position"]),
    ],
    singular=[("assert_country_not_null", "int_venues", "country IS NULL")],
)
# -------------------------------------------------------------------------------------------
