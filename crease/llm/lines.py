"""Removal of cross-site boilerplate lines.

Each line is hashed; a HyperLogLog sketch of the sites it occurs on is kept per line hash,
built in the map tasks and merged by aggregation, so a line that stands in a third of all
documents costs one sketch per task. Lines whose estimate is clearly above the limit are
boilerplate, lines clearly below are not, and lines near it are counted exactly. The first
occurrence of a boilerplate line (smallest id, then place) stays; the others go.

Defined results: a null text stays null and an empty one empty; blank lines are neither
counted nor removed; surrounding white space is not part of a line; a null site is no
site; a null id sorts before the others; rows equal in id and text are one document here and
keep the same lines; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from crease.llm.common import SEPARATOR_CHARS, materialise, salted_join

MIN_SITES = 10
SKETCH_BITS = 12
#: Estimates this many standard errors (and one site at least) from the limit are counted.
ERRORS = 4


def site_lines(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """One narrow row per line with a word: _id, _text (hash), _pos, _site, _h1, _h2."""
    rows = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_text"),
                       F.col(site).alias("_site"),
                       F.posexplode(F.split(F.col(text), "\n")).alias("_pos", "_line"))
    rows = rows.withColumn("_line", F.btrim("_line", F.lit(SEPARATOR_CHARS))).filter("_line != ''")
    return rows.select("_id", "_text", "_pos", "_site", F.xxhash64("_line").alias("_h1"),
                       F.xxhash64(F.lit(1), "_line").alias("_h2"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """_h1, _h2, _first (struct of _id, _text, _pos) of the lines on ``min_sites`` or more."""
    key = ["_h1", "_h2"]
    sketched = lines.groupBy(*key).agg(
        F.hll_sketch_agg("_site", F.lit(SKETCH_BITS)).alias("_sketch"),
        F.count("_site").alias("_n"), F.min(F.struct("_id", "_text", "_pos")).alias("_first"))
    # a line has no more sites than occurrences
    estimated = materialise(sketched.filter(F.col("_n") >= min_sites).select(
        *key, "_first", F.hll_sketch_estimate("_sketch").alias("_sites")), "line-sketches")
    band = max(1.0, ERRORS * 1.04 / 2 ** (SKETCH_BITS / 2) * min_sites)
    clear = estimated.filter(F.col("_sites") > min_sites + band)
    near = estimated.filter(F.col("_sites").between(min_sites - band, min_sites + band))
    exact = (salted_join(lines.select(*key, "_site", "_id"), near.select(*key), key, F.col("_id"),
                         how="left_semi")
             .filter("_site IS NOT NULL").select(*key, "_site").distinct()
             .groupBy(*key).agg(F.count(F.lit(1)).alias("_exact")).filter(F.col("_exact") >= min_sites))
    return clear.select(*key, "_first").unionByName(
        near.join(exact.select(*key), key, "left_semi").select(*key, "_first"))


@F.pandas_udf(StringType())
def _without(text: pd.Series, gone: pd.Series) -> pd.Series:
    def cut(body, at):
        if body is None or at is None:
            return None
        drop = set(at.tolist())
        return "\n".join(x for i, x in enumerate(body.split("\n")) if i not in drop)
    return pd.Series([cut(*x) for x in zip(text, gone)], dtype=object)


def _cleaned(docs: DataFrame, doc_id: str, text: str, site: str, min_sites: int) -> DataFrame:
    """_doc (the columns of ``docs``, lines removed from ``text``), _n_lines, _n_removed."""
    lines = materialise(site_lines(docs, doc_id, text, site), "lines")
    spread = materialise(boilerplate(lines, min_sites), "boilerplate")
    key = ["_h1", "_h2"]
    hits = salted_join(lines, spread, key, F.struct("_id", "_text", "_pos"), how="inner")
    again = ~F.struct("_id", "_text", "_pos").eqNullSafe(F.col("_first"))
    gone = hits.filter(again).groupBy("_id", "_text").agg(F.collect_set("_pos").alias("_gone"))
    own = [F.col(f"_doc.`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       F.xxhash64(F.col(text)).alias("_hash"))
    gone = gone.select(F.col("_id").alias("_gid"), F.col("_text").alias("_gtext"), "_gone")
    id_col, body = F.col(f"_doc.`{doc_id}`"), F.col(f"_doc.`{text}`")
    joined = rows.join(gone, id_col.eqNullSafe(F.col("_gid"))
                       & (F.col("_hash") == F.col("_gtext")), "left")
    hit = F.col("_gone").isNotNull()
    cleaned = _without(F.when(hit, body), F.col("_gone"))
    n_lines = F.size(F.filter(F.split(F.coalesce(body, F.lit("")), "\n"),
                              lambda x: F.btrim(x, F.lit(SEPARATOR_CHARS)) != ""))
    body = F.when(hit, cleaned).otherwise(body)
    out = [body.alias(c) if c == text else col.alias(c) for c, col in zip(docs.columns, own)]
    return joined.select(F.struct(*out).alias("_doc"), n_lines.cast("long").alias("_n_lines"),
                         F.when(hit, F.size("_gone")).otherwise(0).cast("long").alias("_n_removed"))


def remove_boilerplate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the lines removed from ``text``, and n_lines and n_removed (long), which
    replace columns of these names."""
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return _cleaned(docs, doc_id, text, site, min_sites).select(
        *[F.col(f"_doc.`{c}`").alias(c) for c in own], F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"))


def keep_unboiled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` without their boilerplate lines; documents of which nothing is left go."""
    rows = _cleaned(docs, doc_id, text, site, min_sites)
    return rows.filter("_n_removed = 0 OR _n_removed < _n_lines").select(
        *[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
