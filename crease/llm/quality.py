"""Quality rules at document and host level, in built-in functions only.

Each document gets counts and a verdict of its own. Failures are summed by host, the
failure rate of a host is shrunk towards the corpus by a beta prior whose two parameters
are fitted to the spread of the host rates, and the verdict on a host is joined back to
its documents. So a host with three bad pages out of three is not condemned like one with
three thousand out of three thousand.

Defined results: a null or blank text has no words and fails; a null host is no host, its
documents are judged alone; rows that repeat are judged (and counted for their host) each;
an empty table gives an empty result; other columns are carried through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.common import SEPARATOR_CHARS, WORD, materialise, salted_join, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
HOST_LIMIT = 0.5
#: Prior weight in documents, whatever the spread of the host rates says.
PRIOR_WEIGHT = (1.0, 1e6)
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def document_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the five counts of FEATURES (long).

    Repeated windows are found by sorting the hashes of a text's windows (linear-log in
    the length of that text); only texts in which some window repeats are sorted."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    df = docs.withColumn("_w", words(t)).withColumn("_lines", lines)
    df = df.withColumn("n_words", F.size("_w").cast("long"))
    df = df.withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x))).drop("_w")

    def window(x: Column, i: Column) -> Column:
        return F.xxhash64(x, *[F.get(F.col("_h"), i + k) for k in range(1, WINDOW)])

    starts = F.slice("_h", F.lit(1), F.greatest(F.size("_h") - (WINDOW - 1), F.lit(0)))
    df = df.withColumn("_win", F.transform(starts, window)).drop("_h")
    df = df.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.sort_array(F.transform("_win", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))

    def again(e: Column, j: Column) -> Column:
        same = [F.coalesce(F.get(F.col("_sorted"), k)["h"] == e["h"], F.lit(False))
                for k in (j - 1, j + 1)]
        return same[0] | same[1]

    df = df.withColumn("_at", F.sort_array(F.transform(F.filter("_sorted", again),
                                                       lambda e: e["i"]))).drop("_win", "_sorted")
    covered = F.aggregate(
        F.transform("_at", lambda x, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col("_at"), j + 1), x + WINDOW) - x)),
        F.lit(0), lambda total, x: total + x)
    return (df.withColumn("word_chars",
                          F.length(F.translate(t, SEPARATOR_CHARS, "")).cast("long"))
            .withColumn("n_symbols",
                        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines")))
                        .cast("long"))
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("_lines", "_at"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_verdicts(judged: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per non-null host: ``host``, n_docs, n_failed, fail_rate (shrunk), host_kept.

    The prior: m is the share of failed documents, v the variance of the host rates about
    m (weighted by documents); beta(m*k, (1-m)*k) with k = m(1-m)/v - 1."""
    hosts = (judged.filter(F.col(host).isNotNull()).groupBy(host)
             .agg(F.count(F.lit(1)).alias("n_docs"),
                  F.sum(F.col("base_failed").cast("long")).alias("n_failed")))
    rate = F.col("n_failed") / F.col("n_docs")
    sums = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
                     F.sum(F.col("n_failed") * rate).alias("f2"))
    m = F.col("f") / F.col("n")
    v = F.col("f2") / F.col("n") - m * m
    low, high = PRIOR_WEIGHT
    k = F.when(v > 1e-12, F.greatest(F.lit(low), F.least(F.lit(high), m * (1 - m) / v - 1)))
    prior = sums.select(F.struct(m.alias("m"), F.coalesce(k, F.lit(high)).alias("k"))).scalar()
    fitted = hosts.withColumn("_p", prior)
    shrunk = ((F.col("n_failed") + F.col("_p.m") * F.col("_p.k"))
              / (F.col("n_docs") + F.col("_p.k")))
    return fitted.select(host, "n_docs", "n_failed", shrunk.alias("fail_rate"),
                         (shrunk <= limit).alias("host_kept"))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """One narrow row per document: ``doc_id``, FEATURES, base_failed, host_kept, kept.

    Texts are read once; the narrow features are written to the shared scratch folder,
    from which the host totals and the final verdicts are made."""
    narrow = document_features(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).alias("_host"), F.col(text).alias("_text")),
        "_text").drop("_text")
    judged = materialise(narrow.withColumn("base_failed", base_failed())
                         .withColumn("_row", F.monotonically_increasing_id()), "quality")
    verdicts = host_verdicts(judged, "_host", limit).select("_host", "host_kept")
    return (salted_join(judged, verdicts, ["_host"], F.col("_row"))
            .withColumn("host_kept", F.coalesce("host_kept", F.lit(True)))
            .withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
            .drop("_host", "_row"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source",
              limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    Rows that pass on their own are written once with their host; rows that fail leave
    only their host and the failure."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    judged = document_features(docs.select(
        F.struct(*own).alias("_doc"), F.col(text).alias("_text"), F.col(host).alias("_host")),
        "_text").withColumn("base_failed", base_failed())
    judged = materialise(judged.select(
        F.when(~F.col("base_failed"), F.col("_doc")).alias("_doc"), "_host", "base_failed",
        F.monotonically_increasing_id().alias("_row")), "quality-docs")
    bad = host_verdicts(judged, "_host", limit).filter(~F.col("host_kept")).select("_host")
    kept = salted_join(judged.filter(~F.col("base_failed")), bad, ["_host"], F.col("_row"),
                       how="left_anti")
    return kept.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
