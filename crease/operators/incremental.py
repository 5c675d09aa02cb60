"""Incremental materialisation on Parquet.

* ``new_only``      rows whose change key (file hash) is not in the target — a left anti
                    join (hashes are non-NULL, so it equals NOT IN without the null-aware,
                    broadcast-only plan).
* ``not_in_counts`` contrasts NOT IN's null-aware semantics with the anti join.
* ``upsert_by_key`` delete+insert by key as ``anti join + union`` (NULL-safe keys).
* ``replace_matches`` rewrites only the buckets that hold changed matches (dynamic
                    partition overwrite), replacing whole matches so a corrected file with
                    fewer balls leaves no stale rows.

Buckets are match-id *ranges* (``match_id div width``): match ids grow with time, so a
run of new matches touches the newest buckets only, and a corrected old match rewrites
just its own bucket. Writes use the REBALANCE hint on the bucket column: AQE coalesces
small buckets into few files and splits a skewed (hot) bucket across several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_WIDTH_DEFAULT = 4096   # matches per bucket; raise it for very large tables
BUCKET_COL = "bucket"


def new_only(df: DataFrame, target: DataFrame, key: str = "hash_id") -> DataFrame:
    known = target.select(key).filter(F.col(key).isNotNull()).distinct()
    return df.join(known, key, "left_anti")


def not_in(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is NOT IN ``target``: one NULL in the target keeps nothing,
    a NULL key is kept only against an empty target.

    Spark plans NOT IN itself as a null-aware join that always broadcasts the target. Here the
    target's rows and keys are counted (one row), and the rest is a plain left anti join."""
    state = target.agg(F.count(F.lit(1)).alias("__rows"), F.count(key).alias("__keys"))
    strict = (F.col("__rows") == 0) | ((F.col("__rows") == F.col("__keys")) & F.col(key).isNotNull())
    return new_only(df, target, key).crossJoin(F.broadcast(state)).filter(strict).drop("__rows", "__keys")


def not_in_counts(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """One row: rows of ``df`` kept by an anti join and by ``key NOT IN (target)``.

    NOT IN is NULL-aware, see ``not_in``."""
    kept = new_only(df, target, key).agg(F.count(F.lit(1)).alias("n_left_anti"))
    strict = not_in(df, target, key).agg(F.count(F.lit(1)).alias("n_not_in"))
    return kept.select("n_left_anti", strict.scalar().alias("n_not_in"))


def upsert_by_key(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``updates`` replace target rows with the same key (NULL keys match NULL)."""
    cond = [target[k].eqNullSafe(updates[k]) for k in keys]
    kept = target.join(updates.select(*keys), cond, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def replace_by_match(target: DataFrame, updates: DataFrame, key: str = "match_id") -> DataFrame:
    """Whole-match replacement: every target row of a match present in ``updates`` is
    dropped, then ``updates`` appended."""
    touched = updates.select(key).distinct()
    return target.join(touched, key, "left_anti").unionByName(
        updates.select(*target.columns))


def with_bucket(df: DataFrame, width: int = BUCKET_WIDTH_DEFAULT,
                key: str = "match_id") -> DataFrame:
    return df.withColumn(BUCKET_COL, F.floor(F.col(key) / F.lit(width)).cast("int"))


def touched_buckets(changed: DataFrame, width: int = BUCKET_WIDTH_DEFAULT,
                    key: str = "match_id") -> list[int]:
    """Bucket numbers holding the changed keys: a small list (bounded by the number of
    buckets, not by data) used as a static partition filter, so a read of a bucketed
    table lists and scans only those partition directories."""
    rows = with_bucket(changed.select(key), width, key).select(BUCKET_COL).distinct().collect()
    return sorted(r[0] for r in rows if r[0] is not None)


def in_buckets(table: DataFrame, buckets: list[int]) -> DataFrame:
    return table.filter(F.col(BUCKET_COL).isin(buckets))


def table_exists(spark: SparkSession, path: str) -> bool:
    """A table directory exists. (Dynamic partition overwrite commits partitions by
    rename and leaves no _SUCCESS marker at the table root, so the marker is not used.)"""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath) and len(fs.listStatus(jpath)) > 0


def write_table(df: DataFrame, path: str, partition_by: str | None = None,
                mode: str = "overwrite") -> None:
    if partition_by:
        df = df.hint("rebalance", partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def _bucket_files(spark: SparkSession, path: str, buckets: list[int]) -> dict[int, list[str]]:
    """File names of those partition directories that exist."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for b in buckets:
        part = jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET_COL}={b}")
        if fs.exists(part):
            found[b] = sorted(str(f.getPath().getName()) for f in fs.listStatus(part))
    return found


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete table or partition directories, where they exist."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        table = jvm.org.apache.hadoop.fs.Path(path)
        table.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(table, True)


def replace_matches(spark: SparkSession, path: str, rebuilt: DataFrame,
                    changed: DataFrame, width: int = BUCKET_WIDTH_DEFAULT,
                    key: str = "match_id") -> None:
    """Replace the rows of ``changed`` matches in the bucketed table at ``path``.

    Only buckets containing a changed match are rewritten (dynamic partition
    overwrite); each rewritten bucket = its old rows minus changed matches + rebuilt
    rows. Dynamic overwrite writes new files to a job staging directory and swaps the
    touched partitions in only at job commit, after every task has finished reading the
    old files, so reading and replacing the same partitions in one job is safe (a
    static overwrite of a path being read is not, and is never used). A touched bucket that
    ends without rows is not written, so its files are still the old ones: it is deleted."""
    rebuilt_b = with_bucket(rebuilt, width, key)
    if not table_exists(spark, path):
        write_table(rebuilt_b, path, BUCKET_COL)
        return
    old = spark.read.parquet(path)
    touched = touched_buckets(changed, width, key)
    before = _bucket_files(spark, path, touched)
    keep = (in_buckets(old, touched)
            .join(changed.select(key).distinct(), key, "left_anti"))
    merged = keep.unionByName(rebuilt_b.select(*old.columns))
    (merged.hint("rebalance", BUCKET_COL).write.mode("overwrite").partitionBy(BUCKET_COL)
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    after = _bucket_files(spark, path, touched)
    drop_tables(spark, [f"{path}/{BUCKET_COL}={b}" for b in before if after.get(b) == before[b]])
