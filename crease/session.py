"""SparkSession defaults and the shared scratch location.

Everything that has to outlive a task (checkpoints, incremental warehouse tables
written by tests or the two-batch queries) goes under the directory the cluster names
in ``spark.checkpoint.dir``. Only when that is unset (local tests) do we pick one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # parquet: large scans split by bytes, not by file count
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # dynamic overwrite lets an upsert replace only the buckets it touched
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoint files are removed once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "crease",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting one only for local sessions."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
    path = tempfile.mkdtemp(prefix="crease-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/crease-{name}-{uuid.uuid4().hex[:12]}"


#: Independent writes that run at the same time.
PARALLEL = 6


def together(jobs: list[Callable]) -> list:
    """Run independent writes at the same time; all end before an error of one is raised."""
    with ThreadPoolExecutor(PARALLEL) as pool:
        running = [pool.submit(job) for job in jobs]
    return [r.result() for r in running]


#: Rows of a row group of stored match documents. Spark reads up to 4096 rows of a group at once,
#: and a document holds a whole match.
DOCUMENT_ROWS = 32
#: A VARIANT is written as it is. To lay it out in typed columns Spark keeps the first rows of each
#: file and looks through every value of theirs, which took more than the parsing of the documents.
WHOLE_VARIANTS = {"spark.sql.variant.inferShreddingSchema": "false"}


def document_writer(rows: DataFrame) -> DataFrameWriter:
    """A writer of rows that hold whole documents: readers take DOCUMENT_ROWS of them at a time."""
    return rows.write.options(**WHOLE_VARIANTS).option("parquet.block.row.count.limit", DOCUMENT_ROWS)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


#: Tables read, by the session itself: a later one can't meet the entries of one that ended.
_READS: WeakKeyDictionary = WeakKeyDictionary()


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """Parquet table as a DataFrame, memoised per session and path: the schema footer is
    read once, and equal sub-plans over the same relation can share one exchange."""
    path = table_path(sf_dir, name)
    reads = _READS.setdefault(spark, {})
    if path not in reads:
        reads[path] = spark.read.parquet(path)
    return reads[path]
