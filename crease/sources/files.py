"""Match files: scan, fingerprint, change detection, parse, flatten.

* ``scan_files``      ``binaryFile`` over a landing directory; MD5 of the bytes computed
                      once per file, in the scan task.
* ``new_files``       files whose hash is not in the registry (anti join against the
                      registry as it was at run start); a changed file under a known name
                      either replaces its match (default) or fails the run.
* ``one_per_name``    of the files that share a name, the one with the least path.
* ``parse_documents`` ``from_json`` of the document (typed head, balls as VARIANT), the whole
                      document as VARIANT, match_id from the file name; bad names, unparsable
                      JSON and innings without ``overs`` are routed to a quarantine with a
                      reason instead of being half-loaded.
* ``flatten_deliveries`` three ``posexplode`` levels (innings -> overs -> deliveries);
                      positions are 0-based array indexes. A ball stays what it is: VARIANT
                      with every key, or the typed struct of a typed document.
* ``unknown_keys``    what the documents hold besides the typed columns (schema drift).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease import schemas
from crease.functions import file_name, match_id_from_filename
from crease.operators.incremental import new_only
from crease.operators.sequence import running_sums

REASON_BAD_NAME = "match id not integer"
REASON_BAD_JSON = "malformed json"
REASON_NO_OVERS = "innings without overs"
REASON_NAME_TWICE = "file name twice in a run"
REASON_MATCH_TWICE = "match id twice in a run"


def scan_files(spark: SparkSession, directory: str, glob: str = "*.json") -> DataFrame:
    raw = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
           .load(directory))
    return fingerprint(raw)


def fingerprint(files: DataFrame) -> DataFrame:
    """(path, content) -> (path, filename, file_hash, content)."""
    return files.select("path", file_name("path").alias("filename"),
                        F.md5("content").alias("file_hash"), "content")


def new_files(files: DataFrame, registry: DataFrame, on_changed: str = "replace") -> DataFrame:
    """Files whose content hash is not registered. Two names with identical content in
    one run both load; content already registered under any name is skipped."""
    fresh = new_only(files, registry.select(F.col("file_hash")), "file_hash")
    if on_changed == "error":
        clash = fresh.join(registry.select("filename"), "filename", "left_semi")
        if clash.limit(1).count() > 0:
            raise ValueError("changed content under an already registered file name")
    elif on_changed != "replace":
        raise ValueError(f"on_changed must be 'replace' or 'error', not {on_changed!r}")
    return fresh


def one_per_name(files: DataFrame, order: str = "path") -> DataFrame:
    """Of the files that share a name the one with the least ``order``: a name is unique in the
    registry. The choice does not depend on what is registered, so it stays the same in every
    run that sees the same files. Only names travel; the rest of a row is joined back."""
    least = files.groupBy("filename").agg(F.min(order).alias(order))
    return files.join(least, ["filename", order], "left_semi")


def dealt_to_batches(files: DataFrame, max_bytes: int, max_files: int) -> DataFrame:
    """(filename, length, files) -> (filename, batch): no batch holds more than ``max_bytes`` or
    ``max_files``, but for a name that alone exceeds a bound, which is a batch alone.

    Names are laid end to end in order; a batch is a stretch of equal width. Width and the largest
    name that may begin in its last byte make up the bound, so names above half a bound are dealt
    on their own."""
    large = (F.col("length") > max_bytes // 2) | (F.col("files") > max_files // 2)
    some = files.filter(~large)
    most = some.agg(F.coalesce(F.max("length"), F.lit(0)).alias("b"), F.coalesce(F.max("files"), F.lit(1)).alias("n")).first()
    width, count = max(1, max_bytes - most["b"]), max(1, max_files - most["n"])
    laid = running_sums(some, "filename", ["length", "files"])
    before = [F.floor((F.col("__" + c) - F.col(c)) / F.lit(w)).cast("long") for c, w in (("length", width), ("files", count))]
    small = laid.select("filename", (before[0] + before[1]).alias("batch"))
    first = small.agg(F.coalesce(F.max("batch"), F.lit(-1)).alias("m")).first()["m"] + 1
    alone = running_sums(files.filter(large).withColumn("one", F.lit(1)), "filename", ["one"])
    return small.unionByName(alone.select("filename", (F.col("__one") - 1 + first).alias("batch")))


def registry_append(registry: DataFrame, fresh: DataFrame) -> DataFrame:
    """Registry after a run: one row per file name, the new hash replacing an old one. Of a name
    that stands twice in the run the least hash is registered (``one_per_name`` leaves one)."""
    added = fresh.groupBy("filename").agg(F.min("file_hash").alias("file_hash")).select(
        "filename", "file_hash", F.current_timestamp().alias("ingested_at"))
    kept = registry.join(added.select("filename"), "filename", "left_anti")
    return kept.unionByName(added.select(*registry.columns))


def parse_documents(files: DataFrame, keep: list[str] = ()) -> DataFrame:
    """(filename, file_hash, content) -> (filename, file_hash, match_id, doc, document, reason):
    the typed document with whole balls, and all of it. ``reason`` is NULL for a loadable one."""
    text = F.col("content").cast("string")
    parsed = files.select("filename", "file_hash",
                          match_id_from_filename("filename").alias("match_id"),
                          F.from_json(text, schemas.RAW_DOC).alias("doc"),
                          F.try_parse_json(text).alias("document"), *keep)
    no_overs = F.exists(F.coalesce(F.col("doc.innings"), F.array()),
                        lambda i: i["overs"].isNull())
    reason = (F.when(F.col("match_id").isNull(), F.lit(REASON_BAD_NAME))
              .when(F.col("doc").isNull() | F.col("doc.info").isNull(), F.lit(REASON_BAD_JSON))
              .when(no_overs, F.lit(REASON_NO_OVERS)))
    return parsed.withColumn("reason", reason)


def loadable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select("filename", "file_hash", "reason")


def match_rows(docs: DataFrame) -> DataFrame:
    """Raw matches table: one row per loaded document, typed ``info`` and the whole document."""
    return docs.select("match_id", F.col("file_hash").alias("hash_id"),
                       F.current_timestamp().alias("ingested_at"), F.col("doc.info").alias("info"), "document")


def flatten_deliveries(docs: DataFrame, hash_col: str = "file_hash") -> DataFrame:
    """Documents -> raw deliveries (match_id, hash_id, n_innings, team, n_over,
    n_delivery, super_over, delivery). A generator per row: no grouping, no shuffle."""
    inn = docs.select("match_id", F.col(hash_col).alias("hash_id"),
                      F.posexplode("doc.innings").alias("n_innings", "inn"))
    ovs = inn.select("match_id", "hash_id", "n_innings", F.col("inn.team").alias("team"),
                     F.col("inn.super_over").alias("super_over"),
                     F.posexplode("inn.overs").alias("n_over", "ov"))
    balls = ovs.select("match_id", "hash_id", "n_innings", "team", "n_over", "super_over",
                       F.posexplode("ov.deliveries").alias("n_delivery", "delivery"))
    head = [F.col(f.name).cast(f.dataType) for f in schemas.DELIVERIES_RAW.fields[:-1]]
    return balls.select(*head, "delivery")


def flatten_leading_innings(parsed: DataFrame) -> DataFrame:
    """Strict-parity mode for a document with an innings lacking ``overs``: the innings
    before the first malformed one are kept (the reference loop raised mid-document)."""
    docs = parsed.filter(F.col("reason").isNull() | (F.col("reason") == REASON_NO_OVERS))
    first_bad = F.array_position(
        F.transform(F.coalesce(F.col("doc.innings"), F.array()), lambda i: i["overs"].isNull()),
        F.lit(True))
    keep_n = F.when(first_bad > 0, first_bad - 1).otherwise(F.size("doc.innings"))
    trimmed = docs.withColumn("doc", F.col("doc").withField(
        "innings", F.slice(F.coalesce(F.col("doc.innings"), F.array()), F.lit(1),
                           F.greatest(keep_n, F.lit(0)))))
    return flatten_deliveries(trimmed)


#: Levels of a match document whose keys have columns: path of the objects, typed fields.
LEVELS = {
    "$": schemas.MATCH_DOC, "$.info": schemas.INFO, "$.innings[]": schemas.INNINGS,
    "$.innings[].overs[]": schemas.OVER, "$.innings[].overs[].deliveries[]": schemas.DELIVERY,
    "$.innings[].overs[].deliveries[].wickets[]": schemas.WICKET,
}


def unknown_keys(matches: DataFrame, document: str = "document") -> DataFrame:
    """Schema drift of whole documents: (level, key, n_objects, n_documents, value_type) of the
    keys that the typed columns do not hold. One exploded row per key of an object, pre-aggregated
    in its task; counts add up and types merge over runs."""
    objects = {"$": matches.select("match_id", F.col(document).alias("o"))}
    for level in list(LEVELS)[1:]:
        parent, step = level.rsplit(".", 1)
        value = objects[parent]
        path = "$." + step.removesuffix("[]")
        if step.endswith("[]"):
            inner = F.explode(F.try_variant_get("o", path, "array<variant>"))
        else:
            inner = F.try_variant_get("o", path, "variant")
        objects[level] = value.select("match_id", inner.alias("o"))
    found = None
    for level, schema in LEVELS.items():
        entry = objects[level].select("match_id", F.explode(F.try_variant_get("o", "$", "map<string,variant>"))
                                      .alias("key", "value"))
        part = (entry.filter(~F.col("key").isin(schema.names))
                .groupBy("key", "match_id").agg(F.count(F.lit(1)).alias("n"),
                                                F.schema_of_variant_agg("value").alias("t"))
                .groupBy("key").agg(F.sum("n").alias("n_objects"), F.count(F.lit(1)).alias("n_documents"),
                                    F.sort_array(F.collect_set("t")).alias("ts"))
                .select(F.lit(level).alias("level"), "key", "n_objects", "n_documents",
                        F.array_join("ts", " | ").alias("value_type")))
        found = part if found is None else found.unionByName(part)
    return found
