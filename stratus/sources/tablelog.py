"""Run log of a table of plain files: which upkeep runs there were, and which files make up each version.

Beside the data lie folders that readers of the table pass over (their names
begin with an underscore):

* ``_runs``: one small JSON entry per run, named by its version.  An entry is put
  only if none of that version exists, so concurrent runs get versions of their
  own and a run that is retried under its id adds nothing.
* ``_manifests``: per run, the files known to it as a table written by the tasks:
  the version that added a file and the one that replaced it, if any.
* ``_compacted``: files written by upkeep, one folder per attempt.

Files of the table itself that no manifest names were appended since: they
belong to the present version.  A table under upkeep is append-only.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.session import path_exists

RUNS, MANIFESTS, COMPACTED = "_runs", "_manifests", "_compacted"
ATTEMPT = "_attempt"

METRICS_TYPE = T.StructType([
    T.StructField("table_version", T.IntegerType()),
    T.StructField("num_files", T.IntegerType()),
    T.StructField("size_bytes", T.LongType()),
])
OPTIMIZE_TYPE = T.StructType([
    T.StructField("files_added", T.IntegerType()),
    T.StructField("files_removed", T.IntegerType()),
    T.StructField("duration_seconds", T.DoubleType()),
])
ENTRY_SCHEMA = T.StructType([
    T.StructField("version", T.IntegerType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("completed_at", T.TimestampType()),
    T.StructField("delta_path", T.StringType()),
    T.StructField("before", METRICS_TYPE),
    T.StructField("after", METRICS_TYPE),
    T.StructField("optimize", OPTIMIZE_TYPE),
    T.StructField("bytes_rewritten", T.LongType()),
    T.StructField("vacuum_files_eligible", T.IntegerType()),
    T.StructField("manifest", T.StringType()),
])
FILE_FORMATS = {"parquet", "orc", "json", "csv", "avro"}


class TableChanged(RuntimeError):
    """Another run changed the table since this one read its version."""


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, only if there is none: False if there is one.

    The text is written beside it first.  A local file system then links it
    (which fails on an existing name); any other renames it without overwrite.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, name = path.rsplit("/", 1)
    target = jvm.org.apache.hadoop.fs.Path(path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            # No option: the rename fails where the name exists.
            none = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, none)
            return True
    except FileExistsError:
        return False
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            return False
        raise
    finally:
        fs.delete(draft, False)
    return True


def runs(spark: SparkSession, table: str) -> DataFrame:
    """The log: one row per run; none for a table that never had one."""
    folder = f"{table.rstrip('/')}/{RUNS}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], ENTRY_SCHEMA)
    return spark.read.schema(ENTRY_SCHEMA).option("pathGlobFilter", "*.json").json(folder)


def entries(spark: SparkSession, table: str) -> list:
    """The log's entries by version; there is one for every upkeep run."""
    return sorted(runs(spark, table).collect(), key=lambda r: r["version"])


def version(spark: SparkSession, table: str) -> int:
    """The table's version: the number of its runs."""
    return len(entries(spark, table))


def append(spark: SparkSession, table: str, entry: dict, after: int | None = None) -> int:
    """Append an entry and return its version; an entry whose run id is known adds nothing.

    ``after``: the version the run has read; if there is a later one by now,
    ``TableChanged`` is raised and nothing is added.
    """
    table = table.rstrip("/")
    while True:
        known = {r["run_id"]: r["version"] for r in runs(spark, table).select("run_id", "version").collect()}
        if entry["run_id"] in known:
            return known[entry["run_id"]]
        last = max(known.values(), default=0)
        if after is not None and last != after:
            raise TableChanged(f"{table} is at version {last}, the run began at {after}")
        if put_if_absent(spark, f"{table}/{RUNS}/{last + 1:010d}.json", json.dumps({**entry, "version": last + 1})):
            return last + 1


def plain_path(column: Column) -> Column:
    """``_metadata.file_path`` (an encoded URI) as listings give it: decoded, one slash after the scheme."""
    return F.regexp_replace(F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B"))), "^([A-Za-z0-9]+):/+", "$1:/")


def list_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row per data file: file_path, file_size, modified_at.

    File formats: a distributed listing through the ``binaryFile`` source
    with the content column pruned, so the cost follows the number of files,
    not rows (hidden ``_``/``.`` entries such as ``_temporary`` are skipped).
    Log-based formats (Delta) and streaming sinks must respect their commit
    log: there the hidden ``_metadata`` columns of a scan are aggregated per
    file instead.
    """
    if fmt in FILE_FORMATS and not path_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                     .option("pathGlobFilter", f"*.{fmt}").load(path)
                     .select(F.col("path").alias("file_path"), F.col("length").alias("file_size"),
                             F.col("modificationTime").alias("modified_at")))
    return (spark.read.format(fmt).load(path)
                 .select(F.col("_metadata.file_path").alias("file_path"),
                         F.col("_metadata.file_size").alias("file_size"),
                         F.col("_metadata.file_modification_time").alias("modified_at"))
                 .groupBy("file_path").agg(F.max("file_size").alias("file_size"),
                                           F.max("modified_at").alias("modified_at")))


def listed(spark: SparkSession, table: str, fmt: str = "parquet") -> DataFrame:
    """Every data file that is there: file_path, file_size, modified_at, compacted (written by upkeep)."""
    table = table.rstrip("/")
    found = list_files(spark, table, fmt).withColumn("file_path", plain_path(F.col("file_path"))
                                                     if path_exists(spark, f"{table}/_spark_metadata") else F.col("file_path"))
    found = found.withColumn("compacted", F.lit(False))
    if path_exists(spark, f"{table}/{COMPACTED}"):
        found = found.unionByName(list_files(spark, f"{table}/{COMPACTED}", fmt).withColumn("compacted", F.lit(True)))
    return found


def manifest(spark: SparkSession, table: str, fmt: str = "parquet", log: list | None = None) -> DataFrame:
    """Files of all versions: file_path, file_size, modified_at, compacted, added_in, replaced_in, replaced_at.

    Files appended since the last run come with the version that the next run
    will give them.  ``log``: the table's entries, where they have been read.
    """
    log = entries(spark, table) if log is None else log
    last = log[-1] if log else None
    own = listed(spark, table, fmt).filter("not compacted")
    now = [F.lit(0 if last is None else last["version"] + 1).alias("added_in"), F.lit(None).cast("int").alias("replaced_in"),
           F.lit(None).cast("timestamp").alias("replaced_at")]
    if last is None:
        return own.select("*", *now)
    known = spark.read.parquet(last["manifest"])
    new = own.join(known.select("file_path"), "file_path", "left_anti")
    return known.unionByName(new.select("*", *now))


def files_of(files: DataFrame, at: int | None = None) -> DataFrame:
    """Of a manifest, the files of version ``at``; None: those of the present."""
    if at is None:
        return files.filter("replaced_in is null")
    return files.filter((F.col("added_in") <= at) & (F.col("replaced_in").isNull() | (F.col("replaced_in") > at)))


def read_files(spark: SparkSession, table: str, files: list[tuple[str, bool]], fmt: str = "parquet",
               schema: T.StructType | None = None, with_path: bool = False) -> DataFrame:
    """Rows of given ``(file, compacted)`` of a table, partition columns included.

    The reader takes the names of files from the driver, as it does for any
    folder it lists itself.
    """
    table, parts = table.rstrip("/"), []
    for compacted, root in ((False, table), (True, f"{table}/{COMPACTED}")):
        names = [f for f, c in files if c == compacted]
        if not names:
            continue
        reader = spark.read.format(fmt).option("basePath", root)
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())]) if compacted else schema)
        part = reader.load(names)
        path = [plain_path(F.col("_metadata.file_path")).alias("_file")] if with_path else []
        parts.append(part.select(*[F.col(f"`{c}`") for c in part.columns if c != ATTEMPT], *path))
    if not parts:
        empty = spark.read.format(fmt).schema(schema).load(table) if schema is not None else spark.read.format(fmt).load(table)
        return empty.limit(0)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_version(spark: SparkSession, table: str, at: int | None = None, timestamp: str | None = None,
                 fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """The table as of a version of the run log, as of the last run before ``timestamp`` (UTC), or at present.

    Version 0 is the table before its first run.  A version that never was is a
    ``ValueError``, one whose files have been vacuumed a ``FileNotFoundError``.
    """
    log = entries(spark, table)
    if timestamp is not None:
        at = runs(spark, table).filter(F.col("completed_at") <= F.lit(timestamp).cast("timestamp")).agg(
            F.coalesce(F.max("version"), F.lit(0))).first()[0]
    last = len(log)
    if at is not None and not 0 <= at <= last:
        raise ValueError(f"{table} has versions 0 to {last}, not {at}")
    # Before a first run the table has one version, which is the present.
    files = files_of(manifest(spark, table, fmt, log), at if last else None)
    there = listed(spark, table, fmt).select("file_path", F.lit(True).alias("there"))
    names = files.join(there, "file_path", "left").select("file_path", "compacted", "there").collect()
    gone = [r["file_path"] for r in names if not r["there"]]
    if gone:
        raise FileNotFoundError(f"{len(gone)} files of version {at} are gone, the first is {gone[0]}")
    return read_files(spark, table, [(r["file_path"], r["compacted"]) for r in names], fmt, schema)
