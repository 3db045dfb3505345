"""Table upkeep: metrics, compaction, retention report, maintenance report.

File facts come from the hidden ``_metadata`` columns of a scan (path, size,
modification time), aggregated per file on the executors; the driver only
receives one-row summaries.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators.joins import join_checked, materialize
from stratus.schemas import PARTITION_COLUMNS
from stratus.session import path_exists
from stratus.sources import tablelog as L
from stratus.sources.lake import open_writers
from stratus.sources.tablelog import FILE_FORMATS, METRICS_TYPE, OPTIMIZE_TYPE
from stratus.sources.tablelog import list_files as table_files

# Fixed value: default retention for old-file removal, in hours (7 days).
RETENTION_HOURS = 168

REPORT_SCHEMA = T.StructType([
    T.StructField("delta_path", T.StringType()),
    T.StructField("before", METRICS_TYPE),
    T.StructField("after", METRICS_TYPE),
    T.StructField("optimize", OPTIMIZE_TYPE),
    T.StructField("vacuum_files_eligible", T.IntegerType()),
])


def table_metrics(spark: SparkSession, path: str, fmt: str = "parquet", version: int | None = None) -> DataFrame:
    """One row: table_version, num_files, size_bytes.

    The version is the number of runs in the table's run log, unless given; the
    files are those of the present version.
    """
    if fmt in FILE_FORMATS and version is None:
        log = L.entries(spark, path)
        files, version = L.files_of(L.manifest(spark, path, fmt, log)), len(log)
    else:
        files = table_files(spark, path, fmt)
    return _metrics(files, version or 0)


def _metrics(files: DataFrame, version: int) -> DataFrame:
    return files.agg(F.lit(version).cast("int").alias("table_version"),
                     F.count(F.lit(1)).cast("int").alias("num_files"),
                     F.coalesce(F.sum("file_size"), F.lit(0)).cast("long").alias("size_bytes"))


def _metrics_row(spark, path, fmt, version=None):
    r = table_metrics(spark, path, fmt, version).first()
    return (r["table_version"], r["num_files"], r["size_bytes"])


# Compaction: files under SMALL_SHARE of the target are packed, at most CHUNK_FILES of a
# partition at a time; a rewriting job takes at most JOB_FILES of them.
TARGET_BYTES = 128 << 20
SMALL_SHARE = 0.75
CHUNK_FILES = 2_000
JOB_FILES = 20_000


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of every size: the largest come first, each into the first bin that has room for it."""
    room: list[int] = []
    bins = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        if at == len(room):
            room.append(capacity)
        room[at] -= sizes[i]
        bins[i] = at
    return bins


def plan_compaction(files: DataFrame, target_bytes: int = TARGET_BYTES, small_share: float = SMALL_SHARE,
                    chunk_files: int = CHUNK_FILES) -> DataFrame:
    """Bins of small files to be rewritten as one file each: partition, chunk, bin, n_files, bytes, files.

    ``files`` are rows of a manifest.  Only bins of two files or more are given,
    so a table that is compact already yields none.  A partition with many small
    files is packed in chunks, so no task gets an unbounded group.
    """
    folder = F.regexp_replace("file_path", r"/[^/]*$", "")
    small = (files.filter(F.col("file_size") < target_bytes * small_share)
             .select(F.regexp_extract(folder, r"((/[^/=]+=[^/]*)*)$", 1).alias("full"), "file_path", "file_size", "compacted")
             .withColumn("partition", F.regexp_replace("full", f"/{L.ATTEMPT}=[^/]*", "")).drop("full"))
    sizes = small.groupBy("partition").agg(F.ceil(F.count("*") / F.lit(chunk_files)).cast("int").alias("chunks"))
    small = join_checked(small, sizes, ["partition"])[0]
    small = small.withColumn("chunk", F.pmod(F.xxhash64("file_path"), F.col("chunks")).cast("int")).drop("chunks")

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("file_path")
        return group.assign(bin=first_fit_decreasing(group["file_size"].tolist(), target_bytes))

    packed = small.groupBy("partition", "chunk").applyInPandas(
        pack, "file_path string, file_size long, compacted boolean, partition string, chunk int, bin int")
    return (packed.groupBy("partition", "chunk", "bin")
            .agg(F.count("*").alias("n_files"), F.sum("file_size").alias("bytes"),
                 F.collect_list(F.struct("file_path", "compacted")).alias("files")).filter("n_files > 1"))


def _jobs(bins: DataFrame, job_files: int) -> Iterator[list]:
    """The bins, in lists of at most ``job_files`` files (one bin at least)."""
    job, n = [], 0
    for b in bins.toLocalIterator():
        if job and n + b["n_files"] > job_files:
            yield job
            job, n = [], 0
        job.append(b)
        n += b["n_files"]
    if job:
        yield job


def _rewrite(spark: SparkSession, path: str, bins: list, folder: str, fmt: str, schema, cols: list[str]) -> None:
    """Write every bin as one file; the rows read and those written are counted and must agree."""
    files = [(f["file_path"], f["compacted"]) for b in bins for f in b["files"]]
    rows = L.read_files(spark, path, files, fmt, schema, with_path=True)
    place = spark.createDataFrame([(f["file_path"], i) for i, b in enumerate(bins) for f in b["files"]], "_file string, _bin int")
    seen = Observation()
    rows = join_checked(rows.observe(seen, F.count("*").alias("n")), place, ["_file"], small_rows=len(files))[0]
    kept = Observation()
    rows = rows.repartitionById(len(bins), F.col("_bin")).drop("_file", "_bin").observe(kept, F.count("*").alias("n"))
    writer = rows.write.mode("append").format(fmt)
    with open_writers(spark, 1):  # a task's rows are of one bin, and so of one partition: nothing to sort
        (writer.partitionBy(*cols) if cols else writer).save(folder)
    if seen.get["n"] != kept.get["n"]:
        raise RuntimeError(f"compaction of {path} read {seen.get['n']} rows and wrote {kept.get['n']}")


def upkeep(spark: SparkSession, path: str, run_id: str, fmt: str = "parquet", partition_cols: list[str] | None = None,
           target_bytes: int = TARGET_BYTES, retention_hours: int = RETENTION_HOURS, schema: T.StructType | None = None,
           job_files: int = JOB_FILES) -> DataFrame:
    """One upkeep run on a table of plain files: metrics, selective compaction, retention report, metrics.

    Groups of small files become one file each, in a folder that plain readers
    pass over; large files stay as they are, and nothing is deleted.  The run's
    entry in the table's log makes the new version; until it is there, readers see
    the old one, and a run that failed leaves only files that no version names.
    A run whose id is in the log does nothing and returns that run's report.
    """
    path = path.rstrip("/")
    cols = partition_cols if partition_cols is not None else PARTITION_COLUMNS
    log = L.entries(spark, path)
    if run_id not in {r["run_id"] for r in log}:
        last, t0 = len(log), time.time()
        files = materialize(L.manifest(spark, path, fmt, log))
        before = _metrics(L.files_of(files), last).first()
        bins = materialize(plan_compaction(L.files_of(files), target_bytes))
        root = f"{path}/{L.COMPACTED}/{L.ATTEMPT}={uuid.uuid4().hex}"
        for job in _jobs(bins, job_files):
            _rewrite(spark, path, job, root, fmt, schema, cols)
        now = dt.datetime.now(dt.timezone.utc)
        old = bins.select(F.explode("files.file_path").alias("file_path"), F.lit(True).alias("old"))
        state = files.join(old, "file_path", "left")
        state = state.withColumn("replaced_in", F.when(F.col("old"), last + 1).otherwise(F.col("replaced_in")))
        state = state.withColumn("replaced_at", F.when(F.col("old"), F.lit(now)).otherwise(F.col("replaced_at"))).drop("old")
        if path_exists(spark, root):
            state = state.unionByName(L.list_files(spark, root, fmt).select(
                "*", F.lit(True).alias("compacted"), F.lit(last + 1).alias("added_in"),
                F.lit(None).cast("int").alias("replaced_in"), F.lit(None).cast("timestamp").alias("replaced_at")))
        saved = f"{path}/{L.MANIFESTS}/{uuid.uuid4().hex}"
        state.write.parquet(saved)
        done, state = time.time() - t0, spark.read.parquet(saved)
        live = L.files_of(state).agg(F.count("*"), F.coalesce(F.sum("file_size"), F.lit(0)),
                                     F.count(F.when(F.col("added_in") == last + 1, F.when(F.col("compacted"), 1)))).first()
        was = bins.agg(F.coalesce(F.sum("n_files"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        eligible = unreferenced_files(spark, path, fmt, retention_hours, known=state).filter("eligible").count()
        L.append(spark, path, {
            "run_id": run_id, "completed_at": now.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "delta_path": path,
            "before": dict(zip(METRICS_TYPE.names, before)),
            "after": dict(zip(METRICS_TYPE.names, (last + 1, live[0], live[1]))),
            "optimize": dict(zip(OPTIMIZE_TYPE.names, (live[2], was[0], done))),
            "bytes_rewritten": was[1], "vacuum_files_eligible": eligible, "manifest": saved}, after=last)
    return L.runs(spark, path).filter(F.col("run_id") == run_id)


def unreferenced_files(spark: SparkSession, path: str, fmt: str = "parquet", retention_hours: int = RETENTION_HOURS,
                       now: dt.datetime | None = None, known: DataFrame | None = None) -> DataFrame:
    """Files that the present version does not name: file_path, file_size, since, eligible.

    The listing of what is there, less the live files of the last run's manifest
    and the table's own files that were appended since.  ``since``: when a run
    replaced the file, or for one that no run ever named, when it was written.
    ``known``: the manifest to go by, if not the table's own.
    """
    there = L.listed(spark, path, fmt)
    known = (L.manifest(spark, path, fmt) if known is None else known).select("file_path", F.col("replaced_in").isNull().alias("live"), "replaced_at")
    cutoff = F.lit(now or dt.datetime.now(dt.timezone.utc)) - F.make_dt_interval(hours=F.lit(retention_hours))
    rest = there.join(known, "file_path", "left").filter(~F.coalesce("live", F.lit(False)))
    since = F.coalesce("replaced_at", "modified_at")
    return rest.select("file_path", "file_size", since.alias("since"), (since < cutoff).alias("eligible"))


def compact(spark: SparkSession, path: str, new_path: str, fmt: str = "parquet",
            partition_cols: list[str] | None = None) -> dict:
    """Rewrite a table into few, large files at ``new_path``.

    On Delta this is ``OPTIMIZE``; on Parquet the table is read, rebalanced by
    its partition columns and written to a new path (files added to a
    streaming sink's folder from outside would be invisible to readers).
    """
    cols = partition_cols if partition_cols is not None else PARTITION_COLUMNS
    t0 = time.time()
    if fmt == "delta":
        m = spark.sql(f"OPTIMIZE delta.`{path}`").first()["metrics"]
        return {"files_added": int(m["numFilesAdded"]), "files_removed": int(m["numFilesRemoved"]),
                "duration_seconds": time.time() - t0, "path": path}
    before = table_files(spark, path, fmt).count()
    df = spark.read.format(fmt).load(path)
    writer = df.hint("rebalance", *cols).write.mode("overwrite").format(fmt)
    (writer.partitionBy(*cols) if cols else writer).save(new_path)
    after = table_files(spark, new_path, fmt).count()
    return {"files_added": int(after), "files_removed": int(before),
            "duration_seconds": time.time() - t0, "path": new_path}


def retention_report(spark: SparkSession, path: str, fmt: str = "parquet",
                     retention_hours: int = RETENTION_HOURS, now: dt.datetime | None = None) -> DataFrame:
    """Files that could be removed: no version in use names them, for longer than the retention window.

    Formats with a log of their own: files older than the window.
    """
    if fmt in FILE_FORMATS:
        total = L.listed(spark, path, fmt).count()
        return unreferenced_files(spark, path, fmt, retention_hours, now).agg(
            F.coalesce(F.sum(F.col("eligible").cast("int")), F.lit(0)).cast("int").alias("files_eligible"),
            F.lit(total).cast("int").alias("files_total"), F.lit(retention_hours).alias("retention_hours"))
    cutoff = F.current_timestamp() - F.make_dt_interval(hours=F.lit(retention_hours))
    files = table_files(spark, path, fmt)
    return files.agg(F.sum(F.when(F.col("modified_at") < cutoff, 1).otherwise(0)).cast("int")
                     .alias("files_eligible"), F.count(F.lit(1)).cast("int").alias("files_total"),
                     F.lit(retention_hours).alias("retention_hours"))


def vacuum(spark: SparkSession, path: str, fmt: str = "parquet", retention_hours: int = RETENTION_HOURS,
           delete: bool = False, now: dt.datetime | None = None) -> int:
    """Remove unreferenced old files; returns how many were removed.

    Tables of plain files lose nothing unless ``delete`` says so.  Versions
    that named a removed file cannot be read any more.
    """
    if fmt == "delta":
        try:
            from delta.tables import DeltaTable  # optional connector
        except ImportError as e:  # pragma: no cover - connector absent here
            raise RuntimeError("Delta connector not available") from e
        DeltaTable.forPath(spark, path).vacuum(retention_hours)
        return 0
    if not delete:
        return 0
    jvm, conf, removed = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    old = materialize(unreferenced_files(spark, path, fmt, retention_hours, now).filter("eligible").select("file_path"))
    for r in old.toLocalIterator():
        p = jvm.org.apache.hadoop.fs.Path(r["file_path"])
        removed += bool(p.getFileSystem(conf).delete(p, False))
    return removed


def maintenance_report(spark: SparkSession, path: str, new_path: str, fmt: str = "parquet",
                       retention_hours: int = RETENTION_HOURS, version: int = 0,
                       partition_cols: list[str] | None = None) -> DataFrame:
    """metrics -> compact -> retention -> metrics, as a one-row nested report."""
    before = _metrics_row(spark, path, fmt, version)
    opt = compact(spark, path, new_path, fmt, partition_cols)
    eligible = retention_report(spark, path, fmt, retention_hours).first()["files_eligible"] or 0
    vacuum(spark, path, fmt, retention_hours)
    after = _metrics_row(spark, opt["path"], fmt, version + 1)
    row = (opt["path"], before, after,
           (opt["files_added"], opt["files_removed"], float(opt["duration_seconds"])), int(eligible))
    return spark.createDataFrame([row], REPORT_SCHEMA)


def maintenance_status(runs: DataFrame, reports: DataFrame, key: str = "run_id") -> DataFrame:
    """``completed`` for a run with a report (missing keys tolerated), else ``no_result``.

    Reports are left-joined to runs; summary fields fall back to defaults
    (``unknown`` / 0) when a report lacks them.
    """
    r = reports.select(key, F.lit(True).alias("_has_report"),
                       *[c for c in ("before", "after", "optimize", "delta_path") if c in reports.columns])
    j = runs.join(r, key, "left")

    def field(struct_col, name, default):
        if struct_col not in r.columns:
            return F.lit(default)
        return F.coalesce(F.col(f"{struct_col}.{name}").cast("string"), F.lit(default))

    return j.select(
        key,
        F.when(F.col("_has_report"), "completed").otherwise("no_result").alias("status"),
        F.when(F.col("_has_report"), field("before", "table_version", "unknown")).alias("before_version"),
        F.when(F.col("_has_report"), field("after", "table_version", "unknown")).alias("after_version"),
        F.when(F.col("_has_report"), field("optimize", "files_removed", "0")).alias("files_removed"),
    )


def partition_inventory(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Readiness check: fail when the table is missing, else partitions per year.

    Partition values are read from the data files' paths (``year=.../hour=...``),
    so the check lists files instead of scanning rows.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"table not found: {path}")
    files = table_files(spark, path, fmt)
    parts = files.select(*[F.regexp_extract("file_path", rf"/{c}=([^/]*)/", 1).try_cast("int").alias(c)
                           for c in PARTITION_COLUMNS]).distinct()
    return parts.groupBy("year").agg(F.count(F.lit(1)).alias("partitions"))
