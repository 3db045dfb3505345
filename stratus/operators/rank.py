"""Distributed ``rank()`` over a global ordering.

``rank() OVER (ORDER BY v DESC)`` without a partition key runs in one task.
Here the rank of a value is ``1 + rows with a value before it``, computed as:

1. pre-aggregate: distinct values with their row counts (partial + final agg);
2. cut the distinct values into ordered buckets by approximate quantiles
   (bucket id is a pure function of the value, so recomputation is stable);
3. a window *per bucket* gives the rows before a value inside its bucket;
   per-bucket totals (one row per bucket, a proven small table) give the
   bucket offsets;
4. join ranks back to the rows on the value (size-checked broadcast).

Ordering follows Spark's ``desc``: NaN first, nulls last; ties share a rank
and leave gaps, as ``rank()`` does.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.operators.joins import join_checked, materialize_counted

VALUES_PER_BUCKET_CONF = "stratus.rank.valuesPerBucket"
VALUES_PER_BUCKET_DEFAULT = 2_000_000


def rank_desc(df: DataFrame, value: str, rank_col: str = "rank",
              values_per_bucket: int | None = None) -> DataFrame:
    spark = df.sparkSession
    per_bucket = values_per_bucket or int(spark.conf.get(VALUES_PER_BUCKET_CONF, str(VALUES_PER_BUCKET_DEFAULT)))
    v = F.col(value)
    counts, n_distinct = materialize_counted(df.groupBy(value).agg(F.count(F.lit(1)).alias("_n")))
    n_buckets = max(1, math.ceil(n_distinct / per_bucket))
    if n_buckets > 1:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        bounds = sorted(set(b for b in counts.filter(v.isNotNull() & ~F.isnan(v.cast('double')))
                            .approxQuantile(value, probs, 0.001)), reverse=True)
    else:
        bounds = []
    # Bucket 0 holds the largest values (and NaN); nulls go after every bucket.
    bucket = _bucket_of(v.cast("double"), bounds, 0, len(bounds)) if bounds else F.lit(0)
    bucket = F.when(v.isNull(), F.lit(len(bounds) + 1)).otherwise(bucket)
    with_b = counts.withColumn("_bucket", bucket)
    w = (Window.partitionBy("_bucket").orderBy(v.desc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, -1))
    within = with_b.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    totals = with_b.groupBy("_bucket").agg(F.sum("_n").alias("_tot"))
    # One row per bucket: a bounded table, ordered in a single small window.
    ow = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_tot").over(ow), F.lit(0))).select("_bucket", "_off")
    ranks = (within.join(F.broadcast(offsets), "_bucket")
             .select(v, (F.col("_off") + F.col("_before") + 1).cast("int").alias(rank_col),
                     F.col("_n")))
    # Join back on the value; a null value must match the null rank row.
    # The key keeps the value's own type: long values beyond 2**53 stay apart.
    key = F.coalesce(v, F.lit(0).cast(df.schema[value].dataType))
    keyed = df.withColumn("_vkey", key)
    keyed = keyed.withColumn("_vnull", v.isNull())
    ranks = (ranks.withColumn("_vkey", key)
                  .withColumn("_vnull", v.isNull()).drop(value))
    # ranks has one row per distinct value and derives from the checkpoint.
    out, _ = join_checked(keyed, ranks, ["_vkey", "_vnull"], count_col="_n", small_rows=n_distinct)
    return out.drop("_vkey", "_vnull", "_n")


def _bucket_of(v, bounds: list[float], lo: int, hi: int):
    """Number of ``bounds`` (sorted descending) that are >= ``v``, as a binary-search
    CASE tree: depth log2(n), plain comparisons only (stays in codegen).  NaN
    compares below nothing, so it lands in bucket 0 like Spark's NaN-first order."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(F.lit(float(bounds[mid])) >= v, _bucket_of(v, bounds, mid + 1, hi)) \
            .otherwise(_bucket_of(v, bounds, lo, mid))
