"""Run log: derived run records, idempotent append, latest run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.operators.enrich import dedup_keep_first
from stratus.operators.joins import materialize_counted
from stratus.schemas import RUN_LOG_SCHEMA

RUN_COLUMNS = [f.name for f in RUN_LOG_SCHEMA.fields]
#: Keys a word of the filter is made for, and the most words it may have (16 bytes each when broadcast).
KEYS_PER_WORD, MAX_WORDS = 4, 1 << 20


def runs_from_observations(obs: DataFrame, unit: str = "hour", job_name: str = "batch_analysis",
                           status: str = "success", attempt: int = 1) -> DataFrame:
    """One run per ``unit`` of event time: the batch that processed that slice."""
    start = F.date_trunc(unit, "recorded_at")
    fmt = "yyyy-MM-dd'T'HH:mm:ss"
    return (obs.filter(F.col("recorded_at").isNotNull())
               .groupBy(start.alias("started_at"))
               .agg(F.max("recorded_at").alias("completed_at"), F.count(F.lit(1)).alias("records_processed"))
               .select(F.concat(F.lit(f"{job_name}__"), F.date_format("started_at", fmt)).alias("run_id"),
                       F.lit(job_name).alias("job_name"), "started_at", "completed_at", "records_processed",
                       F.lit(status).alias("status"), F.lit(None).cast("string").alias("error_message"),
                       F.lit(attempt).alias("attempt")))


def _word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(words))


def _bits(key: str) -> Column:
    """Four of a word's 64 bits, by a hash apart from the one that picks the word."""
    h = F.xxhash64(F.lit(1), F.col(key))
    one = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int"))
           for i in range(4)]
    return one[0].bitwiseOR(one[1]).bitwiseOR(one[2]).bitwiseOR(one[3])


def key_filter(keys: DataFrame, key: str, n: int) -> tuple[DataFrame, int]:
    """Blocked Bloom filter of ``n`` keys as a table (word number, 64 bits), and its number of words.

    Its words are at most ``MAX_WORDS``; with more keys than they are made for,
    more strangers pass, and never is a key of the set refused.
    """
    words = max(1, min(MAX_WORDS, -(-n // KEYS_PER_WORD)))
    return keys.groupBy(_word(key, words).alias("_word")).agg(F.bit_or(_bits(key)).alias("_bits")), words


def may_hold(rows: DataFrame, key: str, bloom: DataFrame, words: int) -> DataFrame:
    """The rows whose key may be in the filter: a broadcast join with at most ``MAX_WORDS`` words, no shuffle."""
    mask = _bits(key)
    hit = rows.join(F.broadcast(bloom), _word(key, words) == F.col("_word"))
    return hit.filter(F.col("_bits").bitwiseAND(mask) == mask).drop("_word", "_bits")


def append_idempotent(existing: DataFrame, incoming: DataFrame, key: str = "run_id") -> DataFrame:
    """Rows of ``incoming`` to append: one per new key, none for a key already stored.

    ``INSERT ... ON CONFLICT (key) DO NOTHING`` as a plan: dedup within the
    batch (earliest attempt wins), a Bloom filter of the batch's keys over the
    stored keys, then an exact left anti join.  Of a log of any size only keys
    that the filter passes reach the join's shuffle.
    """
    order = ["attempt"] if "attempt" in incoming.columns else []
    batch, n = materialize_counted(dedup_keep_first(incoming, [key], order))
    stored = may_hold(existing.select(key), key, *key_filter(batch.select(key), key, n))
    return batch.join(stored, key, "left_anti").select(*RUN_COLUMNS)


def latest(log: DataFrame, n: int = 1) -> DataFrame:
    """Newest runs first (a top-n report: the limit is the feature)."""
    return log.orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)
