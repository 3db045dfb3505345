"""Interaction audit of document filters: what every order of them removes, step by step.

1. Every document gets a mask of the filters it fails and, for identity, a digest
   of its text.  Copies are settled by aggregation: per text the least id.
2. Documents are counted per part and mask; from here on sizes depend on the
   number of parts alone.
3. Orders are ranked as permutations in lexicographic order (Lehmer code).  The
   orders that begin with given filters are an interval of ranks.  A document
   of some mask is removed at step s by filter f in the orders that begin with
   s - 1 filters it passes, then f: its count is added where that interval
   begins and taken off behind its end.
4. A prefix sum over the ranks gives every order's removals at every step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratus.llm.common import small_batches, small_or_shuffled, table, text_blocks
from stratus.operators.joins import materialize

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50  # percent of the words
MAX_UPPER = 3  # percent of the code points
#: Filter E, identity with an earlier document, cannot be judged on a text alone.
COPY = 1 << FILTERS.index("E")

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))
_ARROW = pa.struct([("mask", pa.int32()), ("digest", pa.binary())])


def failures(text: bytes) -> int:
    """Mask of the filters A to D that a UTF-8 text fails."""
    words = text.split()  # bytes: exactly the six ASCII white space characters
    chars = len(text) - len(text.translate(None, _UPPER))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    points = len(text.translate(None, _CONTINUED))
    few, same = len(words) < MIN_WORDS, 100 * len(set(words)) < MIN_DISTINCT * len(words)
    return few | same << 1 | (100 * chars > MAX_UPPER * points) << 2 | (symbols > 0) << 3


def _judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for _, block in text_blocks(batch):
            out += [{"mask": failures(t), "digest": hashlib.blake2b(t, digest_size=16).digest()} for t in block]
        yield pa.array(out, _ARROW)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents, and those labelled good and toxic, of every part and mask.

    Per text: the rows of one id are counted first, then those of one part and
    label pair, so copies of a text are combined in every task before they meet.
    """
    judged = F.arrow_udf(_judged, "struct<mask:int,digest:binary>", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    rows = small_batches(docs).select(docs["doc_id"].alias("id"), F.coalesce(docs["lang"], F.lit("")).alias("part"),
                                      judged(docs["text"]).alias("j"))
    rows = materialize(rows.select("id", "part", "j.*"))
    marked = labels.filter(F.col("doc_id").isNotNull()).groupBy(labels["doc_id"].alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(small_or_shuffled(marked), "id", "left").fillna(0, ["good", "toxic"])
    per = ["digest", "mask", "part", "good", "toxic"]
    ids = rows.groupBy(*per, "id").agg(F.count("*").alias("n"))
    named = F.col("id").isNotNull()
    texts = ids.groupBy(*per).agg(F.min("id").alias("least"), F.min_by(F.when(named, F.col("n")), "id").alias("at_least"),
                                  F.sum("n").alias("n"), F.sum(F.when(~named, F.col("n"))).alias("unnamed"))
    texts = materialize(texts)
    first = texts.groupBy("digest").agg(F.min("least").alias("first"))
    texts = texts.join(first, "digest")
    # No document of this text has an id smaller than ``first``; a row without id is compared with none.
    kept = F.coalesce("unnamed", F.lit(0)) + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    both = F.array(F.struct(F.col("mask").alias("mask"), kept.alias("n")),
                   F.struct(F.col("mask").bitwiseOR(F.lit(COPY)).alias("mask"), (F.col("n") - kept).alias("n")))
    counts = texts.withColumn("kept", kept).select("part", "good", "toxic", F.inline(both)).filter("n > 0")
    return counts.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                              F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def lehmer_rank(prefix: tuple[int, ...], n: int) -> int:
    """Rank, among the permutations of ``range(n)`` in lexicographic order, of the first one that begins with ``prefix``."""
    free, rank = list(range(n)), 0
    for i, x in enumerate(prefix):
        rank += free.index(x) * factorial(n - 1 - i)
        free.remove(x)
    return rank


def intervals(n: int) -> list[tuple[int, int, int, int]]:
    """``(mask, step, start, end)``: the ranks of the orders in which a document of this mask is removed at this step."""
    out = []
    for mask in range(1, 1 << n):
        fails = [f for f in range(n) if mask >> f & 1]
        passes = [f for f in range(n) if not mask >> f & 1]
        for step in range(1, len(passes) + 2):
            for before in permutations(passes, step - 1):
                for f in fails:
                    start = lehmer_rank((*before, f), n)
                    out.append((mask, step, start, start + factorial(n - step)))
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A null text is the empty text and a null lang the part ''.  Of rows with
    equal text those of the least id are no copies, nor are rows without id;
    rows that repeat an id are each counted.  A document has a label if any of
    its label rows says so; null labels say nothing.  Texts of any length are
    read whole.  An empty table gives no rows.  Columns besides doc_id, text and
    lang are not read.
    """
    spark, n = docs.sparkSession, len(FILTERS)
    counts = materialize(masks(docs, labels))
    ends = [(m, s, at, sign) for m, s, a, b in intervals(n) for at, sign in ((a, 1), (b, -1)) if at < factorial(n)]
    ends = spark.createDataFrame(ends, "mask int, step int, rank int, sign int")
    steps = [(r, s + 1, "".join(FILTERS[f] for f in p), 1 << p[s]) for r, p in enumerate(permutations(range(n))) for s in range(n)]
    steps = spark.createDataFrame(steps, "rank int, step int, filter_order string, bit int")
    what = ["n", "good", "toxic"]
    change = counts.join(F.broadcast(ends), "mask").groupBy("part", "step", "rank").agg(
        *[F.sum(F.col(c) * F.col("sign")).alias(c) for c in what])
    bits = [1 << f for f in range(n)]
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("all"),
        *[F.sum(F.when(F.col("mask").bitwiseAND(F.lit(b)) != 0, F.col("n")).otherwise(0)).alias(f"fails_{b}") for b in bits],
        *[F.sum(F.when(F.col("mask") == b, F.col("n")).otherwise(0)).alias(f"only_{b}") for b in bits])
    # A row for every part, rank and step, whether something changes there or not.
    grid = totals.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))))
    grid = grid.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    grid = grid.join(change, ["part", "rank", "step"], "left").join(F.broadcast(steps), ["rank", "step"])
    ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    summed = grid.select("part", "filter_order", "step", "bit", "all", *[c for b in bits for c in (f"fails_{b}", f"only_{b}")],
                         *[F.sum(F.coalesce(c, F.lit(0))).over(ranks).alias(c) for c in what])

    def of_bit(name):
        return F.coalesce(*[F.when(F.col("bit") == b, F.col(f"{name}_{b}")) for b in bits])

    order = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return summed.select(
        "part", "filter_order", "step", (F.col("all") - F.sum("n").over(order)).alias("kept"), F.col("n").alias("removed"),
        (of_bit("fails") - F.col("n")).alias("redundant"), of_bit("only").alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "bit")).alias("shapley"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
f AS (SELECT doc_id, part, len(w) < {MIN_WORDS} AS a, 100 * len(list_distinct(w)) < {MIN_DISTINCT} * len(w) AS b,
        100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {MAX_UPPER} * length(text) AS c,
        regexp_matches(text, '[#$%&*|]') AS d, coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS e FROM w),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
i AS (SELECT unnest(range(1, 6)) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a JOIN i b ON b.i <> a.i JOIN i c ON c.i NOT IN (a.i, b.i)
      JOIN i d ON d.i NOT IN (a.i, b.i, c.i) JOIN i e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
s AS (SELECT o, array_to_string(list_transform(o, lambda x: substr('{FILTERS}', x, 1)), '') AS filter_order, i.i AS step, o[i.i] AS f FROM o, i),
x AS (SELECT part, filter_order, step, f, n, good, toxic, fails[f] AS hit,
        len(list_filter(o[1:step - 1], lambda k: fails[k])) > 0 AS gone, len(list_filter(fails, lambda k: k)) AS n_fails FROM m, s),
r AS (SELECT part, filter_order, step, f, sum(n) FILTER (WHERE NOT gone AND NOT hit) AS kept, sum(n) FILTER (WHERE hit AND NOT gone) AS removed,
        sum(n) FILTER (WHERE hit AND gone) AS redundant, sum(n) FILTER (WHERE hit AND n_fails = 1) AS unique_fails,
        sum(good) FILTER (WHERE hit AND NOT gone) AS good_lost, sum(toxic) FILTER (WHERE hit AND NOT gone) AS toxic_lost
      FROM x GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley FROM r
"""
