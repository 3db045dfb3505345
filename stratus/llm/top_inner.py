"""Exact top-k search by inner product over integer vectors, longest vectors first.

1. Components become integers; every vector gets its length.  The Gram matrix of
   all vectors, summed in the tasks, gives the rotation (its eigenvectors, which
   are the right singular vectors of the table) that puts most of the length
   into the leading coordinates.
2. Vectors are range-partitioned by descending length into strips.
3. The longest ``HEAD`` vectors give every query a score that its k-th result
   must reach.  By Cauchy-Schwarz a query can only find more in strips whose
   longest vector times its own length reaches that score: a prefix of the strips.
4. A cell (strip, group of queries) is walked by descending length.  Partial sums
   over the leading rotated coordinates plus the product of the residual lengths
   bound a score from above; what cannot reach the k-th score so far is pruned,
   the rest is scored exactly in integers.
5. The cells' results are merged by query.

Bounds are rounded upwards, so no result is lost; the pruning only decides how
much is computed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratus.llm.common import table
from stratus.operators.joins import materialize_counted

SCALE = 256
TOP = 5
EVERY = 50
#: Longest vectors, the same for all queries, that give the first score to reach.
HEAD = 512
#: Numbers in the vectors of a strip, and in the queries of a cell.
STRIP_VALUES = 1 << 22
CELL_VALUES = 1 << 21
#: Pairs compared at once, and the share of them above which all are scored rather than those left.
TILE = 1 << 20
DENSE = 1 / 64
#: Squared length below which scores fit a long; below EXACT a double holds every partial sum.
LIMIT, EXACT = 2.0 ** 62, 2.0 ** 52
SLACK = 1e-9


def integers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component; null for a vector with a null, non-finite or too large component."""
    big = F.lit(2.0 ** 31 / scale)
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < big))
    return F.when(good, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def squared_length(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def matrix(lists: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column as doubles; shorter vectors end in zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(size), d))
    if len(size):
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        out[np.arange(d)[None, :] < size[:, None]] = flat
    return out


def _gram(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x = matrix(batch.column("v").slice(at, 4096), d)
                total += x.T @ x
        i, j = np.indices((d, d))
        yield pa.RecordBatch.from_arrays([pa.array(a.ravel()) for a in (i, j, total)], ["i", "j", "g"])

    return run


def rotation(vectors: DataFrame, d: int) -> np.ndarray:
    """Orthogonal ``(d, d)`` matrix: eigenvectors of the Gram matrix, largest eigenvalue first."""
    sums = vectors.select("v").mapInArrow(_gram(d), "i long, j long, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))
    gram = np.zeros((d, d))
    for r in sums.collect():  # d * d rows, whatever the number of vectors
        gram[r["i"], r["j"]] = r["g"]
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _stages(d: int) -> list[tuple[int, int]]:
    edges = sorted({min(d, e) for e in (0, max(1, d // 8), max(1, d // 4), max(1, d // 2))})
    return list(zip(edges[:-1], edges[1:]))


class Rotated:
    """Vectors with their rotation and the lengths of what is left after every stage."""

    def __init__(self, x: np.ndarray, turn: np.ndarray):
        self.x, self.stages = x, _stages(x.shape[1])
        self.r = x @ turn
        self.length = np.sqrt((x * x).sum(1)) * (1 + SLACK)
        tail = np.cumsum((self.r * self.r)[:, ::-1], 1)[:, ::-1]
        tail = np.sqrt(np.append(tail, np.zeros((len(x), 1)), 1))
        self.rest = [tail[:, e] for _, e in self.stages]


def scores(a: np.ndarray, b: np.ndarray, pairwise: bool = False) -> np.ndarray:
    """Exact integer inner products of rows with all rows, or row by row if ``pairwise``."""
    most = (a * a).sum(1).max(initial=0) * (b * b).sum(1).max(initial=0)
    if most >= EXACT ** 2:
        a, b = a.astype(np.int64), b.astype(np.int64)
    return (np.einsum("ij,ij->i", a, b) if pairwise else a @ b.T).astype(np.int64)


class Best:
    """The k best of each query so far: score, then smaller id, a null id last."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.q, self.score, self.id, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
        self.least = np.full(n, -np.inf)

    def add(self, q, score, ids, null):
        q, score, ids, null = (np.concatenate(x) for x in ((self.q, q), (self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((ids, null, -score, q))
        q, score, ids, null = q[order], score[order], ids[order], null[order]
        first = np.flatnonzero(np.append(True, q[1:] != q[:-1])[:len(q)])
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        keep = place < self.k
        self.q, self.score, self.id, self.null = q[keep], score[keep], ids[keep], null[keep]
        last = place == self.k - 1
        self.least[q[last]] = np.maximum(self.least[q[last]], score[last])


def walk(queries: Rotated, own: np.ndarray, reach: np.ndarray, rows: Rotated, ids: np.ndarray, null: np.ndarray,
         k: int = TOP) -> tuple[Best, int]:
    """The k best of ``rows`` (by descending length) for every query, and the number of pairs scored.

    ``reach`` is a score that a result must have at least.
    """
    best, scored, at, step = Best(len(own), k), 0, 0, 4 * k
    best.least = np.maximum(best.least, reach)
    while at < len(ids):
        end = min(len(ids), at + step)
        alive = np.flatnonzero(queries.length * rows.length[at] >= best.least)
        if not len(alive):
            break
        width = max(1, TILE // (end - at))
        for s in range(0, len(alive), width):
            qs, cs = alive[s:s + width], np.arange(at, end)
            least = best.least[qs]
            total = np.zeros((len(qs), len(cs)))
            for (a, b), q_rest, c_rest in zip(queries.stages, queries.rest, rows.rest):
                total += queries.r[qs, a:b] @ rows.r[cs, a:b].T
                slack = SLACK * queries.length[qs, None] * rows.length[None, cs]
                left = total + q_rest[qs, None] * c_rest[None, cs] + slack >= least[:, None]
                q_left, c_left = left.any(1), left.any(0)
                if not q_left.any():
                    break
                total, left = total[q_left][:, c_left], left[q_left][:, c_left]
                qs, cs, least = qs[q_left], cs[c_left], least[q_left]
            if not left.any():
                continue
            if left.mean() > DENSE:
                found = scores(queries.x[qs], rows.x[cs])
                scored += found.size
                i, j = np.nonzero(found >= least[:, None])
                value = found[i, j]
            else:
                i, j = np.nonzero(left)
                value = scores(queries.x[qs[i]], rows.x[cs[j]], pairwise=True)
                scored += len(value)
                good = value >= least[i]
                i, j, value = i[good], j[good], value[good]
            i, j = qs[i], cs[j]
            other = null[j] | (ids[j] != own[i])
            best.add(i[other], value[other], ids[j[other]], null[j[other]])
        at, step = end, min(step * 4, 2048)
    return best, scored


def _ids(column) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    null = np.asarray(column.is_null().to_numpy(zero_copy_only=False), bool)
    return np.asarray(column.fill_null(0).to_numpy(zero_copy_only=False), np.int64), null


def _reach(head: Rotated, ids: np.ndarray, null: np.ndarray, turn: np.ndarray, lengths: np.ndarray, k: int):
    """Per query: the score to reach, and how many strips it has to visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(turn)
        for batch in batches:
            x = Rotated(matrix(batch.column("v"), d), turn)
            own = _ids(batch.column("id"))[0]
            best, _ = walk(x, own, np.full(len(own), -np.inf), head, ids, null, k)
            # Strips are by descending length, so those in reach are the first ones.
            visits = (x.length[:, None] * lengths[None, :] * (1 + SLACK) >= best.least[:, None]).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.least), pa.array(visits.astype(np.int32))],
                                             [*batch.schema.names, "reach", "visits"])

    return run


def _cell(turn: np.ndarray, k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        d = len(turn)
        q_id, q_key, c_id, found = [np.zeros(0, np.int64)] * 4
        null = np.zeros(0, bool)
        if rows.num_rows and queries.num_rows:
            ids, id_null = _ids(rows["id"])
            x = matrix(rows["v"], d)
            order = np.argsort(-(x * x).sum(1), kind="stable")
            own, _ = _ids(queries["id"])
            key, _ = _ids(queries["key"])
            best, _ = walk(Rotated(matrix(queries["v"], d), turn), own, queries["reach"].to_numpy(),
                           Rotated(x[order], turn), ids[order], id_null[order], k)
            q_id, q_key, c_id, found, null = own[best.q], key[best.q], best.id, best.score, best.null
        return pa.table({"query_id": q_id, "key": q_key, "vec_id": pa.array(c_id, mask=null), "score": found})

    return run


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, scale: int = SCALE, id_column: str = "vec_id",
          vector: str = "embedding", strip_rows: int | None = None, cell_queries: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k rows of largest inner product for every row whose id is divisible by ``every``.

    Components are ``floor(scale * x)``.  Vectors that are null, hold a null or
    non-finite component, or are so long that a score might not fit a long
    (a component of 2**31, a squared length of 2**62) take no part.  A shorter
    vector counts as ending in zeros; an empty one has score 0 with all.  Rows
    that repeat id and vector are one row; rows with the query's id are its own
    and no candidates.  Ties go to the smaller id; a row without id is never a
    query and comes last among ties.  Rows of one id with different vectors are
    queries of their own and share ``query_id``.  Fewer than k candidates give as
    many results.  An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    base = vectors.select(vectors[id_column].cast("long").alias("id"), integers(vectors[vector], scale).alias("v"))
    # Copies of a row meet before the shuffle: the aggregation combines them in every task.
    base = base.filter(F.col("v").isNotNull()).groupBy("id", "v").agg(F.lit(1).alias("one")).select("id", "v")
    base = base.withColumn("squared", squared_length(F.col("v"))).filter(F.col("squared") < LIMIT)
    base, n = materialize_counted(base.withColumn("key", F.xxhash64("id", "v")))
    d = max(1, base.agg(F.max(F.size("v"))).first()[0] or 0)
    tasks = spark.sparkContext.defaultParallelism
    per_strip = strip_rows or min(max(1, STRIP_VALUES // d), max(2048, -(-n // tasks)))
    strips = max(1, -(-n // per_strip))
    turn = rotation(base, d)
    sorted_rows = base.repartitionByRange(strips, F.desc("squared"), "id", "key").withColumn("strip", F.spark_partition_id())
    rows, _ = materialize_counted(sorted_rows)
    lengths = {r["strip"]: r["longest"] for r in rows.groupBy("strip").agg(F.max("squared").alias("longest")).collect()}
    # An empty strip is as long as the one after it; the strips' lengths never rise.
    longest = np.zeros(max(lengths, default=0) + 1)
    longest[list(lengths)] = np.sqrt(list(lengths.values()))
    longest = np.maximum.accumulate(longest[::-1])[::-1]
    top = rows.orderBy(F.desc("squared"), "id", "key").limit(HEAD).select("id", "v").toArrow()
    ids, null = _ids(top["id"])
    reach = _reach(Rotated(matrix(top["v"], d), turn), ids, null, turn, longest, k)
    queries = rows.filter(F.col("id") % every == 0).select("id", "v", "key").repartition(tasks, "key")
    queries = queries.mapInArrow(reach, "id long, v array<long>, key long, reach double, visits int")
    queries, n_queries = materialize_counted(queries)
    groups = max(1, -(-n_queries // (cell_queries or max(1, CELL_VALUES // d))))
    queries = queries.filter("visits > 0").withColumn("group", F.pmod(F.col("key"), F.lit(groups)).cast("int"))
    queries = queries.withColumn("strip", F.explode(F.sequence(F.lit(0), F.col("visits") - 1)))
    cells = rows.select("strip", "id", "v", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    found = cells.groupBy("strip", "group").cogroup(queries.groupBy("strip", "group")).applyInArrow(
        _cell(turn, k), "query_id long, key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op11_top_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP11_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {TOP}
"""
