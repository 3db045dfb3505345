"""Mixing sources to target weights, in fixed-length blocks of words.

1. Every source's documents, in a pseudorandom order, form one stream of words,
   cut into blocks of ``block`` words (the last one may be shorter).
2. A source's slots (block draws) are dealt to the output shards by
   multinomial draws, shard after shard, without overdrawing a source.
3. Slot ``j`` of a source stands for place ``j mod n`` of epoch ``j div n``; a keyed
   permutation of ``[0, n)`` per epoch maps it to a block, so within an epoch
   every block comes once.
4. Blocks are joined to the slots by (source, index).

Nothing but one row per source, and one number per shard and source, is held
on the driver; documents are never ordered in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratus.llm.common import byte_blocks, packed, small_batches, small_or_shuffled, table, tidy, unpacked
from stratus.operators.joins import materialize
from stratus.session import scratch_path

BLOCK = 128
MAX_EPOCHS = 3
SEED = 8
#: Words an output shard should hold; the number of shards follows from the total.
SHARD_WORDS = 1 << 26
MIN_SHARDS = 8
#: Rows that one task orders when it numbers the documents of a source.
BUCKET_ROWS = 2_000
#: Sources are a dimension of the corpus; more than these are refused rather than held on the driver.
MAX_SOURCES = 1_000_000

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], max_epochs: int = MAX_EPOCHS) -> list[float]:
    """Words to take of each source: shares by weight, capped at ``max_epochs`` sizes, the excess reshared.

    If every source is at its cap the targets sum to less than all sizes.
    """
    size, weight = np.array(sizes, float), np.array(weights, float)
    out, free, left = np.zeros(len(size)), np.ones(len(size), bool), size.sum()
    while free.any():
        share = left * weight / weight[free].sum()
        over = free & (share > max_epochs * size)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = max_epochs * size[over]
        left -= out[over].sum()
        free &= ~over
    return out.tolist()


def default_weights(n: int) -> list[float]:
    return [float(i % 3 + 1) for i in range(n)]


def deal(slots: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """``(shards, sources)`` slot counts: a multinomial draw per shard from the slots still left.

    A draw beyond what a source has left is cut back and made up from sources
    with slots left, so every slot is dealt exactly once and shards are even.
    """
    rng, left = np.random.default_rng(seed), slots.astype(np.int64).copy()
    out = np.zeros((shards, len(slots)), np.int64)
    for k in range(shards):
        want = -(-int(left.sum()) // (shards - k))
        while want > 0:
            draw = np.minimum(rng.multinomial(want, left / left.sum()), left)
            out[k] += draw
            left -= draw
            want -= int(draw.sum())
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of ``[0, n)`` at each index: a four-round Feistel network with cycle walking."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))) / 2).astype(np.int64))
    half = np.where(np.int64(1) << (2 * half) < n, half + 1, half).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    x, todo = index.astype(np.uint64), np.ones(len(index), bool)
    while todo.any():
        h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = x[todo] >> h, x[todo] & m
        for r in range(4):
            f = (right + k + np.uint64(0x9E3779B97F4A7C15 * (r + 1) % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
            f = (f ^ (f >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
            left, right = right, left ^ ((f >> np.uint64(29)) & m)
        x[todo] = left << h | right
        todo &= x >= n.astype(np.uint64)
    return x.astype(np.int64)


def _udf(run, kind: str):
    return F.arrow_udf(tidy(run), kind, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def _pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for text in batches:
        null = text.is_null().to_pylist()
        at, out = 0, []
        for _, block in byte_blocks(text):
            out += [None if no else packed(t) for no, t in zip(null[at:], block)]
            at += len(block)
        yield pa.array(out, pa.binary())


def _unpack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for data in batches:
        yield pa.array([None if x is None else unpacked(x) for x in data.to_pylist()], pa.binary()).cast(pa.string())


@dataclass
class Mix:
    documents: DataFrame  #: doc_id, text (and packed) if asked for, source, src, size, row, start (first word in the source's stream)
    sources: DataFrame  #: src, source_size, target, n_blocks
    slots: DataFrame  #: shard, src, slot, epoch, block
    block: int
    placed: DataFrame  #: documents without their text


def mix(docs: DataFrame, weights: list[float] | None = None, block: int = BLOCK, seed: int = SEED,
        text: bool = False) -> Mix:
    """Plan of the mix; ``taken`` and ``shards`` read it.

    A null text has size 0 and is never taken; a null source is a source of its
    own, last in order.  Repeated rows and a null doc_id are documents like any
    other.  An empty table gives an empty plan.  ``weights`` are by source in
    code point order.  Reruns agree.
    """
    spark = docs.sparkSession
    key = F.xxhash64(F.lit(seed), "doc_id", F.coalesce(docs["text"], F.lit("")))
    base = docs.select("doc_id", "source", word_count(docs["text"]).alias("size"), key.alias("key"))
    base = materialize(base)
    per = base.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    per = per.limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per = sorted(per, key=lambda r: (r["source"] is None, r["source"] or ""))
    size = [r["size"] for r in per]
    target = targets(size, weights or default_weights(len(per)))
    n_blocks = [-(-s // block) for s in size]
    # Whole epochs first; what is left of the target in blocks of the source's mean length.
    slots = []
    for s, t, n in zip(size, target, n_blocks):
        whole = int(t // s) if s else 0
        slots.append(min(whole * n + round((t - whole * s) / s * n), MAX_EPOCHS * n) if s else 0)
    src = spark.createDataFrame(
        [(i, r["source"], s, float(t), n, -(-r["rows"] // BUCKET_ROWS))
         for i, (r, s, t, n) in enumerate(zip(per, size, target, n_blocks))],
        "src int, name string, source_size long, target double, n_blocks long, buckets long")
    src = small_or_shuffled(src)
    placed = base.join(src, base["source"].eqNullSafe(src["name"]))
    placed = placed.withColumn("bucket", F.pmod(F.shiftrightunsigned("key", 1), F.col("buckets")))
    # Start of a document in its source's stream: words of earlier buckets plus those before it in its bucket.
    sums = placed.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("src").orderBy("bucket")) - F.col("words")
    sums = small_or_shuffled(sums.select("src", "bucket", before.alias("before")))
    order = Window.partitionBy("src", "bucket").orderBy("key", "doc_id", "size")
    running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = (placed.withColumn("row", F.row_number().over(order)).withColumn("running", running)
              .join(sums, ["src", "bucket"]))
    placed = placed.select("doc_id", "source", "src", "size", "bucket", "row", "key",
                           (F.col("before") + F.col("running")).alias("start"))
    documents = placed
    if text:  # rows of equal key are copies of one another, so any one text will do; it is shuffled packed
        words = small_batches(docs).select(key.alias("key"), _udf(_pack, "binary")("text").alias("packed"))
        words = words.groupBy("key").agg(F.first("packed").alias("packed"))
        documents = placed.join(words.hint("merge"), "key").withColumn("text", _udf(_unpack, "string")("packed"))
    return Mix(documents, src.select("src", "source_size", "target", "n_blocks"),
               _slots(spark, np.array(slots, np.int64), n_blocks, sum(size), seed), block, placed)


def _slots(spark: SparkSession, slots: np.ndarray, n_blocks: list[int], total: int, seed: int) -> DataFrame:
    shards = max(MIN_SHARDS, total // SHARD_WORDS)
    counts = deal(slots, shards, seed)
    first = np.cumsum(counts, axis=0) - counts
    at = np.nonzero(counts)
    dealt = pa.table({"shard": pa.array(at[0], pa.int64()), "src": pa.array(at[1], pa.int32()),
                      "first": pa.array(first[at], pa.int64()), "n": pa.array(counts[at], pa.int64()),
                      "n_blocks": pa.array(np.array(n_blocks, np.int64)[at[1]], pa.int64())})
    piece = 1 << 16  # a shard's slots of one source, in pieces that spread over tasks
    rows = (spark.createDataFrame(dealt)
            .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {piece}"))))
            .select("shard", "src", "n_blocks", (F.col("first") + F.col("piece") * piece).alias("first"),
                    F.least(F.lit(piece), F.col("n") - F.col("piece") * piece).alias("n")))
    rows = rows.withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))

    def block_of(batches: Iterator[tuple]) -> Iterator[pa.Array]:
        for src, slot, n in batches:
            s, j, n = (np.asarray(x, np.int64) for x in (src, slot, n))
            key = (s * 1_000_003 + j // n) * 97 + seed
            yield pa.array(permuted(j % n, n, key), pa.int64())

    place = F.arrow_udf(block_of, "long", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    return rows.select("shard", "src", "slot", F.expr("slot div n_blocks").alias("epoch"),
                       place("src", "slot", "n_blocks").alias("block"))


def _pieces(plan: Mix) -> DataFrame:
    """Documents cut at block borders: one row for each document and block, with the words it has there."""
    b = plan.block
    first, last = F.expr(f"start div {b}"), F.expr(f"(start + size - 1) div {b}")
    cut = plan.placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    begin = F.greatest(F.col("start"), F.col("block") * b)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b)
    return cut.withColumn("skip", begin - F.col("start")).withColumn("words", F.coalesce(end - begin, F.lit(0)))


_PIECES = "array<struct<block: long, part: string>>"


def _cut(plan: Mix) -> DataFrame:
    """Texts cut at block borders in one pass each: src, bucket, row, start, block, part; without words, no row."""
    block, found = plan.block, re.compile(WORD)

    def cut(batches: Iterator[tuple]) -> Iterator[pa.Array]:
        for data, start in batches:
            out = []
            for x, at in zip(data.to_pylist(), start.to_pylist()):
                words, parts = found.findall("" if x is None else unpacked(x).decode()), []
                first = 0
                while first < len(words):
                    index = (at + first) // block
                    last = min(len(words), (index + 1) * block - at)
                    parts.append({"block": index, "part": " ".join(words[first:last])})
                    first = last
                out.append(parts)
            yield pa.array(out, pa.list_(pa.struct([("block", pa.int64()), ("part", pa.string())])))

    parts = _udf(cut, _PIECES)
    small_batches(plan.documents)
    rows = plan.documents.select("src", "bucket", "row", "start", F.explode(parts("packed", "start")).alias("piece"))
    return rows.select("src", "bucket", "row", "start", "piece.block", "piece.part")


def blocks(plan: Mix) -> DataFrame:
    """The packed blocks: src, block, text (its words joined by spaces), parts (bucket, row and words of each document in it).

    The plan must have been made with ``text=True``.
    """
    part = F.struct("start", "part", "bucket", "row", word_count(F.col("part")).alias("words"))
    packed = _cut(plan).groupBy("src", "block").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return packed.select("src", "block", F.array_join(F.transform("parts", lambda p: p["part"]), " ").alias("text"),
                         F.transform("parts", lambda p: F.struct(p["bucket"].alias("bucket"), p["row"].alias("row"),
                                                                 p["words"].alias("words"))).alias("parts"))


def shards(plan: Mix) -> DataFrame:
    """The output blocks: shard, src, slot, block, text, parts.

    The plan must have been made with ``text=True``.
    """
    # Neither side is bounded: a merge join, whatever sizes Spark estimates.
    return plan.slots.join(blocks(plan).hint("merge"), ["src", "block"]).select("shard", "src", "slot", "block", "text", "parts")


def taken(plan: Mix, packed: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, taken.

    ``packed``, the output blocks of ``shards``, are what is counted; without them, the positions of the plan.
    """
    if packed is None:
        times = plan.slots.groupBy("src", "block").agg(F.count("*").alias("times"))
        drawn = _pieces(plan).join(times.hint("merge"), ["src", "block"]).select("src", "bucket", "row", (F.col("words") * F.col("times")).alias("words"))
    else:
        drawn = packed.select("src", F.explode("parts").alias("p")).select("src", "p.bucket", "p.row", "p.words")
    drawn = drawn.groupBy("src", "bucket", "row").agg(F.sum("words").alias("taken"))
    per = plan.placed.join(drawn.hint("merge"), ["src", "bucket", "row"], "left")
    return per.join(plan.sources, "src").select(
        "doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def pack(docs: DataFrame) -> DataFrame:
    """``taken`` of the default mix, from the output blocks, which are written to the shared folder first."""
    plan = mix(docs, text=True)
    path = scratch_path(docs.sparkSession, "mixed")
    shards(plan).write.option("compression", "zstd").parquet(path)
    return taken(plan, docs.sparkSession.read.parquet(path))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
