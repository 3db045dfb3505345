"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are compared only inside buckets of masked fingerprints.  The
masks come from a linear code: bit ``i`` has the non-zero vector ``i % M + 1``
of ``radius + 1`` bits (``M = 2**(radius+1) - 1``) and mask ``v`` keeps the bits
whose vector has an odd inner product with ``v``.  The vectors of at most
``radius`` differing bits span less than the whole space, so some ``v`` is
orthogonal to all of them: that mask hides every difference and the pair meets
in its table.  No pair within the radius is lost.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import small_batches, small_or_shuffled, table, texts, without
from stratus.llm.graph import components
from stratus.operators.joins import materialize

SEED = 42
BITS = 64
#: Members a bucket may have before its comparison is split over several tasks.
BLOCK = 4096


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of a UTF-8 text's word shingles (repeats included), as an unsigned integer."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII white space characters
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words)))
    ends = [e + i for i, e in enumerate(ends)]
    starts = [0] + [e + 1 for e in ends[:-1]]
    last = ends[shingle - 1:] or ends[-1:]
    digest = xxhash.xxh64_digest
    counts, n = np.zeros(BITS, np.int64), len(last)
    for at in range(0, n, 1 << 16):
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + (1 << 16)], last[at:at + (1 << 16)])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, BITS)
        counts += bits.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprint_udf(shingle: int = 4):
    def run(batches):
        for text in batches:
            yield pa.array(np.array([fingerprint(t, shingle) for t in texts(text)], np.uint64).view(np.int64))

    return F.arrow_udf(run, "long", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint as a signed long; null and wordless texts have 0."""
    return small_batches(docs).select("doc_id", fingerprint_udf(shingle)(docs["text"]).alias("fp"))


def masks(radius: int = 4, bits: int = BITS) -> list[int]:
    """The covering masks as signed longs."""
    m = 2 ** (radius + 1) - 1
    out = []
    for v in range(1, m + 1):
        word = sum(1 << i for i in range(bits) if bin((i % m + 1) & v).count("1") % 2)
        out.append(word - (1 << bits) if word >> (bits - 1) else word)
    return out


def _links(radius: int):
    """Spanning links of each bucket: all its pairs are compared, linked parts are joined at once."""

    def forest(left: np.ndarray, right: np.ndarray):
        # Chain comparisons row by row; a pair inside one part adds nothing to the components.
        same = left is right
        part: dict[int, int] = {}

        def root(x):
            while part.get(x, x) != x:
                part[x] = part.get(part[x], part[x])
                x = part[x]
            return x

        rv = right.view(np.uint64)
        for i, x in enumerate(left.view(np.uint64)):
            near = right[i + 1:] if same else right
            dist = np.bitwise_count((rv[i + 1:] if same else rv) ^ x)
            a = int(left[i])
            for b in near[dist <= radius].tolist():
                ra, rb = root(a), root(b)
                if ra != rb:
                    part[max(ra, rb)] = min(ra, rb)
                    yield a, b

    def run(batches):
        for batch in batches:
            a, b = [], []
            for x, y in zip(batch.column("xs"), batch.column("ys")):
                xs = np.asarray(x.values, np.int64)
                ys = np.asarray(y.values, np.int64) if y.is_valid and len(y) else xs
                for p, q in forest(xs, ys):
                    a.append(p)
                    b.append(q)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def links(fps: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links that join every two distinct fingerprints at most ``radius`` bits apart.

    ``fps`` has distinct ``fp``.  Inside a bucket every pair is compared; of the
    links found, those that join what is already joined are left out.  A bucket
    of more than ``block`` members is cut into blocks and each pair of blocks is
    a row of its own, so no task or row holds a bucket whole.
    """
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for i, m in enumerate(masks(radius))])
    rows = fps.select("fp", F.inline(tables))
    hot = rows.groupBy("t", "key").count().filter(F.col("count") > block)
    hot = small_or_shuffled(hot.select("t", "key", F.ceil(F.col("count") / F.lit(block)).cast("int").alias("g")))
    cut = rows.join(hot, ["t", "key"], "left").withColumn("g", F.coalesce("g", F.lit(1)))
    cut = cut.withColumn("i", F.pmod(F.xxhash64("fp"), F.col("g")).cast("int"))
    # Block i takes part in the pairs (i, j >= i) as left and (j <= i, i) as right; in (i, i) once.
    pairs = F.when(F.col("g") == 1, F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("q")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("g") - 1),
                    lambda j: F.struct(F.least(F.col("i"), j).alias("p"), F.greatest(F.col("i"), j).alias("q"))))
    cut = cut.select("t", "key", "fp", "i", F.inline(pairs))
    grouped = (cut.groupBy("t", "key", "p", "q")
               .agg(F.collect_list(F.when(F.col("i") == F.col("p"), F.col("fp"))).alias("xs"),
                    F.collect_list(F.when(F.col("i") != F.col("p"), F.col("fp"))).alias("ys"))
               .filter(F.size("xs") + F.size("ys") > 1)
               .filter((F.col("p") == F.col("q")) | (F.size("xs") > 0) & (F.size("ys") > 0)))
    return grouped.select("xs", "ys").mapInArrow(_links(radius), "a long, b long").distinct()


def name_components(prints: DataFrame, radius: int = 4) -> DataFrame:
    """``(fp, component_id, component)`` for checkpointed ``(id, fp)`` rows; component is a fingerprint."""
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("least_id")))
    joined = components(links(classes.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = classes.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return small_or_shuffled(named.join(ids, "component").select("fp", "component_id", "component"))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``; component_id is the least doc_id reachable.

    Null and wordless texts have fingerprint 0 and link like any other.  A null
    doc_id keeps its row and never names a component unless all ids are null.
    Repeated rows keep their number.  An empty table gives an empty result.
    Columns besides doc_id and text are not read.
    """
    prints = materialize(fingerprints(docs, shingle).withColumnRenamed("doc_id", "id"))
    naming = name_components(prints, radius)
    return prints.join(naming, "fp").select(F.col("id").alias("doc_id"), "fp", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one document of each component: the least doc_id (null last), then the least text.

    Rows that repeat the kept document's id and text stay with it (they are the
    same document); all columns are kept as they are.
    """
    key = [F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), F.length(F.coalesce("text", F.lit(""))).alias("len")]
    prints = small_batches(docs).select(docs["doc_id"].alias("id"), docs["text"], fingerprint_udf(shingle)(docs["text"]).alias("fp"))
    prints = materialize(prints.select("id", "fp", *key))
    placed = prints.join(name_components(prints, radius).select("fp", "component"), "fp")
    rank = F.struct(F.col("id").isNull(), "id", "len", "hash")
    first = placed.groupBy("component").agg(F.min(rank).alias("first"))
    gone = (placed.join(small_or_shuffled(first), "component").filter(rank != F.col("first"))
            .select("id", F.col("hash").alias("fp"), "len"))
    return without(docs, gone)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
