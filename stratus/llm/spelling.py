"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

1. Words are counted over all texts (one counter per block of text, then a sum).
2. A blocked Bloom filter per word length: a word sets bits in two 64-bit blocks.
   The filters are built in slices by the tasks and broadcast; together they
   hold at most ``FILTER_BYTES``, beyond that one segment of the words after the
   other is filtered.
3. Every word generates its deletions (probed against the words one shorter) and
   its replacements by larger letters (against those of its length): each pair
   of near words is met from one of its ends, so no pair is met twice.
4. Only positives are shuffled, to a join with the vocabulary that is exact.
5. A word's form is its most frequent near word, if that is frequent enough;
   roots follow the forms by doubling steps.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import small_batches, table
from stratus.operators.joins import materialize, materialize_counted

RUN = r"[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
ALTER = 31
#: Bytes of the broadcast filters together; more words are probed for in several passes.
FILTER_BYTES = 64 << 20
BITS_PER_WORD = 24
#: Blocks (of 8 bytes) of a filter that one task builds.
SLICE = 1 << 15
#: Words that a task generates edits of, and edits it holds at once.
TASK_WORDS = 20_000
EDITS = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MIX = [np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0xD6E8FEB86659FD93)]


def altered(word: str, doc_id: int | None, every: int = ALTER) -> str:
    """The word as the count takes it: one letter less where the crc32 of its place says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    return word if h % every else word[:h % len(word)] + word[h % len(word) + 1:]


def lower(word: str) -> str:
    return word.encode().lower().decode()  # bytes: A-Z only


def _counter(least: int, alter: int):
    # A run loses at most one letter, so a shorter run never becomes a word.
    run_of = re.compile(f"{RUN[:-1]}{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text")
            known, size = Counter(), 0

            def flush():
                return pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array(list(known.values()), pa.int64())], ["word", "n"])

            for i, doc in enumerate(ids):
                text = texts[i].as_py() or ""
                for word, n in Counter(map(lower, run_of.findall(text))).items():
                    word = altered(word, doc, alter)
                    if len(word) >= least:
                        known[word] += n
                size += len(text)
                if size > 8 << 20:
                    yield flush()
                    known, size = Counter(), 0
            if known:
                yield flush()

    return run


def vocabulary(docs: DataFrame, least: int = MIN_LENGTH, count: int = MIN_COUNT, alter: int = ALTER) -> DataFrame:
    """``(word, n)``: the words of at least ``least`` letters that occur ``count`` times or more."""
    rows = small_batches(docs).select(docs["doc_id"].alias("id"), docs["text"].alias("text"))
    words = rows.mapInArrow(_counter(least, alter), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


def _finish(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[salt % 3] + np.uint64(salt)
    h = (h ^ (h >> np.uint64(29))) * _MIX[(salt + 1) % 3]
    return h ^ (h >> np.uint64(32))


def powers(length: int) -> np.ndarray:
    """``_BASE ** (length - 1 - i)`` for every place i of a word."""
    out = np.full(length, _BASE, np.uint64)
    out[-1:] = 1
    return np.cumprod(out[::-1])[::-1] if length else out


def codes(words: list[str]) -> np.ndarray:
    """Code points of words of equal length, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def hashes(points: np.ndarray) -> np.ndarray:
    return (points.astype(np.uint64) * powers(points.shape[1])).sum(1, dtype=np.uint64)


def places(h: np.ndarray, blocks: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number and the three bits set in it, for hashes of words."""
    x = _finish(h, salt)
    one = np.uint64(1)
    bits = one << (x & np.uint64(63)) | one << (x >> np.uint64(6) & np.uint64(63)) | one << (x >> np.uint64(12) & np.uint64(63))
    return ((x >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), bits


def segment_of(h: np.ndarray, segments: int) -> np.ndarray:
    return (_finish(h, 7) >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """``(length, indices)`` of a list of words."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(size).tolist():
        yield length, np.flatnonzero(size == length)


class Filters:
    """One blocked Bloom filter per word length, in one array; ``shards`` maps a length to (first block, blocks)."""

    def __init__(self, shards: dict[int, tuple[int, int]], data: np.ndarray):
        self.shards, self.data = shards, data

    def holds(self, h: np.ndarray, length: int) -> np.ndarray:
        """Indices of the hashes that may be words of this length: no word is missed."""
        first, blocks = self.shards[length]
        data, left = self.data[first:first + blocks], np.arange(len(h))
        for salt in (0, 1):
            at, bits = places(h[left], blocks, salt)
            left = left[data[at] & bits == bits]
        return left


def _bits(shards: dict[int, tuple[int, int]], segment: int, segments: int):
    """Words to (slice, block, bits) rows of their filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for length, index in by_length(words):
                h = hashes(codes([words[i] for i in index]))
                h = h[segment_of(h, segments) == segment]
                first, blocks = shards[length]
                for salt in (0, 1):
                    at, bits = places(h, blocks, salt)
                    yield pa.RecordBatch.from_arrays([pa.array((at + first) // SLICE), pa.array((at + first) % SLICE), pa.array(bits.view(np.int64))],
                                                     ["slice", "block", "bits"])

    return run


def _slice(rows: pa.Table) -> pa.Table:
    data = np.zeros(SLICE, np.uint64)
    np.bitwise_or.at(data, rows["block"].to_numpy(), rows["bits"].to_numpy().view(np.uint64))
    return pa.table({"slice": rows["slice"][:1], "data": pa.array([data.tobytes()], pa.binary())})


def build(words: DataFrame, counts: dict[int, int], segment: int = 0, segments: int = 1) -> Filters:
    """The filters of one segment of the words; ``counts`` are the words of every length."""
    shards, at = {}, 0
    for length, n in sorted(counts.items()):
        blocks = max(8, -(-n * BITS_PER_WORD // segments // 64))
        shards[length] = (at, blocks)
        at += blocks
    data = np.zeros(-(-at // SLICE) * SLICE, np.uint64)
    rows = words.select("word").mapInArrow(_bits(shards, segment, segments), "slice long, block long, bits long")
    rows = rows.groupBy("slice", "block").agg(F.bit_or("bits").alias("bits"))
    for r in rows.groupBy("slice").applyInArrow(_slice, "slice long, data binary").toLocalIterator():
        data[r["slice"] * SLICE:(r["slice"] + 1) * SLICE] = np.frombuffer(r["data"], np.uint64)
    return Filters(shards, data)


def edits(points: np.ndarray, letters: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positive edits of words of one length: (word, place, letter); letter 0 is a deletion.

    Of a run of equal letters the first one is deleted; replacements are by larger letters.
    """
    n, length = points.shape
    base, p = points.astype(np.uint64), powers(length)
    terms = base * p
    whole = terms.sum(1, dtype=np.uint64)
    if length - 1 in filters.shards:
        # A deletion at i: what is before i moves one place down (its powers lose a factor), what is behind stays.
        before = np.cumsum(base[:, :-1] * p[1:], 1, dtype=np.uint64)
        before = np.append(np.zeros((n, 1), np.uint64), before, 1)
        behind = whole[:, None] - np.cumsum(terms, 1, dtype=np.uint64)
        first = np.append(np.ones((n, 1), bool), points[:, 1:] != points[:, :-1], 1)
        word, place = np.nonzero(first)
        found = filters.holds((before + behind)[word, place], length - 1)
        yield word[found], place[found], np.zeros(len(found), np.uint32)
    if length in filters.shards and len(letters) > 1:
        step = max(1, EDITS // (n * len(letters)))
        for at in range(0, length, step):
            old = base[:, at:at + step, None]
            word, place, letter = np.nonzero(letters[None, None, :] > old)
            h = whole[word] + (letters[letter] - old[word, place, 0]) * p[at + place]
            found = filters.holds(h, length)
            yield word[found], place[found] + at, letters[letter[found]].astype(np.uint32)


def _probe(shared, letters: dict[int, list[int]]):
    """Words (word, n) to positives (candidate, word, n); ``shared`` is a broadcast of the fields of ``Filters``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(*shared.value)
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for length, index in by_length(words):
                signs = np.array(letters.get(length, []), np.uint64)
                step = max(1, EDITS // (length * max(1, len(signs))))
                for at in range(0, len(index), step):
                    part = index[at:at + step]
                    some = [words[i] for i in part]
                    for word, place, letter in edits(codes(some), signs, filters):
                        out = [some[w][:i] + (chr(c) if c else "") + some[w][i + 1:]
                               for w, i, c in zip(word.tolist(), place.tolist(), letter.tolist())]
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array([some[w] for w in word.tolist()], pa.string()),
                                                          pa.array(counts[part[word]])], ["candidate", "word", "n"])

    return run


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        for length, index in by_length(words):
            some = codes([words[i] for i in index])
            signs = np.unique(some).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(signs), length, np.int32)), pa.array(signs),
                                              pa.array(np.where(np.arange(len(signs)) == 0, len(some), 0))], ["length", "letter", "n"])


def near_pairs(words: DataFrame, n_words: int, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``(word, near, n_near)``: both directions of every pair of words one edit apart; ``words`` is checkpointed (word, n)."""
    spark = words.sparkSession
    # Word lengths and their letters: at most 90 letters a length.
    known = words.select("word").mapInArrow(_letters, "length int, letter int, n long")
    known = known.groupBy("length", "letter").agg(F.sum("n").alias("n")).collect()
    counts, letters = Counter(), {}
    for r in known:
        counts[r["length"]] += r["n"]
        letters.setdefault(r["length"], []).append(r["letter"])
    segments = max(1, -(-n_words * BITS_PER_WORD // 8 // filter_bytes))
    pairs = []
    for segment in range(segments):
        built = build(words, counts, segment, segments)
        shared = spark.sparkContext.broadcast((built.shards, built.data))
        positives = words.mapInArrow(_probe(shared, letters), "candidate string, word string, n long")
        exact = positives.join(words.select(F.col("word").alias("candidate"), F.col("n").alias("n_candidate")).hint("shuffle_hash"), "candidate")
        pairs.append(materialize(exact))
        shared.unpersist()
    both = F.array(F.struct("word", F.col("candidate").alias("near"), F.col("n_candidate").alias("n_near")),
                   F.struct(F.col("candidate").alias("word"), F.col("word").alias("near"), F.col("n").alias("n_near")))
    found = pairs[0]
    for more in pairs[1:]:
        found = found.union(more)
    found = found.select(F.inline(both))
    # A false positive of one segment's filter may be a word of another segment.
    return found.distinct() if segments > 1 else found


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``: the end of the forms' chain, by doubling steps.

    A form is more frequent than its word, so chains end; their length grows
    with the logarithm of the largest count.
    """
    now, n = materialize_counted(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while n:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialize(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        n = now.filter("moved").count()
    return now.select("word", "root")


def variants(docs: DataFrame, least: int = MIN_LENGTH, count: int = MIN_COUNT, ratio: int = RATIO, alter: int = ALTER,
             filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    Words are maximal runs of Latin letters of whole texts, A-Z lower-cased,
    some with a letter deleted by ``altered``; those of ``least`` letters and
    ``count`` occurrences or more.  A null text has none; a null doc_id counts
    as the empty text in ``altered``; rows that repeat are each counted.  Of
    equally frequent near words the smallest in code point order is the form.
    An empty table gives no rows; columns besides doc_id and text are not read.
    """
    spark = docs.sparkSession
    words, n_words = materialize_counted(vocabulary(docs, least, count, alter))
    # Tasks by words, not by bytes: the edits are generated from few bytes.
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_words // TASK_WORDS))
    words = materialize(words.repartition(tasks, "word"))
    pairs = near_pairs(words, n_words, filter_bytes)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_near")).alias("less"), "near")).alias("best"))
    placed = words.join(best, "word", "left")
    enough: Column = -F.col("best.less") >= ratio * F.col("n")
    placed = materialize(placed.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                       F.when(enough, F.col("best.near")).alias("form"),
                                       F.when(enough, -F.col("best.less")).alias("form_n")))
    ends = roots(placed.filter(F.col("form").isNotNull()))
    return placed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[a-z\x{{C0}}-\x{{FF}}]{{{MIN_LENGTH},}}')) AS run FROM documents),
g AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS place, count(*) AS n FROM r GROUP BY 1, 2),
x AS (SELECT run, n, hex(encode(place)) AS x FROM g),
b AS (SELECT run, n, list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)) AS b FROM x),
h AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], b), lambda c, v: xor(c >> 8, step[(xor(c, v) & 255) + 1])), 4294967295) AS h FROM b, crc),
a AS (SELECT n, CASE WHEN h % {ALTER} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM a WHERE length(word) >= {MIN_LENGTH} GROUP BY 1 HAVING sum(n) >= {MIN_COUNT}),
i AS (SELECT word, n, length(word) AS l, unnest(range(1, length(word) + 1)) AS i FROM v),
d AS (SELECT word, n, l, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM i),
p AS (SELECT p.word, q.word AS near, q.n FROM d p JOIN d q ON p.i = q.i AND p.l = q.l AND p.rest = q.rest AND p.word <> q.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON v.word = d.rest
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON v.word = d.rest),
s AS (SELECT word, count(*) AS n_near, arg_min(near, struct_pack(a := -n, b := near)) AS near, max(n) AS most FROM p GROUP BY 1),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {RATIO} * v.n THEN near END AS form,
        CASE WHEN most >= {RATIO} * v.n THEN most END AS form_n FROM v LEFT JOIN s USING (word)),
c AS (SELECT word, word AS at FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL),
e AS (SELECT c.word, c.at AS root FROM c JOIN f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN e USING (word)
"""
