"""Quality classifier: supervised subword embeddings.

A document is the mean of the learnt vectors of its hashed words, word pairs and
character 3- to 5-grams; a softmax layer on the mean gives the label.  The model is
trained in numpy by stochastic gradient descent on a bounded sample.  For scoring,
vectors and output layer are multiplied once into one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import small_batches, table, text_blocks
from stratus.llm.labels import held_out, sample

#: Labelled documents learnt from at most, and the longest of them in characters.
TRAIN_ROWS = 4000
TRAIN_CHARS = 40_000
BUCKETS_LOG2 = 18
DIMENSION = 8
EPOCHS = 6
RATE = 20.0
THRESHOLD = 0.7

_M = np.uint32(0x01000193)
_POWERS = np.array([pow(0x2C1B3C6D, i, 1 << 32) for i in range(64)], np.uint32)


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint32(salt)) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h >> np.uint32(32 - BUCKETS_LOG2)


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(document, bucket)`` arrays of the hashed n-grams of a block of texts, one pair per kind of n-gram.

    Character n-grams lie within a word, the white space before and after it
    included.  A word pair is hashed symmetrically, so equal neighbours fall in one bucket.
    """
    split = [t.split() for t in texts]
    flat = b" " + b" \n ".join(b" ".join(w) for w in split) + b" "
    c = np.frombuffer(flat, np.uint8)
    break_ = c <= 32
    doc = np.cumsum(c == 10, dtype=np.int32)
    inner = np.cumsum(break_, dtype=np.int32)
    c = c.astype(np.uint32)
    h = c
    for n in range(2, 6):
        h = h[:-1] * _M + c[n - 1:]
        if n > 2:
            whole = inner[n - 2:len(h) + n - 2] == inner[:len(h)]  # no white space inside
            at = np.flatnonzero(whole & ~(break_[:len(h)] & break_[n - 1:]))
            yield doc[at], _bucket(h[at], n)
    start = np.flatnonzero(~break_[1:] & break_[:-1]) + 1
    if not len(start):
        return
    length = np.diff(np.append(start, len(c)))
    place = np.arange(start[0], len(c), dtype=np.int64) - np.repeat(start, length)
    letter = np.where(break_[start[0]:], np.uint32(0), c[start[0]:]) * _POWERS[place & 63]
    word = np.add.reduceat(letter, start - start[0], dtype=np.uint32)
    yield doc[start], _bucket(word, 11)
    pair = np.flatnonzero(doc[start[1:]] == doc[start[:-1]])
    yield doc[start[1:]][pair], _bucket(word[1:][pair] ^ word[:-1][pair], 12)


def train(rows: list[tuple[str, int]], seed: int = 7) -> tuple[np.ndarray, float]:
    """``(score per bucket, bias)`` learnt from labelled texts; with one label or none, a constant."""
    y = np.array([l for _, l in rows], np.int64)
    size = 1 << BUCKETS_LOG2
    if len(set(y.tolist())) < 2:
        return np.zeros(size, np.float32), 0.0 if not len(y) else 4.0 * (2 * float(y[0]) - 1)
    grams = []
    for text, _ in rows:
        ids = [b for _, b in features([text.encode()])]
        ids, n = np.unique(np.concatenate(ids), return_counts=True) if ids else (np.zeros(0, np.uint32), np.zeros(0))
        grams.append((ids.astype(np.int64), (n / max(1, n.sum())).astype(np.float32)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (size, DIMENSION)).astype(np.float32) / DIMENSION
    out, bias = np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(rows)):
            ids, w = grams[i]
            hidden = w @ vectors[ids]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= rate * 0.05 * np.outer(hidden, p)
            bias -= 0.02 * p
            vectors[ids] -= rate * w[:, None] * back
    side = out[:, 1] - out[:, 0]
    return vectors @ side, float(bias[1] - bias[0])


def score_texts(texts: list[bytes], table: np.ndarray, bias: float) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for doc, bucket in features(texts):
        total += np.bincount(doc, table[bucket], len(texts))
        count += np.bincount(doc, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -30, 30)))


def scorer(docs: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS):
    """A column function text -> score in 0..1, learnt from the labelled documents that are not held out."""
    small_batches(docs)
    model = docs.sparkSession.sparkContext.broadcast(train(sample(docs, labels, label, train_rows, TRAIN_CHARS)[0]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias = model.value
        for batch in batches:
            out = [score_texts(block, weights, bias) for _, block in text_blocks(batch, 4 << 20)]
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return F.arrow_udf(run, "double", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD,
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    A null or wordless text scores by the bias alone.  Without labels, or with
    labels of one kind only, the score is constant.  Rows stand alone, so repeats
    and null ids need no care; a null doc_id is not held out, and never learnt
    from.  Columns besides doc_id and text are not read.
    """
    score = scorer(docs, labels, label, train_rows)
    out = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), score(docs["text"]).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
