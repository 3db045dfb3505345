"""Labelled rows for the trained operators: which may be learnt from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows no label may be learnt from: crc32(doc_id as text) mod 4 is 2. A null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_chars: int,
           balanced: bool = False) -> tuple[list[tuple[str, int]], float]:
    """``(text, label)`` of at most ``rows`` labelled documents that are not held out, and the share of label 1.

    The rows of least hash are taken, the same on every run; ``balanced`` takes
    as many of either label (the share is that of all).  Texts longer than
    ``max_chars`` are left out of training, so what reaches the driver is bounded.
    Documents whose labels disagree and null labels are left out.
    """
    may = labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    may = may.groupBy("doc_id").agg(F.min(label).alias("least"), F.max(label).alias("most")).filter("least = most")
    share = may.agg(F.avg("least")).first()[0] or 0.0
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [may.filter(F.col("least") == v).orderBy(*order).limit(rows // 2) for v in (0, 1)]
    may = parts[0].union(parts[1]) if balanced else may.orderBy(*order).limit(rows)
    may = F.broadcast(may.select("doc_id", F.col("least").alias("label")))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") <= max_chars)
    found = texts.join(may, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return [(r["text"], int(r["label"])) for r in sorted(found.collect(), key=lambda r: r["doc_id"])], float(share)
