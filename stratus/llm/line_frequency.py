"""Quality rules: per-document base figures and cross-document line frequency.

A line that occurs in more than ``max_docs`` distinct documents of one host is
boilerplate there and is removed; a document that loses more than
``max_removed`` of its words that way is depleted and rejected.  The host of a
row of ``documents`` is its source.  Documents of equal text are one document
for the count: exact copies alone make no line boilerplate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import small_batches, small_or_shuffled, table, texts
from stratus.operators.joins import materialize

MAX_DOCS = 20
MAX_REMOVED = 0.5
MIN_WORDS = 50

_SPACE = b" \t\n\r\x0b\x0c"
_NO_CHARS = _SPACE + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes
_SYMBOLS = b"#*$%&|<>"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ARROW = pa.struct([*((c, pa.int64()) for c in BASE), ("fp", pa.int64()),
                   ("lines", pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int64())])))])
RESULT = f"struct<{','.join(f'{c}:long' for c in BASE)},fp:long,lines:array<struct<hash:long,words:long>>>"


def normalised(line: bytes) -> bytes:
    """A-Z to lower case, runs of white space to one space, digits to 0."""
    return b" ".join(line.lower().split()).translate(_DIGITS)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return 0
    _, pair = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[window] > 1)
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[at + shift] = True
    return int(inside.sum())


def figures(text: bytes) -> dict:
    """Base figures of a text and its distinct normalised lines, each with the words it holds in all."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    totals: dict[int, int] = {}
    for x in lines:
        h = _signed(xxhash.xxh64_intdigest(normalised(x)))
        totals[h] = totals.get(h, 0) + len(x.split())
    return dict(n_words=len(words), word_chars=len(text.translate(None, _NO_CHARS)),
                n_symbols=len(text) - len(text.translate(None, _SYMBOLS)),
                n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=repeated_words(words),
                fp=_signed(xxhash.xxh64_intdigest(text)), lines=[dict(hash=h, words=n) for h, n in totals.items()])


def _figures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([figures(t) for t in texts(batch)], ARROW)


def line_quality(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, max_removed: float = MAX_REMOVED,
                 min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, base figures, base_failed, n_removed_lines, n_removed_words, depleted, kept.

    A null text has no words and no lines.  Rows of a null host share one
    host.  Rows that repeat a text on one host count as one document and get
    the same verdict; a null doc_id keeps its row.  Blank lines are not counted.
    An empty table gives an empty result; other columns are not read.
    """
    figured = F.arrow_udf(_figures, RESULT, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    rows = materialize(small_batches(docs).select("doc_id", docs[host].alias("host"), figured(docs["text"]).alias("f")))
    lines = rows.select("host", F.col("f.fp").alias("fp"), F.inline("f.lines"))
    # Distinct documents of a line: partial aggregation first, so a line of a third of all rows is no hot key.
    common = (lines.groupBy("host", "hash").agg(F.countDistinct("fp").alias("docs"))
              .filter(F.col("docs") > max_docs).select("host", "hash"))
    common = small_or_shuffled(common)
    hit = lines.join(common, lines["host"].eqNullSafe(common["host"]) & (lines["hash"] == common["hash"]))
    # One document's copies hold the same lines: take each line once.
    lost = (hit.groupBy(lines["host"], "fp", lines["hash"]).agg(F.max("words").alias("words"))
            .groupBy("host", "fp").agg(F.count("*").alias("n_lines"), F.sum("words").alias("n_lost")))
    lost = small_or_shuffled(lost)
    out = rows.join(lost, rows["host"].eqNullSafe(lost["host"]) & (F.col("f.fp") == lost["fp"]), "left")
    n, removed = F.col("f.n_words"), F.coalesce("n_lost", F.lit(0))
    failed = (n < min_words) | (100 * F.col("f.n_repeat_words") > 50 * n)
    depleted = removed > max_removed * n
    return out.select("doc_id", *[F.col(f"f.{c}").alias(c) for c in BASE], failed.alias("base_failed"),
                      F.coalesce("n_lines", F.lit(0)).alias("n_removed_lines"), removed.alias("n_removed_words"),
                      depleted.alias("depleted"), (~failed & ~depleted).alias("kept"))


def without_common_lines(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS) -> DataFrame:
    """``docs`` with the lines above the limit cut out of ``text`` (all other columns as they are)."""
    figured = F.arrow_udf(_figures, RESULT, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    lines = small_batches(docs).select(docs[host].alias("host"), figured(docs["text"]).alias("f")).select(
        "host", F.col("f.fp").alias("fp"), F.inline("f.lines"))
    common = small_or_shuffled(lines.groupBy("host", "hash").agg(F.countDistinct("fp").alias("docs"))
                               .filter(F.col("docs") > max_docs).select("host", "hash"))
    hit = lines.join(common, lines["host"].eqNullSafe(common["host"]) & (lines["hash"] == common["hash"]))
    lost = small_or_shuffled(hit.groupBy(lines["host"].alias("lost_host"), F.col("fp").alias("lost_fp"))
                             .agg(F.collect_set(lines["hash"]).alias("hashes")))

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, gone in batches:
            out = []
            for t, g in zip(text.to_pylist(), gone.to_pylist()):
                drop = set(g or ())
                out.append(t if t is None or not drop else "\n".join(
                    x for x in t.split("\n") if _signed(xxhash.xxh64_intdigest(normalised(x.encode()))) not in drop))
            yield pa.array(out, pa.string())

    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    fp = F.arrow_udf(_content_hash, "long", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    kept = docs.select(row, docs[host].alias("host"), fp(docs["text"]).alias("fp"))
    kept = kept.join(lost, kept["host"].eqNullSafe(lost["lost_host"]) & (F.col("fp") == F.col("lost_fp")), "left")
    cutter = F.arrow_udf(cut, "string", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    kept = kept.select("row", cutter("row.text", "hashes").alias("cut"))
    return kept.select(*[(F.col("cut") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _content_hash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([_signed(xxhash.xxh64_intdigest(t)) for t in texts(batch)], pa.int64())


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", *BASE, "base_failed", "n_removed_lines", "n_removed_words", "kept")


OP1_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
tri AS (SELECT doc_id, i, w[i:i + 2] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri) WHERE c > 1) GROUP BY 1),
l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         regexp_replace(array_to_string(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' '), '[1-9]', '0', 'g') AS norm
       FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln GROUP BY 1),
common AS (SELECT source, norm FROM ln GROUP BY 1, 2 HAVING count(DISTINCT text) > {MAX_DOCS}),
lost AS (SELECT doc_id, count(DISTINCT ln.norm) AS n_lines, sum(words) AS n_lost
         FROM ln JOIN common ON common.norm = ln.norm AND common.source IS NOT DISTINCT FROM ln.source GROUP BY 1),
f AS (SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_lines, 0) AS n_removed_lines, CAST(coalesce(n_lost, 0) AS BIGINT) AS n_removed_words
      FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND NOT n_removed_words > {MAX_REMOVED} * n_words AS kept
FROM f
"""
