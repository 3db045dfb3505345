"""Benchmark decontamination with suffix arrays over the training text.

Every shard (a block of documents inside a task) gets a suffix array of its
words, sparse in that it leaves out suffixes whose first words begin no
benchmark suffix.  All benchmark suffixes are binary-searched in it; hits are
extended to the longest verbatim matches with their locations.  The benchmark
travels to the shards in blocks of bounded size; documents are never shuffled.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import small_batches, table, text_blocks

WINDOW = 13
#: Benchmark text (bytes) sent to the executors at once; a larger benchmark goes in several blocks.
BLOCK_BYTES = 16 << 20

# A-Z to lower case; bytes that are no word characters become spaces.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

MATCH = "array<struct<item_id:long,item_start:int,doc_start:int,n_words:int>>"
RESULT = f"struct<n_words:long,hits:array<struct<start:int,stop:int>>,items:array<string>,matches:{MATCH}>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Windows:
    """The windows of a block of benchmark items as fixed-width, byte-ordered keys."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        split = [(i, words((t or "").encode())) for i, t in items]
        self.items = [(i, w) for i, w in split if w]
        self.window = window
        vocab: dict[bytes, int] = {}
        for _, w in self.items:
            for x in w:
                vocab.setdefault(x, len(vocab) + 1)
        self.vocab = vocab
        self.kind = ">u2" if len(vocab) < 65_535 else ">u4"
        rows, self.row, self.offset, size = [], [], [], []
        for r, (_, w) in enumerate(self.items):
            ids = [vocab[x] for x in w]
            n = min(window, len(ids))
            for o in range(len(ids) - n + 1):
                rows.append(ids[o:o + n] + [0] * (window - n))
                self.row.append(r)
                self.offset.append(o)
                size.append(n)
        self.row, self.offset = np.array(self.row, np.int64), np.array(self.offset, np.int64)
        self.size = np.array(size, np.int64)
        grid = np.array(rows, self.kind).reshape(-1, window)
        self.low = self.pack(grid)
        # The upper bound of a short item's range is its words followed by the largest ids.
        top = np.where(np.arange(window) < self.size[:, None], grid, np.iinfo(self.kind).max).astype(self.kind)
        self.high = self.pack(top)
        self.head = 2 if len(size) and min(size) > 1 else 1
        self.heads = np.unique(grid[:, 0].astype(np.int64) * (len(vocab) + 1) * (self.head == 2)
                               + grid[:, self.head - 1].astype(np.int64))

    def pack(self, grid: np.ndarray) -> np.ndarray:
        grid = np.ascontiguousarray(grid)
        return grid.view(f"S{grid.itemsize * self.window}").reshape(-1)


def suffix_array(ids: np.ndarray, test: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (first ``window`` words) and positions of the suffixes that may match."""
    at = np.flatnonzero(ids[:-test.window])
    code = ids[at].astype(np.int64)
    if test.head == 2:
        code = code * (len(test.vocab) + 1) + ids[at + 1]
    at = at[np.isin(code, test.heads)]
    keys = test.pack(ids[at[:, None] + np.arange(test.window)].astype(test.kind))
    order = np.argsort(keys, kind="stable")
    return keys[order], at[order]


def search(texts: list[bytes], test: Windows) -> list[tuple]:
    """Per text: word count, hit intervals, item ids found, longest matches."""
    lengths, tokens = [], []
    get = test.vocab.get
    for t in texts:
        w = words(t)
        lengths.append(len(w))
        tokens.append(np.fromiter(map(get, w, repeat(0)), np.int32, len(w)))
        tokens.append(np.zeros(1, np.int32))  # no match crosses from one text to the next
    ids = np.concatenate([*tokens, np.zeros(test.window, np.int32)])
    begin = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64) + 1)])
    out: list[list] = [[n, [], set(), []] for n in lengths]
    if not len(test.low):
        return [(n, [], [], []) for n in lengths]
    keys, at = suffix_array(ids, test)
    lo, hi = np.searchsorted(keys, test.low, "left"), np.searchsorted(keys, test.high, "right")
    n = hi - lo
    if not n.sum():
        return [(n, [], [], []) for n in lengths]
    which = np.repeat(np.arange(len(n)), n)
    place = at[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
    # Adjacent windows of one item at one distance are one verbatim match.
    row, offset = test.row[which], test.offset[which]
    order = np.lexsort((offset, place - offset, row))
    row, offset, place, size = row[order], offset[order], place[order], test.size[which][order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] - offset[1:] != place[:-1] - offset[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    for r, o, p, m in zip(row[first].tolist(), offset[first].tolist(), place[first].tolist(),
                          (offset[last] + size[last] - offset[first]).tolist()):
        d = int(np.searchsorted(begin, p, "right")) - 1
        item = test.items[r][0]
        p -= int(begin[d])
        out[d][1].append((p, p + m))
        if item is not None:
            out[d][2].add(str(item))
        out[d][3].append((item, o, p, m))
    return [(n, merged(h), sorted(i), sorted(m, key=lambda x: (x[2], x[0] is None, x[0] or 0, x[1]))) for n, h, i, m in out]


def merged(hits: list[tuple]) -> list[tuple]:
    out: list[tuple] = []
    for s, e in sorted(hits):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Lists of ``(item_id, text)``, each of bounded size."""
    rows = benchmark.select("item_id", "text").filter("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    for i in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [tuple(r) for r in part.distinct().collect()]


def _found(text, benchmark: DataFrame, window: int, block_bytes: int):
    """A column of RESULT for ``text``, one search per benchmark block, merged."""
    sc, cols = benchmark.sparkSession.sparkContext, []
    for items in _blocks(benchmark, block_bytes):
        sent = sc.broadcast(items)

        def run(batches, sent=sent):
            test = Windows(sent.value, window)
            for batch in batches:
                rows = [r for _, block in text_blocks(batch) for r in search(block, test)]
                names = ["n_words", "hits", "items", "matches"]
                fields = [dict(zip(names, (n, [dict(start=s, stop=e) for s, e in h], i,
                                           [dict(item_id=a, item_start=b, doc_start=c, n_words=d) for a, b, c, d in m])))
                          for n, h, i, m in rows]
                yield pa.array(fields, ARROW)

        cols.append(F.arrow_udf(run, RESULT, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()(text))
    if len(cols) == 1:
        return cols[0]

    def join(batches):
        for batch in batches:
            out = []
            for parts in batch.to_pylist():
                hits = merged([(h["start"], h["stop"]) for p in parts for h in p["hits"]])
                out.append(dict(n_words=parts[0]["n_words"], hits=[dict(start=s, stop=e) for s, e in hits],
                                items=sorted({i for p in parts for i in p["items"]}),
                                matches=[m for p in parts for m in p["matches"]]))
            yield pa.array(out, ARROW)

    return F.arrow_udf(join, RESULT, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()(F.array(*cols))


ARROW = pa.struct([
    ("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ("items", pa.list_(pa.string())),
    ("matches", pa.list_(pa.struct([("item_id", pa.int64()), ("item_start", pa.int32()), ("doc_start", pa.int32()),
                                    ("n_words", pa.int32())])))])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20,
                  block_bytes: int = BLOCK_BYTES, carry: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, items, matches, contaminated.

    A word is hit if it lies in any occurrence of ``window`` consecutive item
    words (of a whole item, if that is shorter).  Contaminated: some word is
    hit and ``share * n_hit >= n_words``.  A null text has no words; a null item
    text has no window; a null item_id hits words but is not listed in items.
    Repeated rows and items, and empty tables, need no care: rows stand alone.
    ``carry`` adds the whole input row as struct ``row``.
    """
    cols = [docs["doc_id"], _found(docs["text"], benchmark, window, block_bytes).alias("found")]
    if carry:
        cols.append(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    n_hit = F.aggregate("found.hits", F.lit(0).cast("long"), lambda a, h: a + (h["stop"] - h["start"]).cast("long"))
    out = small_batches(docs).select(*cols).withColumn("n_hit", n_hit)
    n_words = F.col("found.n_words")
    return out.select("doc_id", n_words.alias("n_words"), "n_hit", F.col("found.items").alias("items"),
                      F.col("found.matches").alias("matches"),
                      ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= n_words)).alias("contaminated"),
                      *(["row"] if carry else []))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without its contaminated rows; columns unchanged."""
    return contamination(docs, benchmark, carry=True, **options).filter(~F.col("contaminated")).select("row.*")


def op6_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), {WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM bw),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN win ON win.n = dw.n AND array_to_string(w[i:i + dw.n - 1], ' ') = k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
