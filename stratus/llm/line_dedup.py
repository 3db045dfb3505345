"""Fuzzy line dedup by MinHash.

1. One pass over the text: every distinct normalised line of a block gets a
   MinHash signature of its character shingles; each band of the signature is a
   bucket key.  Lines of a block that share a bucket are linked to the least of
   them at once, so a bucket sends one row per block and no key gets hot.
2. A shuffle of those least lines alone, in arrays by ranges of keys, links them
   to the bucket's least.
3. Linked pairs are verified by the exact Jaccard similarity of their shingles.
   Only lines that some bucket links are read again; a filter of their hashes
   keeps the others out of the shuffle.  In buckets of three or more lines in
   which a pair fails, all lines of different parts are compared, by counting the
   shingles that an inverted index of the group finds in common.
4. Connected components; each keeps its first line by (doc_id, line number).

A line is known by the 128-bit hash of its normalised text, a row of documents
by that of its doc_id and text.  Buckets hold the first 64 bits only: lines that
agree in them are told apart before they are compared.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import BROADCAST_ROWS, byte_blocks, number_batches, packed, small_batches, small_or_shuffled, table, tidy, unpacked
from stratus.llm.graph import components
from stratus.operators.joins import materialize, materialize_counted
from stratus.session import scratch_path

SHINGLE = 9
BANDS, ROWS = 12, 4  # a pair of similarity 0.8 meets in some band with probability 0.998, one of 0.9 with 0.99999
SIMILARITY = 0.8
#: Lines of a bucket compared in one group; a larger bucket is cut into blocks.
GROUP = 512
#: Bytes of text that a worker holds as lines at a time.
BLOCK_BYTES = 8 << 20

#: Bytes of line text in a block of a group, and of the filter that a second reading of the texts goes by.
GROUP_BYTES = 16 << 20
FILTER_BYTES = 32 << 20
BITS_PER_LINE = 24

#: Bucket keys are shuffled in arrays by their first bits, and linked so many at a time (a range of keys at least).
RANGE_BITS = 12
KEYS = 1 << 19

# Rows of the text pass: a place of a line; a document and its number of lines; a line that is
# the least of its block in the buckets ``keys``; a pair (hi, lo) of lines of one bucket.
PLACE, DOC, LEAST, PAIR = range(4)
ROW = "kind int, hi long, lo long, row struct<hi:long,lo:long>, doc_id long, n long, keys array<long>"
_ID = pa.struct([("hi", pa.int64()), ("lo", pa.int64())])
_NAMES = ["kind", "hi", "lo", "row", "doc_id", "n", "keys"]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), _ID, pa.int64(), pa.int64(), pa.list_(pa.int64())]

#: A lower-case text with none of these, nor a space at its ends, has normalised lines.
_SPACES = (b"\t", b"\r", b"\x0b", b"\x0c", b"  ", b" \n", b"\n ")

_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(2)
_A = (_rng.integers(0, 1 << 31, (BANDS * ROWS, 1), np.int64).astype(np.uint32) << 1) | np.uint32(1)


def normalised(line: bytes) -> bytes:
    """A-Z to lower case, runs of white space to one space."""
    return b" ".join(line.lower().split())


def normalised_lines(text: bytes) -> tuple[list[bytes], Sequence[int]]:
    """The normalised lines of a text that are not blank, and their numbers."""
    text = text.lower()
    lines = text.split(b"\n")
    if text[:1] == b" " or text[-1:] == b" " or any(x in text for x in _SPACES):
        lines = [b" ".join(line.split()) for line in lines]
    number = range(len(lines))
    if b"" in lines:
        number = [i for i, line in enumerate(lines) if line]
        lines = [lines[i] for i in number]
    return lines, number


def row_key(doc_id: int | None, text: bytes) -> bytes:
    named = (b"\x00" + text, 0) if doc_id is None else (b"\x01" + text, doc_id & ((1 << 64) - 1))
    return xxhash.xxh3_128_digest(*named)


def _halves(digests: list[bytes]) -> np.ndarray:
    """128-bit digests as two columns of signed numbers."""
    return np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)


def _ids(halves: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1])], fields=list(_ID))


def _mixed(x: np.ndarray) -> np.ndarray:
    y = x >> np.uint64(32)
    y ^= x
    y *= _MIX
    y ^= y >> np.uint64(29)
    return y


def _hashed(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles that begin at every character of the joined lines; first and last of each line.

    ``stop - start`` is not positive for a line shorter than a shingle.
    """
    text = b"\n".join(lines)
    codes = (np.frombuffer(text, np.uint8) if text.isascii() else
             np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32))
    ends = np.append(np.flatnonzero(codes == 10), len(codes))
    starts = np.append(0, ends[:-1] + 1)
    c = np.zeros(len(codes) + SHINGLE, np.uint64)
    c[:len(codes)] = codes
    m = [np.uint64(pow(0x9DDFEA08EB382D69, p, 1 << 64)) for p in (1, 2, 4)]
    h = c[:-1] * m[0]
    h += c[1:]
    for step, by in ((2, m[1]), (4, m[2])):
        more = h[:-step] * by
        more += h[step:]
        h = more
    h = h[:-1] * m[0]
    h += c[8:]
    return _mixed(h), starts, ends - SHINGLE + 1


def _numbered(lines: list[bytes], number: np.ndarray) -> np.ndarray:
    """The shingles of every line as 54-bit hashes behind the line's number (10 bits); one shorter than a shingle is its only one."""
    h, starts, stops = _hashed(lines)
    short = np.flatnonzero(stops <= starts)
    if len(short):
        h[starts[short]] = [xxhash.xxh64_intdigest(lines[i]) for i in short.tolist()]
        stops[short] = starts[short] + 1
    count = stops - starts
    at = np.arange(count.sum()) + np.repeat(starts - np.cumsum(count) + count, count)
    return np.repeat(number.astype(np.uint64) << np.uint64(54), count) | h[at] >> np.uint64(10)


def shingles(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, hash)`` of the distinct shingles of every line, by line."""
    out = []
    for at in range(0, len(lines), 1 << 10):
        some = lines[at:at + (1 << 10)]
        x = np.sort(_numbered(some, np.arange(len(some))))
        x = x[np.append(True, x[1:] != x[:-1])]
        out.append(((x >> np.uint64(54)).astype(np.int64) + at, x & np.uint64((1 << 54) - 1)))
    return tuple(np.concatenate(x) for x in zip(*out))


def jaccard(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Similarity of the shingle sets of pairs of lines."""
    out = []
    for at in range(0, len(left), 1 << 10):
        number = np.arange(len(left[at:at + (1 << 10)]))
        a, b = (_numbered(x[at:at + (1 << 10)], number) for x in (left, right))
        a, b = (x[np.append(True, x[1:] != x[:-1])] for x in (np.sort(a), np.sort(b)))
        both = np.sort(np.concatenate([a, b]))
        size = np.bincount((both >> np.uint64(54)).astype(np.int64), minlength=len(number))
        common = np.bincount((both[1:][both[1:] == both[:-1]] >> np.uint64(54)).astype(np.int64), minlength=len(number))
        out.append(common / (size - common))
    return np.concatenate(out) if out else np.zeros(0)


def _begins(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])[:len(x)])


class Common:
    """Shingles that the lines of a group have in common, by an inverted index."""

    def __init__(self, lines: list[bytes]):
        owner, h = shingles(lines)
        self.size = np.bincount(owner, minlength=len(lines))
        self.first = np.cumsum(self.size) - self.size
        order = np.argsort(h)
        self.start = _begins(h[order])
        self.count = np.diff(np.append(self.start, len(h)))
        self.token, self.owner = np.empty(len(h), np.int64), owner[order]
        self.token[order] = np.repeat(np.arange(len(self.start)), self.count)

    def similarities(self, i: int) -> np.ndarray:
        """Jaccard similarity of line ``i`` with every line."""
        mine = self.token[self.first[i]:self.first[i] + self.size[i]]
        count, start = self.count[mine], self.start[mine]
        at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
        common = np.bincount(self.owner[at], minlength=len(self.size))
        return common / (self.size + self.size[i] - common)


def band_keys(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(which, keys)``: the band keys of every line of ``SHINGLE`` characters or more.

    A shorter line has itself as only shingle and is like no other line.
    """
    h, starts, stops = _hashed(lines)
    which = np.flatnonzero(stops > starts)
    if not len(which):
        return which, np.zeros((0, BANDS), np.int64)
    h = (h >> np.uint64(32)).astype(np.uint32)
    # A line's shingles, then those that reach into the next line, and so on.
    ends = np.stack([starts[which], stops[which]], 1).ravel()
    least = np.empty((len(which), BANDS * ROWS), np.uint32)
    product = np.empty_like(h)
    for j in range(BANDS * ROWS):
        np.multiply(h, _A[j], out=product)
        least[:, j] = np.minimum.reduceat(product, ends)[::2]
    keys = np.zeros((len(which), BANDS), np.uint64)
    wide = least.astype(np.uint64).reshape(len(which), BANDS, ROWS)
    for r in range(ROWS):
        keys = _mixed(keys + wide[:, :, r] + np.uint64(1))
    keys += np.arange(BANDS, dtype=np.uint64) * _MIX
    return which, keys.view(np.int64)


def _slices(lines: list[bytes], chars: int = 1 << 16) -> Iterator[tuple[int, list[bytes]]]:
    """The lines in slices of about ``chars`` bytes (one line at least), so that arrays per character stay small."""
    at, size = 0, 0
    for i, line in enumerate(lines):
        size += len(line)
        if size >= chars:
            yield at, lines[at:i + 1]
            at, size = i + 1, 0
    if at < len(lines):
        yield at, lines[at:]


def _batch(n: int, kind: int, /, **columns) -> pa.RecordBatch:
    columns["kind"] = pa.array(np.full(n, kind, np.int32))
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t)) for c, t in zip(_NAMES, _TYPES)],
                                      schema=pa.schema(list(zip(_NAMES, _TYPES))))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text pass: documents to rows of ROW."""
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        for start, block in byte_blocks(batch.column("text"), BLOCK_BYTES):
            docs = batch.column("doc_id").slice(start, len(block))
            known: dict[bytes, bytes] = {}
            found, number, counts = [], [], []
            for text in block:
                lines, at = normalised_lines(text)
                hashes = list(map(digest, lines))
                known.update(zip(hashes, lines))
                found += hashes
                number += at
                counts.append(len(hashes))
            rows = _ids(_halves([row_key(d, t) for d, t in zip(docs.to_pylist(), block)]))
            counts = np.array(counts, np.int64)
            yield _batch(len(block), DOC, row=rows, doc_id=docs, n=pa.array(counts))
            if not found:
                continue
            owner = pa.array(np.repeat(np.arange(len(block)), counts))
            ids = _halves(found)
            yield _batch(len(ids), PLACE, hi=pa.array(ids[:, 0]), lo=pa.array(ids[:, 1]), row=rows.take(owner),
                         doc_id=docs.take(owner), n=pa.array(np.array(number, np.int64)))
            del found, number, ids, owner
            names, lines = _halves(list(known))[:, 0], list(known.values())
            del known, block
            parts = [(at + which, keys) for at, some in _slices(lines) for which, keys in [band_keys(some)]]
            member = np.repeat(names[np.concatenate([w for w, _ in parts])], BANDS)
            keys = np.concatenate([k for _, k in parts]).ravel()
            order = np.lexsort((member, keys))
            keys, member = keys[order], member[order]
            first = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
            least = member[np.flatnonzero(first)][np.cumsum(first) - 1] if len(keys) else member
            rest = ~first & (least != member)
            single = pa.ListArray.from_arrays(pa.array(np.arange(rest.sum() + 1, dtype=np.int32)), pa.array(keys[rest]))
            yield _batch(int(rest.sum()), PAIR, hi=pa.array(least[rest]), lo=pa.array(member[rest]), keys=single)
            keys, member = keys[first], member[first]
            order = np.argsort(member, kind="stable")
            keys, member = keys[order], member[order]
            begin = np.flatnonzero(np.append(True, member[1:] != member[:-1])[:len(member)])
            lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(member)).astype(np.int32)), pa.array(keys))
            yield _batch(len(begin), LEAST, hi=pa.array(member[begin]), keys=lists)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines ``hi`` in the buckets ``keys``, to one row for each range of keys among about ``KEYS`` of them."""
    def ranges(parts: list) -> pa.RecordBatch:
        key, line = (np.concatenate(x) for x in zip(*parts))
        at = (key.view(np.uint64) >> np.uint64(64 - RANGE_BITS)).astype(np.uint16)
        order = np.argsort(at, kind="stable")
        at = at[order]
        begin = _begins(at)
        ends = pa.array(np.append(begin, len(at)).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(at[begin].astype(np.int32)), *(
            pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (key, line))], ["range", "keys", "lines"])

    parts, n = [], 0
    for batch in batches:
        lists = batch.column("keys")
        parts.append((lists.flatten().to_numpy(), np.repeat(batch.column("hi").to_numpy(), lists.value_lengths().to_numpy())))
        n += len(parts[-1][0])
        if n >= KEYS:
            yield ranges(parts)
            parts, n = [], 0
    if n:
        yield ranges(parts)


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (key, a) sorted by key: every other line of a bucket is paired with the least of its batch.

    Where a bucket goes on in the next batch, the least so far goes with it, and
    is paired with that batch's least if that is less: one chain, whatever the order.
    """
    last_key, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, a = batch.column("key").to_numpy(), batch.column("a").to_numpy()
        if key[0] == last_key:
            key, a = np.append(last_key, key), np.append(last, a)
        begin = _begins(key)
        low = np.minimum.reduceat(a, begin)
        least = np.repeat(low, np.diff(np.append(begin, len(a))))
        last_key, last = key[-1], low[-1]
        pair = least != a
        yield pa.RecordBatch.from_arrays([pa.array(key[pair]), pa.array(least[pair]), pa.array(a[pair])], ["key", "a", "b"])


def _link_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_link`` of the rows of ``_spread``, sorted by range."""
    def ordered(keys: list, lines: list) -> pa.RecordBatch:
        key = np.concatenate(keys)
        order = np.argsort(key)
        return pa.RecordBatch.from_arrays([pa.array(key[order]), pa.array(np.concatenate(lines)[order])], ["key", "a"])

    def ranges() -> Iterator[pa.RecordBatch]:
        last, keys, lines, n = None, [], [], 0
        for batch in batches:
            at = batch.column("range").to_numpy()
            begin = _begins(at).tolist()
            for start, stop in zip(begin, [*begin[1:], len(at)]):
                if n >= KEYS and at[start] != last:
                    yield ordered(keys, lines)
                    keys, lines, n = [], [], 0
                last = at[start]
                for to, column in ((keys, "keys"), (lines, "lines")):
                    to.append(batch.column(column).slice(start, stop - start).flatten().to_numpy())
                n += len(keys[-1])
        if n:
            yield ordered(keys, lines)

    yield from _link(ranges())


def _place(ids: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of a hash in the filter, and the bits it has there."""
    x = ids.view(np.uint64)
    one, low = np.uint64(1), np.uint64(63)
    bits = one << (x & low) | one << (x >> np.uint64(6) & low) | one << (x >> np.uint64(12) & low) | one << (x >> np.uint64(18) & low)
    return ((x >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), bits


def _filter(ids: DataFrame, n: int, filter_bytes: int = FILTER_BYTES) -> np.ndarray:
    """A blocked Bloom filter of ``n`` distinct ids (hashes), of at most ``filter_bytes``; beyond that more ids pass."""
    blocks = max(1, min(filter_bytes // 8, n * BITS_PER_LINE // 64))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = _place(batch.column(0).to_numpy(), blocks)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found.view(np.int64))], ["block", "bits"])

    rows = ids.mapInArrow(bits, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(blocks, np.uint64)
    out[rows["block"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _passes(known: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at, bits = _place(ids, len(known))
    return known[at] & bits == bits


def _only(rows: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The ``rows`` whose ``hi`` is among the ``n`` distinct ``ids``, and few others, checkpointed."""
    spark = rows.sparkSession

    def hit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for hi in batches:
            yield pa.array(_passes(known.value, hi.to_numpy()))

    with number_batches(spark):
        known = spark.sparkContext.broadcast(_filter(ids, n))
        hit = F.arrow_udf(hit, "boolean", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
        out = materialize(rows.withColumn("hit", hit("hi")).filter("hit").drop("hit"))
    known.unpersist()
    return out


def _line_texts(wanted):
    """Texts to the distinct lines of every block that pass the filter; ``wanted`` is a broadcast of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, known = xxhash.xxh3_128_digest, wanted.value
        for batch in batches:
            for _, block in byte_blocks(batch.column(0), BLOCK_BYTES):
                found = {}
                for text in block:
                    lines, _ = normalised_lines(text)
                    found.update(zip(map(digest, lines), lines))
                if not found:
                    continue
                ids = _halves(list(found))
                hit, lines = np.flatnonzero(_passes(known, ids[:, 0].copy())), list(found.values())
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit, 0]), pa.array(ids[hit, 1]),
                                                  pa.array([lines[i] for i in hit.tolist()], pa.binary()).cast(pa.string())],
                                                 ["hi", "lo", "line"])

    return run


def _similar(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for x, y in batches:
        out = []
        for at, left in byte_blocks(x, 1 << 20):
            out.append(jaccard(left, y.slice(at, len(left)).cast(pa.binary()).to_pylist()))
        yield pa.array(np.concatenate(out) if out else [], pa.float64())


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between lines of a group (of its left and right lines, if it has both) that join its parts."""
    for batch in batches:
        for row in batch.column("members"):
            members = row.values
            lines = members.field("line").cast(pa.binary()).to_pylist()
            part = np.unique(members.field("part").to_numpy(zero_copy_only=False), return_inverse=True)[1]
            side = members.field("side").to_numpy(zero_copy_only=False).astype(bool)
            both, common, a, b = side.any() and not side.all(), Common(lines), [], []
            # Every pair of lines of different parts has an end outside the largest part.
            for i in np.flatnonzero(part != np.bincount(part).argmax()).tolist():
                other = part != part[i]
                if both:
                    other &= side != side[i]
                if not other.any():
                    continue
                near = common.similarities(i) >= SIMILARITY
                for j in np.flatnonzero(near & other).tolist():
                    if part[j] != part[i]:
                        part[part == part[j]] = part[i]
                        a.append(i)
                        b.append(j)
            ids = members.field("id")
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(x, pa.int64())) for x in (a, b)], ["a", "b"])


def similar_lines(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``(node, component)`` of lines (hi, lo) linked to others; ``rows`` are the written rows of the text pass."""
    spark = docs.sparkSession
    least = rows.filter(F.col("kind") == LEAST).select("hi", "keys")
    least = least.mapInArrow(tidy(_spread), "range int, keys array<long>, lines array<long>")
    least = least.repartition("range").sortWithinPartitions("range").mapInArrow(tidy(_link_ranges), "key long, a long, b long")
    linked = materialize(least.union(rows.filter(F.col("kind") == PAIR).select(F.col("keys")[0], "hi", "lo")))
    pairs = materialize(linked.select("a", "b").distinct())
    wanted, n = materialize_counted(pairs.select(F.explode(F.array("a", "b")).alias("hi")).distinct())
    with number_batches(spark):
        known = spark.sparkContext.broadcast(_filter(wanted, n))
    lines = docs.select("text").mapInArrow(tidy(_line_texts(known)), "hi long, lo long, line string")
    wanted = F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted
    lines = lines.join(wanted, "hi", "left_semi").groupBy("hi", "lo").agg(F.first("line").alias("line"))
    lines, n = materialize_counted(lines.select(F.struct("hi", "lo").alias("id"), "line"))
    known.unpersist()
    # Where no two of these lines agree in their first 64 bits, those name them.
    short = lines.select("id.hi").distinct().count() == n
    lines = lines.withColumn("node", F.col("id.hi") if short else F.col("id"))
    similar = F.arrow_udf(tidy(_similar), "double", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    sides = (pairs.join(lines.select(F.col("id.hi").alias("a"), F.col("node").alias("a_node"), F.col("line").alias("x")), "a")
             .join(lines.select(F.col("id.hi").alias("b"), F.col("node").alias("b_node"), F.col("line").alias("y")), "b"))
    tested = materialize(sides.select("a", "b", "a_node", "b_node", similar("x", "y").alias("similarity")))
    good = tested.filter(F.col("similarity") >= SIMILARITY)
    edges = good.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    more = _rest(linked, tested, good, lines)
    named = components(edges.union(more) if more is not None else edges)
    return lines.join(small_or_shuffled(named), "node").select(F.col("id").alias("node"), "component")


def _rest(linked: DataFrame, tested: DataFrame, good: DataFrame, lines: DataFrame) -> DataFrame | None:
    """Links between parts that are not one component yet, inside buckets of three or more lines where some pair failed; None if there are no such buckets."""
    failed = small_or_shuffled(tested.filter(F.col("similarity") < SIMILARITY).select("a", "b").distinct())
    keys = linked.join(failed, ["a", "b"], "left_semi").select("key").distinct()
    sizes = linked.groupBy("key").agg(F.count("*").alias("pairs"))
    keys = sizes.join(keys, "key", "left_semi").filter("pairs > 1").select("key")
    keys = small_or_shuffled(keys)
    if keys.isEmpty():
        return None
    members = linked.join(keys, "key").select("key", F.explode(F.array("a", "b")).alias("id")).distinct()
    # A line's part is the least line it is linked to, and that one's in turn: lines of one part are one
    # component, whatever bucket linked them.  Each line comes with the bytes of its text.
    least = small_or_shuffled(good.groupBy(F.col("b").alias("part")).agg(F.min("a").alias("least")))
    known = lines.groupBy(F.col("id.hi").alias("id")).agg(F.sum(F.length("line")).alias("bytes")).withColumn("part", F.col("id"))
    for _ in range(2):
        known = known.join(least, "part", "left").select("id", F.coalesce("least", "part").alias("part"), "bytes")
    members = materialize(members.join(small_or_shuffled(known), "id"))
    # Buckets of one part have no more to tell; equal buckets (the same lines met in several bands) are compared once.
    sets = members.groupBy("key").agg(F.bit_xor(F.xxhash64("id")).alias("same"), F.count("*").alias("n"), F.sum("bytes").alias("bytes"),
                                      F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high")
    once = sets.groupBy("same", "n", "bytes").agg(F.min("key").alias("key"))
    cut = F.greatest(F.ceil(F.col("n") / F.lit(GROUP)), F.ceil(F.col("bytes") / F.lit(GROUP_BYTES))).cast("int")
    members = members.drop("bytes").join(small_or_shuffled(once.select("key", cut.alias("g"))), "key")
    members = members.withColumn("i", F.pmod(F.xxhash64("id"), F.col("g")).cast("int"))
    blocks = F.transform(F.sequence(F.lit(0), F.col("g") - 1), lambda j: F.struct(
        F.least(F.col("i"), j).alias("p"), F.greatest(F.col("i"), j).alias("q")))
    members = members.select("key", "id", "part", "i", F.inline(blocks))
    named = members.join(lines.select(F.col("id.hi").alias("id"), "node", "line"), "id")
    named = named.select("key", "p", "q", F.struct(F.col("node").alias("id"), "part", (F.col("i") == F.col("p")).alias("side"), "line").alias("member"))
    # Tasks by their number, not by bytes: a group costs far more than its size says.
    spark = lines.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = named.repartition(tasks, "key", "p", "q").groupBy("key", "p", "q").agg(F.collect_list("member").alias("members"))
    open_parts = F.size(F.array_distinct(F.transform("members", lambda m: m["part"]))) > 1
    node = lines.schema["node"].dataType.simpleString()
    return groups.filter(open_parts).select("members").mapInArrow(tidy(_compare), f"a {node}, b {node}").distinct()


def dedup_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, removed)``: ``rows`` is (row, doc_id, n_lines) per row of ``docs``, ``removed`` is
    (row, line, keep_doc_id, keep_line) per removed line, with the place of the line kept for it.

    Lines are told apart after A-Z is lower-cased and white space is collapsed;
    blank lines are neither counted nor removed.  A null text has no lines.  A
    null doc_id comes last in the order that chooses the line kept.  A row that
    repeats both id and text is the same document: what is removed from one is
    removed from all of them.  Texts and lines of any length are read whole.
    Other columns are not read; an empty table gives empty results.
    """
    base = small_batches(docs).select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    path = scratch_path(docs.sparkSession, "lines")
    base.mapInArrow(tidy(_rows), ROW).write.option("compression", "zstd").parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    line = ["hi", "lo"]
    named = materialize(similar_lines(rows, base).select("node.hi", "node.lo", "component"))
    place = rows.filter(F.col("kind") == PLACE).select(*line, "row", "doc_id", F.col("n").cast("int").alias("line"))
    # Only lines with a second place, or linked to others, go on: the places of all others are not shuffled.
    more = place.groupBy("hi").agg(F.count("*").alias("n")).filter("n > 1").select("hi")
    place = _only(place, *materialize_counted(more.union(named.select("hi")).distinct()))
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line", "row")
    # First place of every line, then of every component.  Keys are plain numbers: a struct would be sorted
    # without a prefix.
    first = place.groupBy(*line).agg(F.min(rank).alias("first"), F.count("*").alias("n")).join(named, line, "left")
    first = materialize(first.filter("component is not null or n > 1").select(*line, "component", "first"))
    alone, several = first.filter("component is null"), first.filter("component is not null")
    joint = several.groupBy("component").agg(F.min("first").alias("first"))
    keep = (alone.select(*line, "first")
            .union(several.drop("first").join(small_or_shuffled(joint), "component").select(*line, "first")))
    keep = keep.select(*line, F.col("first.doc_id").alias("keep_doc_id"), F.col("first.line").alias("keep_line"),
                       F.col("first.row").alias("keep_row"))
    removed = place.join(small_or_shuffled(keep), line).filter("row != keep_row or line != keep_line")
    removed = removed.select("row", "line", "keep_doc_id", "keep_line").distinct()
    return rows.filter(F.col("kind") == DOC).select("row", "doc_id", F.col("n").alias("n_lines")), removed


def _per_document(removed: DataFrame) -> DataFrame:
    entry = F.struct("line", "keep_doc_id", "keep_line")
    return removed.groupBy("row").agg(F.sort_array(F.collect_list(entry)).alias("removed"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with one line per component left in ``text``; other columns as they are.

    A document that had lines and lost them all is left out; blank and null
    texts stay.
    """
    _, removed = dedup_lines(docs)
    gone, n = materialize_counted(_per_document(removed).select("row.hi", "row.lo", F.col("removed.line").alias("lines")))
    with number_batches(docs.sparkSession):
        known = docs.sparkSession.sparkContext.broadcast(_filter(gone.select("hi").distinct(), n))

    def marked(batches: Iterator[tuple[pa.Array, pa.Array]], keep: bool) -> Iterator[tuple[pa.Array, np.ndarray, list[bytes]]]:
        """Row keys of a batch, which of its rows may have lost lines, and their texts."""
        for doc, text in batches:
            ids, hits, found = [np.zeros((0, 2), np.int64)], [np.zeros(0, bool)], []
            for at, block in byte_blocks(text, BLOCK_BYTES):
                ids.append(_halves([row_key(d, t) for d, t in zip(doc.slice(at, len(block)).to_pylist(), block)]))
                hits.append(_passes(known.value, ids[-1][:, 0].copy()) & np.array([bool(t) for t in block]))
                found += [packed(block[i]) for i in np.flatnonzero(hits[-1]).tolist()] if keep else []
            yield np.concatenate(ids), np.concatenate(hits), found

    def untouched(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for _, hit, _ in marked(batches, False):
            yield pa.array(~hit)

    def touched(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, hit, found in marked(batches, True):
            text = np.full(len(hit), None, object)
            text[hit] = found
            yield pa.StructArray.from_arrays([pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(text, pa.binary())], ["hi", "lo", "packed"])

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, lines in batches:
            out = []
            for t, drop in zip(text, lines.to_pylist()):
                t = unpacked(t.as_py())
                if drop:
                    drop = set(drop)
                    rest = [x for i, x in enumerate(t.split(b"\n")) if i not in drop]
                    t = b"\n".join(rest) if any(normalised(x) for x in rest) else None
                out.append(t)
            yield pa.array(out, pa.binary()).cast(pa.string())

    def udf(f, kind):
        return F.arrow_udf(tidy(f), kind, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()

    # A text that lost lines meets their numbers, packed; the others are not shuffled.
    key = docs["doc_id"].cast("long"), docs["text"]
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    rest = docs.select(row, udf(untouched, "boolean")(*key).alias("whole")).filter("whole").select("row.*")
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != "text"]).alias("row")
    some = docs.select(row, udf(touched, "struct<hi:long,lo:long,packed:binary>")(*key).alias("as")).select("row", "as.*")
    some = some.filter("packed is not null").join(F.broadcast(gone) if n <= BROADCAST_ROWS else gone, ["hi", "lo"], "left")
    some = some.select("row", udf(cut, "string")("packed", "lines").alias("cut")).filter("cut is not null")
    some = some.select(*[(F.col("cut") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    return rest.union(some)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those removed with the place (document, line) of the line kept for each."""
    rows, removed = dedup_lines(table(spark, sf_dir, "documents"))
    out = rows.join(_per_document(removed), "row", "left")
    return out.select("doc_id", "n_lines", (F.col("n_lines") - F.coalesce(F.size("removed"), F.lit(0))).alias("n_kept"),
                      F.coalesce("removed", F.array().cast("array<struct<line:int,keep_doc_id:long,keep_line:int>>")).alias("removed"))
