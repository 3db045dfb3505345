"""What the operators shuffle: arrays of keys, places of lines that others repeat, texts that lost lines."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratus.llm import common, line_dedup, mixing


def test_bucket_keys_travel_in_ranges(monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS", 200)
    rng = np.random.default_rng(3)
    member = {}  # key: lines
    blocks = []
    for _ in range(9):
        lists = [rng.choice(rng.integers(-(1 << 63), 1 << 63, 5), 3).tolist() + [7, -7] for _ in range(30)]
        names = rng.integers(-1000, 1000, 30).tolist()
        blocks.append(pa.RecordBatch.from_arrays([pa.array(names), pa.array(lists, pa.list_(pa.int64()))], ["hi", "keys"]))
        for name, keys in zip(names, lists):
            for key in keys:
                member.setdefault(key, set()).add(name)
    spread = pa.Table.from_batches(line_dedup._spread(iter(blocks)))
    assert spread.num_rows < sum(len(b.column("keys").flatten()) for b in blocks) / 2
    assert len(spread["keys"].combine_chunks().flatten()) == len(spread["lines"].combine_chunks().flatten())
    rows = [r for b in line_dedup._link_ranges(iter(spread.sort_by("range").to_batches(max_chunksize=3)))
            for r in zip(*(c.to_pylist() for c in b.columns))]
    # A bucket lies in one range, linked as a whole: a star about its least line.
    assert {(k, a) for k, a, _ in rows} == {(k, min(x)) for k, x in member.items() if len(x) > 1}
    assert {(k, b) for k, _, b in rows} == {(k, y) for k, x in member.items() for y in x if y != min(x)}


def test_no_bucket_keys():
    empty = pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64()))], ["hi", "keys"])
    assert list(line_dedup._spread(iter([empty]))) == [] and list(line_dedup._link_ranges(iter([]))) == []


def test_only_places_of_wanted_lines_go_on(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("hi"), "id")
    wanted = rows.filter("id % 100 = 0").select("hi")
    got = {r["id"] for r in line_dedup._only(rows, wanted, 200).collect()}
    assert set(range(0, 20_000, 100)) <= got and len(got) < 400
    assert line_dedup._only(rows, wanted.limit(0), 0).count() == 0


def test_lines_are_normalised_by_text_as_one_by_one():
    texts = ["a  b\nC", "\tx\n y", "", " ", "A\n\nb ", "é É\r\n x\x0by", "a\n b", "plain\nLines here\n", "x\x0c\n\n"]
    for text in (t.encode() for t in texts):
        lines, number = line_dedup.normalised_lines(text)
        alone = [(i, x) for i, x in enumerate(map(line_dedup.normalised, text.split(b"\n"))) if x]
        assert list(zip(number, lines)) == alone


def nodes(plan, kind):
    """Nodes of an optimized plan by name."""
    found = [plan] if plan.nodeName() == kind else []
    for i in range(plan.children().size()):
        found += nodes(plan.children().apply(i), kind)
    return found


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan()


@pytest.mark.parametrize("limit", [0, 1000])
def test_only_texts_that_lost_lines_are_joined(spark, monkeypatch, limit):
    # Both sides of the bound that decides between a broadcast and a shuffle.
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(line_dedup, "small_or_shuffled", lambda df: common.small_or_shuffled(df, limit))
    own = [hashlib.sha256(bytes([i])).hexdigest() for i in range(60)]  # like no other
    rows = [(i, f"{x[:30]}é\n\n{x[30:]}", i % 3) for i, x in enumerate(own)]
    rows[40:50] = [(i, f"a line that many texts share\n{own[i]}", None) for i in range(40, 50)]
    rows += [(100, "a line that many texts share", 1), (101, None, 2), (102, "", 3), (103, " \n", 4), (None, "A  line that many texts share", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `n.x` long")
    out = line_dedup.without_repeated_lines(docs)
    joins = [j for j in nodes(optimized(out), "Join") if "packed" in j.schema().simpleString()]
    assert joins and not any("text:string" in j.schema().simpleString() for j in nodes(optimized(out), "Join"))
    want = {(i, t, x) for i, t, x in rows if i not in (100, None)}
    want = {(i, t.split("\n")[1] if i is not None and 40 < i < 50 else t, x) for i, t, x in want}
    got = out.collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) and out.columns == docs.columns


def test_mixing_shuffles_packed_texts(spark):
    rows = [(i, f"s{i % 3}", None if i % 10 == 0 else f"wörd{i} " * (i % 50)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plan = mixing.mix(docs, text=True)
    moved = [a for a in nodes(optimized(plan.documents), "Aggregate") if "packed" in a.schema().simpleString()]
    assert moved and not any("text" in a.schema().simpleString() for a in moved)
    assert {r["doc_id"]: r["text"] for r in plan.documents.collect()} == {i: t for i, _, t in rows}
    assert mixing.taken(plan, mixing.shards(plan)).agg(F.sum("taken")).first()[0] > 0


def test_packed_texts_read_back():
    for text in (b"", "é 日本".encode() * 3, b"x" * 100_000):
        assert common.unpacked(common.packed(text)) == text
