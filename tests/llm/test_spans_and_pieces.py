"""Added spans of op5, found and refused; piecewise encoding of op10 against the whole; op8's plan without broadcasts; buckets of op2 linked."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratus.llm import chat, line_dedup, mixing, pii


@pytest.mark.parametrize("letters", ["ab 's\n\t1!?é中。 \x1c'", "don't we'll  \n it's 12,345.6 ", "aé中1 "])
def test_pieces_have_the_ids_of_the_whole_text(letters):
    enc, rng = chat.encoding(f"{chat.TOKENIZERS}/{chat.VOCABULARY}"), random.Random(letters)
    for n in (49, 51, 5_000, 20_000):
        text = "".join(rng.choice(letters) for _ in range(n))
        assert chat._encode(text, enc, longest=50, run=4_000) == enc.encode_ordinary(text)


def test_text_over_the_bound_and_a_run_without_borders():
    enc, rng = chat.encoding(f"{chat.TOKENIZERS}/{chat.VOCABULARY}"), random.Random(1)
    text = "".join(rng.choice(["word", "it's", " ", "  ", "\n", "\n\n", "42", ", ", "été"]) for _ in range(120_000))
    assert len(text) > 200_000 and chat._encode(text, enc) == enc.encode_ordinary(text)
    for run in ("x" * 700_000, " " * 700_000):
        assert enc.decode(chat._encode(run, enc)) == run


def test_vocabulary_is_built_once_and_its_size_is_known():
    path = f"{chat.TOKENIZERS}/{chat.VOCABULARY}"
    assert chat.encoding(path) is chat.encoding(path) and chat.vocabulary_size(path) == chat.encoding(path).n_vocab


def _span(kind, start, end, base):
    return dict(kind=kind, start=start, end=end, base=base, feats="f")


def test_added_span_inside_a_long_base_span_is_refused():
    ips = [_span(1, 10 + 8 * i, 16 + 8 * i, True) for i in range(12)]  # many base spans between the long one and the card
    spans = [_span(0, 0, 122, True), *ips, _span(2, 108, 120, False), _span(4, 122, 134, False), _span(5, 130, 140, False)]
    got = pii.chosen(spans, {"f": 0.9}, 0.5)
    assert [(s["kind"], s["start"]) for s in got if not s["base"]] == [(4, 122)]


def test_added_spans_against_all_pairs():
    rng = random.Random(7)
    for _ in range(200):
        spans = []
        for _ in range(rng.randrange(1, 25)):
            start = rng.randrange(80)
            spans.append(dict(kind=rng.randrange(7), start=start, end=start + rng.randrange(1, 30), base=rng.random() < 0.5,
                              feats=rng.choice("abc")))
        scores = {"a": 0.9, "b": 0.6, "c": 0.2}
        taken = [(s["start"], s["end"]) for s in spans if s["base"]]
        want = []
        for s in sorted((s for s in spans if not s["base"]), key=lambda s: (-scores[s["feats"]], s["start"], s["end"], s["kind"])):
            if scores[s["feats"]] >= 0.5 and all(e <= s["start"] or b >= s["end"] for b, e in taken):
                taken.append((s["start"], s["end"]))
                want.append((s["kind"], s["start"], s["end"]))
        got = [(s["kind"], s["start"], s["end"]) for s in pii.chosen(spans, scores, 0.5) if not s["base"]]
        assert got == sorted(want, key=lambda x: x[:2])


def test_added_kinds_found_and_refused(spark):
    texts = {0: "call 555-123-4567 now", 1: "ssn 123-45-6789", 2: "iban DE89 3704 0044 0532 0130 00 account",
             3: "order 555-123-4567", 4: "build DE89 3704 0044 0532 0130 01", 5: "no data", 6: None}
    rows = [(100 * k + i, t) for i in range(40) for k, t in texts.items()]
    # Base spans with and without cues, from which the labelers' reliabilities follow.
    rows += [(10_000 + i, f"mail me: u{i}@example.com, card 4111 1111 1111 1111, order 1234567890123") for i in range(40)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id < 10000")
    kinds = {}
    for r in found.collect():
        kinds.setdefault(r["doc_id"] // 100 if r["doc_id"] % 100 < 40 else None, set()).add(
            tuple((pii.KINDS[s["kind"]], s["start"], s["end"]) for s in r["spans"]))
    assert kinds[0] == {(("local_phone", 5, 17),)} and kinds[1] == {(("ssn", 4, 15),)} and kinds[2] == {(("iban", 5, 32),)}
    assert kinds[4] == {()} and kinds[5] == {()} and kinds[6] == {()}


def test_mixing_broadcasts_nothing_that_grows(spark):
    rows = [(i, f"s{i % 3}", f"word{i} " * (i % 50)) for i in range(300)]
    plan = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), text=True)
    built = mixing.shards(plan)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in built.splitlines() if "Join" in line and "src" in line and "block" in line]
    assert joins and all("SortMergeJoin" in j for j in joins)
    texts = [line for line in plan.documents._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [key" in line]
    assert texts and all("SortMergeJoin" in j for j in texts)
    counted = mixing.taken(plan, mixing.shards(plan))
    assert counted.count() == 300 and counted.agg(F.sum("taken")).first()[0] > 0


def test_buckets_are_linked_whatever_the_order_and_the_batches():
    rng = np.random.default_rng(5)
    key = np.sort(rng.integers(-40, 40, 600))
    key[100:300] = key[100]  # one bucket over many batches
    key = np.sort(key)
    a = rng.permutation(600)
    for size in (1, 7, 64, 600):
        batches = [pa.RecordBatch.from_arrays([pa.array(key[i:i + size]), pa.array(a[i:i + size])], ["key", "a"])
                   for i in range(0, 600, size)]
        rows = [r for b in line_dedup._link(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert all(low < other for _, low, other in rows)
        for k in np.unique(key).tolist():
            parts = {int(x): int(x) for x in a[key == k]}

            def find(x):
                while parts[x] != x:
                    x = parts[x]
                return x

            for _, low, other in (r for r in rows if r[0] == k):
                parts[find(other)] = find(low)
            assert len({find(x) for x in parts}) == 1
            if size == 600:  # a bucket within a batch is a star about its least line
                assert {low for kk, low, _ in rows if kk == k} <= {min(parts)}
