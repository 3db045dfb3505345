"""Top inner products, the filter audit and spelling variants against plain versions, and on edge rows."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm import filter_audit, spelling, top_inner
from tests.llm import edges

# --- top inner products -------------------------------------------------------------------------------------


def plain_top(rows, k, every):
    """``rows``: distinct (id, integers)."""
    out = set()
    for i, q in rows:
        if i is None or i % every:
            continue
        found = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for j, v in rows if j != i]
        out |= {(i, n + 1, j, -s) for n, (s, _, _, j) in enumerate(sorted(found, key=lambda x: x[:3])[:k])}
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def got_top(df):
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("strip_rows,cell_queries", [(None, None), (37, 3)])
def test_top_k_is_exact(spark, strip_rows, cell_queries):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 12))
    # Few values and several lengths: many ties in score and length.
    x = np.round((centres[rng.integers(0, 5, 400)] + rng.normal(size=(400, 12)) / 4) * rng.choice([0.01, 0.03, 1], (400, 1)) * 2, 1)
    rows = [(i, tuple(map(float, v))) for i, v in enumerate(x.astype(np.float32).tolist())]
    want = plain_top([(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows], 5, 10)
    df = vectors(spark, [(i, list(v)) for i, v in rows])
    assert got_top(top_inner.top_k(df, every=10, strip_rows=strip_rows, cell_queries=cell_queries)) == want


def test_walk_prunes_and_loses_nothing():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(4000, 32)) * np.geomspace(200, 1, 32) * rng.choice([0.1, 1], (4000, 1)))
    q = np.floor(rng.normal(size=(30, 32)) * np.geomspace(200, 1, 32))
    x = x[np.argsort(-(x * x).sum(1))]
    turn = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    best, scored = top_inner.walk(top_inner.Rotated(q, turn), np.full(30, -1), np.full(30, -np.inf), top_inner.Rotated(x, turn),
                                  np.arange(4000), np.zeros(4000, bool))
    want = np.sort((q @ x.T).astype(np.int64), 1)[:, ::-1][:, :5]
    assert (best.score.reshape(30, 5) == want).all()
    assert scored < 30 * 4000 / 2


def test_top_k_on_edge_rows(spark):
    nan, inf, none = float("nan"), float("inf"), None
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (10, [1.0, 2.0]), (20, [nan, 1.0]), (30, none), (40, [none, 1.0]), (50, [inf, 0.0]),
            (none, [1.0, 2.0]), (none, [1.0, 2.0]), (1, []), (2, [1.0]), (3, [1.0, 0.0, 5.0]), (4, [-0.001, 0.0]), (60, [1e30, 0.0]), (100, [])]
    kept = {0: (256, 512), 10: (256, 512), None: (256, 512), 1: (), 2: (256,), 3: (256, 0, 1280), 4: (-1, 0), 100: ()}
    df = vectors(spark, rows).withColumn("v", F.lit("x")).withColumn("id", F.lit(1)).withColumn("key", F.lit(2)).withColumn("strip", F.lit(0))
    assert got_top(top_inner.top_k(df, every=10)) == plain_top(list(kept.items()), 5, 10)
    assert got_top(top_inner.top_k(vectors(spark, []))) == set()
    assert got_top(top_inner.top_k(vectors(spark, [(0, [1.0])]))) == set()
    # Beyond what a double holds exactly.
    large = [(0, [2.0 ** 21 + 1 / 256, 2.0 ** 20]), (1, [2.0 ** 20 + 3 / 256, 2.0 ** 21 - 1 / 256]), (2, [2.0 ** 21, 2.0 ** 20 + 1 / 256])]
    df = spark.createDataFrame(large, "vec_id long, embedding array<double>")
    assert got_top(top_inner.top_k(df)) == plain_top([(i, [int(256 * c) for c in v]) for i, v in large], 5, 50)


# --- filter audit -------------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    """``rows``: (doc_id, text, lang)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        t = t or ""
        w = t.encode().split()
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and least[t] < i}
        mine = [x for x in labels if x[0] == i and i is not None]
        docs.append((lang or "", {f for f, x in fails.items() if x}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        of = [d for d in docs if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = of
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in d[1] for d in of) - len(gone),
                                                   sum(d[1] == {f} for d in of), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got_audit(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in df.collect()}


def test_intervals_cover_every_order_once():
    for n in (1, 3, 5):
        hits = Counter((m, r) for m, _, a, b in filter_audit.intervals(n) for r in range(a, b))
        orders = list(itertools.permutations(range(n)))
        assert hits == {(m, r): 1 for m in range(1, 1 << n) for r in range(len(orders))}
        assert [filter_audit.lehmer_rank(p, n) for p in orders] == list(range(len(orders)))


def test_audit_matches_plain_version(spark):
    rng = random.Random(4)
    pool = []
    for _ in range(25):
        words = [rng.choice("abcdefgh") * rng.randrange(1, 30) for _ in range(rng.choice([3, 150, 230]))]
        pool.append((" " if rng.random() < 0.5 else "  \n").join(words) + rng.choice(["", "", "#", "É" * 9, "ABC" * 40]))
    pool += [None, "", "Ä", "A\x1c$"]
    rows = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice(["de", "en", "", None])) for _ in range(300)]
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS id", "2 AS mask", "3 AS n", "4 AS good", "5 AS part")
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS id", "2 AS good")
    assert got_audit(filter_audit.audit(docs, marked)) == plain_audit(rows, labels)


def test_audit_on_edge_rows(spark):
    rows = [(r[0], r[1], r[2]) for r in edges.ROWS]
    labels = [(1, 1, 0), (5, 0, 1), (6, 1, None), (None, 1, 1), (7, None, 0), (99, 0, 1)]
    assert got_audit(filter_audit.audit(edges.docs(spark), edges.labels(spark))) == plain_audit(rows, labels)
    assert got_audit(filter_audit.audit(edges.docs(spark, []), edges.labels(spark))) == {}


# --- spelling variants --------------------------------------------------------------------------------------


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(docs, least=7, alter=31, count=2, ratio=10):
    counts = Counter()
    for i, t in docs:
        for run in "".join(c if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in t or "").split(" "):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                counts[run if h % alter else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= count}
    by_size, out = defaultdict(list), {}
    for w in words:
        by_size[len(w)].append(w)
    for w, n in words.items():
        others = [o for d in (-1, 0, 1) for o in by_size[len(w) + d] if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = [form, None, n, len(others), words[form] if form else None]
    for w, row in out.items():
        end = w
        while out[end][0]:
            end = out[end][0]
        row[1] = end
    return {w: tuple(v) for w, v in out.items()}


def got_variants(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def some_docs(rng):
    """Documents of a small dense vocabulary: many near words, chains of forms, ties."""
    base = ["".join(rng.choice("aÀÿ") for _ in range(rng.randrange(6, 9))) for _ in range(300)]
    weight = [rng.choice([1, 15, 250]) for _ in base]
    base += ["xyzxyzxyz" + "bc" * 4, "xyzxyzxyz" + "bc" * 3 + "bd", "xyzxyzxyz" + "bc" * 2 + "bdbd", "xyzxyzxyz" + "bc" + "bdbdbd"]
    weight += [30000, 2000, 130, 8]
    return [(rng.choice([None, i]), rng.choice([" ", ".", "1", "—"]).join(rng.choices(base, weight, k=400)).replace("a", rng.choice("aA"))) for i in range(150)]


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 60])
def test_variants_match_plain_version(spark, filter_bytes):
    rows = some_docs(random.Random(5))
    want = plain_variants(rows, alter=5)
    assert sum(v[0] is not None and v[0] != v[1] for v in want.values()) > 1 and max(v[3] for v in want.values()) > 9
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "'x' AS word", "2 AS n", "3 AS form")
    assert got_variants(spelling.variants(docs, alter=5, filter_bytes=filter_bytes)) == want


def test_variants_on_edge_rows(spark):
    rows = [*edges.ROWS, (9, "q" * 40_000 + " " + "q" * 40_000, "en", "a"), (10, ("q" * 39_999 + "é ") * 30, "en", "a")]
    want = plain_variants([r[:2] for r in rows])
    assert got_variants(spelling.variants(edges.docs(spark, rows))) == want
    assert got_variants(spelling.variants(edges.docs(spark, []))) == {}


def test_filters_miss_no_word(spark):
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice([7, 8, 30]))) for _ in range(3000)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    filters = spelling.build(df, Counter(map(len, words)))
    for length, index in spelling.by_length(words):
        h = spelling.hashes(spelling.codes([words[i] for i in index]))
        assert len(filters.holds(h, length)) == len(index)
        others = spelling.codes(["".join(rng.choice("qrstuvwxyz") for _ in range(length)) for _ in range(5000)])
        assert len(filters.holds(spelling.hashes(others), length)) < 25
