"""Operators against brute force, oracles and round trips."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratus.llm import chat, graph, labels, line_dedup, mixing, pii, quality, queries, secrets, simhash, toxicity
from stratus.llm.common import table
from tests.llm import edges

SF = "/root/testdata/sf0.001"


def duck(sql, sf=SF):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con.execute(sql).df()


def texts(sf=SF):
    return [(int(i), t or "") for i, t in duck("SELECT doc_id, text FROM documents", sf).itertuples(index=False)]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), duck(queries.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    key, cols = got.columns[0], sorted(got.columns)
    got, want = (x[cols].sort_values(key).astype(str).values.tolist() for x in (got, want))
    assert got == want


def union_find(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find([x for x in links if x[0] != x[1]])
    assert got == want


def test_masks_cover():
    masks = [m & (2**64 - 1) for m in simhash.masks(4)]
    rng = random.Random(2)
    assert len(masks) == 31 and all(25 <= bin(m).count("1") <= 40 for m in masks)
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(m & diff == 0 for m in masks)


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    got = queries.QUERIES["op3_simhash"](spark, SF).collect()
    prints = {i: plain_print(t) for i, t in texts()}
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    ids = list(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if bin(prints[a] ^ prints[b]).count("1") <= 4]
    named = union_find(links)
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: named.get(i, i) for i in ids}


def test_buckets_are_split_without_loss(spark):
    rng = random.Random(3)
    prints = list({sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 4))) for _ in range(300)})
    fps = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    want = union_find([(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints[:i]) if bin(a ^ b).count("1") <= 4])
    sizes = sorted(Counter(want.values()).values())
    for block in (7, 4096):
        got = graph.components(simhash.links(fps, block=block)).groupBy("component").count().collect()
        assert sorted(r["count"] for r in got) == sizes


def expected_lines(docs, least=line_dedup.SIMILARITY):
    places = defaultdict(list)
    for i, t in docs:
        for n, line in enumerate(t.split("\n")):
            line = line_dedup.normalised(line.encode()).decode()
            if line:
                places[line].append((i, n))
    lines = list(places)
    sets, index = [{x[i:i + 9] for i in range(max(1, len(x) - 8))} for x in lines], defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            index[g].append(i)
    links = []
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in index[g] if j < i)
        links += [(i, j) for j, n in common.items() if n / (len(s) + len(sets[j]) - n) >= least]
    named = union_find(links)
    first = {}
    for i, x in enumerate(lines):
        c = named.get(i, i)
        first[c] = min([first.get(c, (1 << 60, 0)), *places[x]])
    return {p: first[named.get(i, i)] for i, x in enumerate(lines) for p in places[x] if p != first[named.get(i, i)]}


def test_line_dedup(spark):
    got = queries.QUERIES["op2_line_dedup"](spark, SF).collect()
    found = {(r["doc_id"], x["line"]): (x["keep_doc_id"], x["keep_line"]) for r in got for x in r["removed"]}
    assert found == expected_lines(texts())


def test_line_dedup_of_chains_and_crowds(spark, monkeypatch):
    """Variants of one line, each near the next but not near all, in buckets larger than a group."""
    monkeypatch.setattr(line_dedup, "GROUP", 8)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(8))
    line, docs = [word() for _ in range(40)], []
    for i in range(60):
        if i % 3 == 0:
            line[rng.randrange(40)] = word()
        own = list(line)
        own[rng.randrange(40)] = word()
        docs.append((i, " ".join(own)))
    df = edges.docs(spark, [(i, t, "en", "a") for i, t in docs])
    rows, removed = line_dedup.dedup_lines(df)
    ids = {r["row"]: r["doc_id"] for r in rows.collect()}
    found = {(ids[r["row"]], r["line"]): (r["keep_doc_id"], r["keep_line"]) for r in removed.collect()}
    assert found == expected_lines(docs)


def test_secret_parts(spark):
    rows = [(1, "user: alice42 xx https://db.example.com/x password=\"Abcdefgh123\" yy", "en", "a"),
            (2, "user = bob\nkey Zx9Qw8Er7Ty6Ui5Op4As3 end", "en", "a"), (3, "Zx9Qw8Er7Ty6Ui5Op4As3 alone", "en", "a"),
            (4, "user = bob" + " " * 300 + "Zx9Qw8Er7Ty6Ui5Op4As3", "en", "a"), (5, "AKIA" + "A" * 11 + " AKIA" + "B" * 12, "en", "a")]
    got = {r["doc_id"]: [(secrets.ORDER[s["kind"]], s["start"]) for s in r["spans"]] for r in secrets.scan(edges.docs(spark, rows)).collect()}
    assert got == {1: [("ident", 0), ("endpoint", 17), ("assign", 42)], 2: [("ident", 0), ("weak", 15)], 3: [], 4: [], 5: [("access", 16)]}


PII = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
       r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_pii(text):
    out = []
    for kind, p in enumerate(PII):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = [True, kind == 1 and all(int(x) <= 255 for x in m[0].split(".")), 13 <= len(d) <= 19 and pii.luhn(d), 9 <= len(d) <= 15][kind]
            out += [(kind, *m.span())] * ok
    return out


def test_pii_patterns():
    rng = random.Random(5)
    for _ in range(20_000):
        t = "".join(rng.choice("a.@-+1234 0.1@b() é") for _ in range(rng.randrange(60)))
        assert [x[:3] for x in pii.matches(t) if x[3]] == plain_pii(t)
    assert pii.luhn("4111111111111111") and pii.iban_ok("GB82 WEST 1234 5698 7654 32")


def test_pii(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_pii"](spark, SF).collect()}
    for i, t in texts():
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in plain_pii(t))
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_pii_estimate_finds_the_weak_labeler():
    rng = np.random.default_rng(6)
    truth = rng.random(4000) < 0.5
    votes = [tuple(int(2 * (t == (rng.random() < r)) - 1) for r in (0.85, 0.999, 0.6, 0.9)) for t in truth]
    votes = [",".join(map(str, v)) for v in votes]
    post, right, _ = pii.estimate(sorted(Counter(votes).items()))
    assert right[2] < right[0] and right[2] < 0.7 and np.mean([(post[v] > 0.5) == t for v, t in zip(votes, truth)]) > 0.97


def test_held_out_rule(spark):
    got = spark.range(200).select("id", labels.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op7_quality"](spark, sf).toPandas().merge(duck("SELECT * FROM labels", sf), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95


def test_quality_without_labels():
    weights, bias = quality.train([("only good words", 1)])
    assert quality.score_texts([b"", b"some words"], weights, bias).min() > 0.9
    weights, bias = quality.train([])
    assert quality.score_texts([b"x"], weights, bias)[0] == 0.5


def made_up(rng, n, insults):
    parts = ["an", "ti", "the", "re", "on", "er", "st", "ou", "ha", "in", "ed"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(60)]
        if i % 2:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(insults)
        rows.append((" ".join(words[:30]) + ". " + " ".join(words[30:]) + ".", i % 2))
    return rows


def test_toxicity_finds_disguised_words():
    rng = random.Random(7)
    machine = toxicity.train(made_up(rng, 300, ["idiot", "moron", "scumbag"]), 0.5)
    score = lambda rows: machine.probability(toxicity.document_margins([t.encode() for t, _ in rows], machine, {}))
    clean, plain, hidden = (score(made_up(rng, 100, w)[k::2]) for w, k in (
        (["x"], 0), (["idiot", "moron"], 1), (["id-iot", "i.d.i.o.t", "m*oron", "i d i o t"], 1)))
    assert (plain >= 0.3).mean() > 0.97 and (clean < 0.3).mean() > 0.95 and (hidden >= 0.3).mean() > 0.9
    assert toxicity.train([("a b", 0)], 0.0).probability(np.zeros(1))[0] < 0.1


def test_toxicity_finds_look_alikes_and_other_scripts():
    assert not toxicity.forms_of("12:--") and not toxicity.forms_of("a1") and toxicity.forms_of("@$$h0l3") == ["^asshole$"]
    rng = random.Random(8)
    machine = toxicity.train(made_up(rng, 300, ["idiot", "asshole", "scumbag", "идиотка", "ηλίθιος", "أحمق", "你是傻瓜吗", "바보야"]), 0.5)
    score = lambda rows: machine.probability(toxicity.document_margins([t.encode() for t, _ in rows], machine, {}))
    for word in ("1d10t", "@$$h0l3", "i--d--i--o--t", "i..d..i..o..t", "idi\u043et", "идиотка", "и-д-и-о-т-к-а", "ηλίθιος", "أحمق", "他真是傻瓜啊", "바보야"):
        assert (score(made_up(rng, 60, [word])[1::2]) >= 0.3).mean() > 0.9, word
    for word in ("2024", "$1,000.50", "хорошо", "你好世界", "مدرسة"):
        assert (score(made_up(rng, 60, [word])[1::2]) < 0.3).mean() > 0.9, word


def test_toxicity_of_ordinary_words_and_quoted_insults():
    rng = random.Random(9)
    threats = ["we will burn your house", "drop dead now", "nobody would miss you"]
    common = sorted({w for t in threats for w in t.split()})

    def with_common(rows):  # every word of the threats is in clean and toxic documents alike
        out = []
        for text, label in rows:
            words = text.split(" ")
            for w in rng.sample(common, 8):
                words.insert(rng.randrange(len(words)), w)
            out.append((" ".join(words), label))
        return out

    def threatening(n, what):
        return [(t + " And " + rng.choice(what) + " so.", 1) for t, label in with_common(made_up(rng, 2 * n, ["x"])) if label]

    clean = [(t, 0) for t, _ in with_common(made_up(rng, 400, ["x"]))]
    machine = toxicity.train(clean + threatening(200, threats), 0.5)
    score = lambda m, rows: m.probability(toxicity.document_margins([t.encode() for t, _ in rows], m, {}))
    assert machine.windows is not None
    assert (score(machine, threatening(60, threats)) >= 0.3).mean() > 0.9
    assert (score(machine, threatening(60, ["we will bu-rn your hou-se"])) >= 0.3).mean() > 0.9
    assert (score(machine, with_common(made_up(rng, 100, ["x"]))) < 0.3).mean() > 0.9
    # One clean document quotes the insult.
    rows = made_up(rng, 300, ["scumbag"])
    quoted = toxicity.train([(rows[0][0] + " He said scumbag.", 0)] + rows[1:], 0.5)
    assert (score(quoted, made_up(rng, 100, ["scumbag"])[1::2]) >= 0.3).mean() > 0.97


def test_window_scores_are_the_kernel():
    weights = np.random.default_rng(1).normal(size=toxicity._SIZE) * (np.bincount(
        toxicity.subsequences([" abcdefghijklmnopqrstuvwxyz ", " the cat sat on a mat "])[1], minlength=toxicity._SIZE) > 0)
    texts = ["The cat sat on a mat. A b c d e! I am.", "x"]
    found = [(signs[a:b].decode(), v) for signs, _, start, end in toxicity.windows_of(texts, {})
             for a, b, v in zip(start, end, toxicity.window_scores(signs, start, end, weights, 0.0))]
    assert " cat sat on " in dict(found) and " i am " in dict(found)
    for window, v in found:
        _, code, weight = toxicity.subsequences([window], apart=True)
        assert abs(weights[code] @ weight - v) < 1e-5, window


def test_kernel_against_its_definition():
    def plain(x, y):
        def feats(w):
            out, n = Counter(), len(w)
            for i in range(n):
                for j in range(i + 1, min(n, i + 1 + toxicity.REACH)):
                    for k in range(j + 1, min(n, j + 1 + toxicity.REACH)):
                        if "_" not in w[i] + w[j] + w[k]:
                            out[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i + 1)
            return out
        a, b = feats(x), feats(y)
        dot = lambda p, q: sum(v * q[u] for u, v in p.items())
        return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5

    words = ["^idiot$", "^i_d_iot$", "^banana$", "^an$", "^e'te'$"]
    got = toxicity.gram(words, words)
    assert np.allclose(got, [[plain(x, y) for y in words] for x in words], atol=1e-5)


def test_targets():
    assert mixing.targets([600, 600, 600], [1, 2, 3]) == [300, 600, 900]
    got = mixing.targets([10, 1000, 1000], [10, 1, 1])
    assert got[0] == 30 and abs(got[1] - got[2]) < 1e-9 and abs(sum(got) - 2010) < 1e-6
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0, 0]


def test_slots_are_dealt_and_permuted():
    slots = np.array([1000, 1, 0, 333])
    dealt = mixing.deal(slots, 7)
    assert (dealt.sum(0) == slots).all() and dealt.sum(1).max() - dealt.sum(1).min() <= 1
    for n in (1, 2, 3, 5, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 5))) == list(range(n))


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    docs = table(spark, SF, "documents")
    plan = mixing.mix(docs, block=32, text=True)
    got = mixing.taken(plan).toPandas()
    size = {i: len(t.split()) for i, t in texts()}
    assert dict(zip(got.doc_id, got["size"])) == size and (got.taken <= 3 * got["size"]).all()
    per = got.groupby("source").agg(size=("size", "sum"), claimed=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (per["size"] == per.claimed).all() and (abs(per.taken - per.target) <= 64).all()
    # Every drawn block holds the words of its documents, in the stream's order.
    shards, slots = mixing.shards(plan).toPandas(), plan.slots.toPandas()
    assert len(shards) == len(slots) and sum(len(t.split()) for t in shards.text) == got.taken.sum()
    stream = plan.documents.toPandas().sort_values(["src", "start"])
    for src, d in stream.groupby("src"):
        words = " ".join(t or "" for t in d.text).split()
        for b, t in set(zip(shards[shards.src == src].block, shards[shards.src == src].text)):
            assert t.split() == words[b * 32:(b + 1) * 32]
    again = mixing.taken(mixing.mix(docs.repartition(5), block=32)).toPandas()
    assert dict(zip(again.doc_id, again.taken)) == dict(zip(got.doc_id, got.taken))


def test_mix_counts_its_packed_blocks(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    packed = []
    shards = mixing.shards
    monkeypatch.setattr(mixing, "shards", lambda plan: packed.append(shards(plan)) or packed[-1])
    got = queries.QUERIES["op8_mixing"](spark, SF).toPandas()
    assert len(packed) == 1 and len(got) == docs.count()
    want = mixing.taken(mixing.mix(docs)).toPandas()
    assert dict(zip(got.doc_id, got.taken)) == dict(zip(want.doc_id, want.taken))
    assert sum(len(r["text"].split()) for r in packed[0].select("text").collect()) == got.taken.sum()
    monkeypatch.setattr(mixing, "shards", lambda plan: shards(plan).limit(0))  # nothing packed, nothing taken
    assert mixing.pack(docs).agg(F.sum("taken")).first()[0] == 0


def test_secret_parts_a_whole_scope_apart(spark):
    ident, weak, scope = secrets.ORDER.index("ident"), secrets.ORDER.index("weak"), secrets.SCOPE
    parts = spark.createDataFrame([(i, 0, 0, kind, at, end) for i, gap in ((1, scope), (2, scope + 1)) for kind, at, end in (
        (ident, scope - 10, scope), (weak, scope + gap, scope + gap + 20))], "id long, fp long, len int, kind int, start int, end int")
    assert {(r["id"], r["kind"]) for r in secrets.link_parts(parts).collect()} == {(1, ident), (1, weak)}


def test_escapes():
    rng = random.Random(8)
    for _ in range(5000):
        t = "".join(rng.choice(["</s>", "<s>", "[INST]", "[/INST]", "\\", "<", "[", "a", "<</SYS>>", "/"]) for _ in range(rng.randrange(8)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROL + chat.OTHER_CONTROL)


def test_chat_edges(spark):
    rows = [(1, 0, "user", "é\\ </s>"), (1, 1, "assistant", None), (1, 1, "assistant", None), (None, None, None, None),
            (None, 0, "x", "y[INST"), (2, 5, "assistant", "ok"), (3, 0, "assistant", "a" * 200_000 + "\n" + "b c" * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS tokens", "'b' AS body")
    placed = chat.assemble(turns)
    got = {r["conv_id"]: r for r in chat.read_back(placed).collect()}
    assert {c: r["n_turns"] for c, r in got.items()} == {1: 3, None: 2, 2: 1, 3: 1}
    assert got[2]["loss_chars"] == 2 and got[3]["loss_chars"] == 350_001 and got[1]["loss_chars"] == 0
    want = hashlib.sha256("user\né\\ </s>\nassistant\n\nassistant\n\n".encode()).hexdigest()
    assert got[1]["turns_sha256"] == want
    shown = {(r["conv_id"], r["turn"]): r["formatted"] for r in chat.render(placed).collect()}
    assert shown[(2, 5)] == "<s>[INST]assistant[/INST]ok</s>"
    starts = sorted((r["start"], len(r["tokens"])) for r in placed.filter("conv_id = 1").collect())
    assert [s for s, _ in starts] == [0, starts[0][1], starts[0][1] + starts[1][1]]
    assert chat.read_back(chat.assemble(turns.filter("false"))).count() == 0


def test_pipeline(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert 0 < len(out) <= len(texts()) and out.doc_id.is_unique and (out.taken <= 3 * out["size"]).all()
