"""Personal data by weak supervision.

Candidate spans of several kinds get the votes of labelers: formats and check
digits (regex), lists of known prefixes and endings (gazetteer), and cue words
nearby (context).  Expectation-maximisation over the counts of all vote patterns
estimates how reliable every labeler is; the posteriors train a final logistic
classifier on features of the span, which decides on the candidates that are not
base spans.  Only counts by vote pattern and by feature tuple, whose number is
bounded by their small ranges, reach the driver.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import small_batches, table, text_blocks
from stratus.operators.joins import materialize

# Kinds in the order of the contract, then those that only the method reports.
KINDS = ["email", "ip", "card", "phone", "local_phone", "ssn", "iban"]
BASE = KINDS[:4]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A digit run can only be entered at its first digit (an earlier match ends with its run), so a lookbehind loses nothing.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_DIGIT = re.compile(r"[0-9]")

# Gazetteers and cue words of the labelers.
ENDINGS = frozenset("com org net edu gov int io co uk de fr es it nl eu us ca au ch at be pt pl se no dk fi info biz".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35")
IBAN_COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT SE".split())
CUES = re.compile(r"(?i)\b(?:phone|tel|call|mobile|fax|e-?mail|mail|contact|write to|card|visa|credit|payment|account|iban|ssn|"
                  r"social security|ip|address|login from|host|born|name)\b")
COUNTER_CUES = re.compile(r"(?i)\b(?:version|release|order|invoice|isbn|sku|page|chapter|section|figure|build|serial|ticket|part)\b")
NEAR = 40

LABELERS = ["format", "check", "gazetteer", "context"]
#: Where EM starts for each labeler, and the bounds of its reliability: a failed check digit outweighs format and
#: prefix together, not a cue word beside them.
START = np.array([0.7, 0.999, 0.75, 0.8])
LEAST = np.array([0.55, 0.999, 0.55, 0.55])
MOST = np.array([0.85, 0.999, 0.85, 0.9])
FEATURES = ["kind", "digits", "separators", "check", "known", "cue", "before", "after"]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    t = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping: from every @ back over the local part, so no run is scanned twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def matches(text: str) -> list[tuple[int, int, int, bool]]:
    """``(kind, start, end, base)``: pattern matches; base is whether a base kind's own test passes."""
    out = []
    if "@" in text:
        out += [(0, s, e, True) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            out.append((1, *m.span(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))))
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            out.append((2, *m.span(), 13 <= len(d) <= 19 and luhn(d)))
        if "+" in text:
            for m in _PHONE.finditer(text):
                out.append((3, *m.span(), 9 <= len(_digits(m[0])) <= 15))
        for kind, pattern in ((4, _LOCAL_PHONE), (5, _SSN), (6, _IBAN)):
            out += [(kind, *m.span(), False) for m in pattern.finditer(text)]
    return out


def _bucket(n: int, *bounds: int) -> int:
    return sum(n >= b for b in bounds)


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3


def describe(text: str, kind: int, start: int, end: int) -> tuple[str, str]:
    """Votes (+, - or 0 per labeler) and the feature tuple of a candidate, as short strings."""
    span, d = text[start:end], _digits(text[start:end])
    around = text[max(0, start - NEAR):start] + " " + text[end:end + NEAR]
    fmt = {0: 3 <= len(span) <= 254 and ".." not in span, 1: not any(len(p) > 1 and p[0] == "0" for p in span.split(".")),
           2: 13 <= len(d) <= 19, 3: 9 <= len(d) <= 15, 4: True, 5: d[:3] not in ("000", "666") and d[:1] != "9", 6: True}[kind]
    check = {1: lambda: all(len(p) < 4 and int(p) < 256 for p in span.split(".")), 2: lambda: 13 <= len(d) <= 19 and luhn(d), 6: lambda: iban_ok(span)}.get(kind)
    check = None if check is None else check()
    known = {0: lambda: span.rsplit(".", 1)[-1].lower() in ENDINGS, 2: lambda: d.startswith(CARD_PREFIXES),
             3: lambda: d[:1] != "0", 4: lambda: d[:1] not in "01", 6: lambda: span[:2] in IBAN_COUNTRIES}.get(kind)
    known = None if known is None else known()
    cue = 1 if CUES.search(around) else -1 if COUNTER_CUES.search(around) else 0
    before, after = _side(text[start - 1:start]), _side(text[end:end + 1])
    glued = before in (1, 2) or after in (1, 2)
    votes = [1 if fmt and not glued else -1, 0 if check is None else 1 if check else -1, 0 if known is None else 1 if known else -1, cue]
    seps = len(span) - len(d)
    feats = (kind, _bucket(len(d), 1, 9, 13, 16, 20), _bucket(seps, 1, 3, 6), votes[1], votes[2], cue, before, after)
    return ",".join(map(str, votes)), ",".join(map(str, feats))


SPAN = "struct<kind:int,start:long,end:long,base:boolean,votes:string,feats:string>"
_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()),
                             ("votes", pa.string()), ("feats", pa.string())]))


def _candidates(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for _, block in text_blocks(batch):
            for raw in block:
                spans = []
                if b"@" in raw or re.search(rb"[0-9]", raw):
                    text = raw.decode("utf-8", "replace")
                    for kind, start, end, base in matches(text):
                        if kind == 2 and end - start < 9:
                            continue  # shorter runs of digits are no card and no base span
                        votes, feats = describe(text, kind, start, end)
                        spans.append(dict(kind=kind, start=start, end=end, base=base, votes=votes, feats=feats))
                out.append(spans)
        yield pa.array(out, _ARROW)


def estimate(patterns: list[tuple[str, int]], rounds: int = 50) -> tuple[dict[str, float], np.ndarray, float]:
    """EM over counted vote patterns: posterior of each pattern, reliability of each labeler, prior.

    A labeler that does not abstain is right with its reliability, whatever the
    class; reliabilities stay between ``LEAST`` and ``MOST``, so labels cannot swap.
    """
    votes = np.array([[int(v) for v in p.split(",")] for p, _ in patterns], float).reshape(-1, len(LABELERS))
    n = np.array([c for _, c in patterns], float)
    right, prior = START.copy(), 0.5
    post = np.full(len(n), prior)
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + votes @ np.log(right / (1 - right))
        post = 1 / (1 + np.exp(-odds))
        agree = np.where(votes > 0, post[:, None], 1 - post[:, None]) * (votes != 0) * n[:, None]
        total = ((votes != 0) * n[:, None]).sum(0)
        right = np.clip((agree.sum(0) + 8) / (total + 10), LEAST, MOST)
        prior = float(np.clip((post @ n + 1) / (n.sum() + 2), 0.1, 0.9)) if len(n) else 0.5
    return {p: float(q) for (p, _), q in zip(patterns, post)}, right, prior


def train(rows: list[tuple[str, float, float]], steps: int = 300, ridge: float = 1.0) -> dict[str, float]:
    """Logistic regression on one-hot features; rows are (features, count, sum of posteriors). Scores per feature tuple."""
    if not rows:
        return {}
    names: dict[tuple, int] = {}
    cols = [[names.setdefault((i, v), len(names)) for i, v in enumerate(f.split(","))] for f, _, _ in rows]
    x = np.zeros((len(rows), len(names) + 1))
    x[:, -1] = 1
    for r, c in enumerate(cols):
        x[r, c] = 1
    n, y = np.array([r[1] for r in rows], float), np.array([r[2] / r[1] for r in rows])
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + keep * w
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + np.diag(keep), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return {f: float(1 / (1 + np.exp(-(x[i] @ w)))) for i, (f, _, _) in enumerate(rows)}


def _union(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint stretches that spans cover, in order."""
    starts, ends = [], []
    for start, end in sorted(spans):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def chosen(spans: list[dict], scores: dict[str, float], threshold: float) -> list[dict]:
    """Base spans, and of the others those the classifier accepts that overlap no span taken before, best first."""
    base = sorted((s for s in spans if s["base"]), key=lambda s: (s["kind"], s["start"]))
    starts, ends = _union([(s["start"], s["end"]) for s in base])
    rest = [(-scores.get(s["feats"], 0.0), s["start"], s["end"], s["kind"]) for s in spans if not s["base"]]
    out = [dict(kind=s["kind"], start=s["start"], end=s["end"], base=True, score=scores.get(s["feats"], 0.0)) for s in base]
    for score, start, end, kind in sorted(rest):
        if -score < threshold:
            break
        i = bisect_left(starts, end)  # what is taken is disjoint: of the stretches that start before ``end`` the last ends last
        if i == 0 or ends[i - 1] <= start:
            starts.insert(i, start)
            ends.insert(i, end)
            out.append(dict(kind=kind, start=start, end=end, base=False, score=-score))
    return sorted(out, key=lambda s: (s["kind"], s["start"]))


_OUT = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]))


def find(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: doc_id and spans (kind, start, end, base, score), by kind then start.

    kind is the place in ``KINDS``; positions are code points, the end exclusive.
    Base spans always stay.  A null text is empty; every row stands alone, so
    repeated rows and null ids need no care; an empty table gives an empty
    result; other columns are not read.
    """
    candidates = F.arrow_udf(_candidates, f"array<{SPAN}>", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    rows = materialize(small_batches(docs).select("doc_id", candidates(docs["text"]).alias("spans")))
    spans = rows.select(F.inline("spans"))
    patterns = spans.groupBy("votes").count().collect()  # 3 ** labelers at most
    post, _, _ = estimate(sorted((r["votes"], r["count"]) for r in patterns))
    weight = F.create_map(*[F.lit(x) for kv in sorted(post.items()) for x in kv]) if post else F.create_map().cast("map<string,double>")
    tuples = spans.groupBy("feats").agg(F.count("*").alias("n"), F.sum(F.element_at(weight, F.col("votes"))).alias("p"))
    scores = train(sorted((r["feats"], r["n"], round(r["p"], 6)) for r in tuples.collect()))  # bounded by the features' ranges

    def choose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([chosen(s, scores, threshold) for s in batch.to_pylist()], _OUT)

    choose = F.arrow_udf(choose, "array<struct<kind:int,start:long,end:long,base:boolean,score:double>>",
                         F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    return rows.select("doc_id", choose("spans").alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    out = out.select("doc_id", "spans", base.alias("base"))
    kinds = F.col("base.kind")
    count = [F.size(F.filter(kinds, lambda x: x == F.lit(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE)]
    return out.select("doc_id", *count, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
