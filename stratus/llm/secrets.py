"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong matches (assigned values, access key ids, long hex) are reported as they
are.  Weak parts - identifiers, endpoints and random-looking tokens - are
reported only when complementary parts lie within ``SCOPE`` characters of them in
the same document: an interval join on (document, position bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratus.llm.common import row_key, same_row, small_or_shuffled, table
from stratus.operators.joins import materialize

SCOPE = 200

# The base patterns of the contract, then those of the weak parts.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
IDENT = r"""(?i:(username|user|login|account|client_?id|access_?key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]+)"""
ENDPOINT = r"""(?i:(https?|ftps?|sftp|ssh|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3))://([A-Za-z0-9@:%._/?&=+#~-]+)"""
WEAK = r"[A-Za-z0-9+/_-]{20,}"

# kind: pattern, shape that a document must show to be searched, role
KINDS = {
    "assign": (ASSIGN, ASSIGN, "secret"),
    "access": (ACCESS, r"AKIA[A-Z0-9]{12}", "id"),
    "hex": (r"[0-9a-f]{32,}", r"[0-9a-f]{32}", "secret"),
    "ident": (IDENT, IDENT, "id"),
    "endpoint": (ENDPOINT, ENDPOINT, "endpoint"),
    "weak": (WEAK, WEAK, "secret"),
}
BASE = ("assign", "access", "hex")
ORDER = list(KINDS)


def _passes(kind: str, match: Column, value: Column) -> Column:
    """What a match must show beyond its pattern."""
    if kind == "assign":
        return F.length(value) >= 8
    if kind == "access":
        return F.length(match) >= 16
    if kind == "ident":
        return F.length(value) >= 3
    if kind == "weak":  # random-looking: digits, capitals and small letters
        return match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]")
    return F.lit(True)


def _pieces(kind: str, text: Column) -> Column:
    """Matches of a kind as (kind, i, length of text up to its end since the last match, its length, passes).

    A match is found with the text before it (``\\G`` ties it to the end of the
    last one), so lengths add up to positions and no match is looked for twice.
    """
    pattern = KINDS[kind][0]
    found = F.regexp_extract_all(text, F.lit(rf"\G(?s:.*?)(?:{pattern})"), F.lit(0))

    def entry(piece, i):
        match = F.regexp_extract(piece, pattern, 0)
        value = F.regexp_extract(piece, pattern, 2) if "([A" in pattern else match
        return F.struct(F.lit(ORDER.index(kind)).alias("kind"), i.alias("i"), F.length(piece).alias("piece"),
                        F.length(match).alias("size"), _passes(kind, match, value).alias("passes"))

    return F.transform(found, entry)


def find_parts(docs: DataFrame) -> DataFrame:
    """``(id, fp, len, kind, start, end)`` of every match that passes, strong or weak, once per distinct row."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = row_key(docs).columns
    keyed = docs.select(docs["doc_id"].alias("id"), F.xxhash64(text).alias("fp"), F.length(text).alias("len"), text.alias("text"))
    # A weak token matters only beside an identifier or an endpoint.
    shows = {k: F.col("text").rlike(KINDS[k][1]) for k in ORDER if k != "weak"}
    keyed = keyed.select("*", *[F.when(F.length("text") > 0, c).otherwise(False).alias(k) for k, c in shows.items()])
    keyed = keyed.filter(" or ".join(shows)).withColumn("weak", F.expr("access or ident or endpoint"))
    empty = F.array().cast("array<struct<kind:int,i:int,piece:int,size:int,passes:boolean>>")
    found = F.concat(*[F.when(F.col(k), _pieces(k, F.col("text"))).otherwise(empty) for k in ORDER])
    pieces = keyed.select(*rows, F.inline(found))
    # Repeated rows bring the same pieces again: each counts once.
    in_order = Window.partitionBy("id", "fp", "len", "kind").orderBy("i")
    pieces = pieces.withColumn("again", F.coalesce(F.lag("i").over(in_order) == F.col("i"), F.lit(False)))
    end = F.sum(F.when(F.col("again"), 0).otherwise(F.col("piece"))).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return (pieces.withColumn("end", end).filter("passes and not again")
            .select(*rows, "kind", (F.col("end") - F.col("size")).cast("long").alias("start"), F.col("end").cast("long").alias("end")))


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts that have their complements in scope, from all ``parts``.

    A part within ``scope`` characters of another meets it in a bucket of that
    width; parts that overlap do not complement each other, and a weak part
    over a strong match is that match's own text.
    """
    role = F.element_at(F.array(*[F.lit(KINDS[k][2]) for k in ORDER]), F.col("kind") + 1)
    strong = F.col("kind") < len(BASE)

    def bucketed(df, low, high):
        return df.withColumn("bucket", F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope))))

    weak = bucketed(parts.filter(~strong), F.col("start") - scope - 1, F.col("end") + scope)  # a part's last sign is before its end
    other = bucketed(parts.withColumn("role", role).withColumn("strong", strong), F.col("start"), F.col("end") - 1)
    other = other.select("id", "fp", "len", "bucket", "role", "strong", F.col("start").alias("s"), F.col("end").alias("e"))
    w, o = weak.alias("w"), other.alias("o")
    met = w.join(o, F.col("w.id").eqNullSafe(F.col("o.id")) & (F.col("w.fp") == F.col("o.fp")) & (F.col("w.len") == F.col("o.len"))
                 & (F.col("w.bucket") == F.col("o.bucket")) & (F.col("s") <= F.col("end") + scope) & (F.col("e") >= F.col("start") - scope))
    overlap = (F.col("s") < F.col("end")) & (F.col("e") > F.col("start"))
    flag = lambda c: F.max(c.cast("int"))
    beside = met.groupBy("w.id", "w.fp", "w.len", "kind", "start", "end").agg(
        flag(overlap & F.col("strong")).alias("inside"),
        *[flag(~overlap & (F.col("role") == r)).alias(f"has_{r}") for r in ("id", "secret", "endpoint")])
    kind = {k: F.lit(ORDER.index(k)) for k in ORDER}
    complete = (F.when(F.col("kind") == kind["weak"], F.expr("has_id + has_endpoint > 0"))
                .when(F.col("kind") == kind["ident"], F.expr("has_secret > 0"))
                .otherwise(F.expr("has_id > 0 and has_secret > 0")))
    return beside.filter((F.col("inside") == 0) & complete).select("id", "fp", "len", "kind", "start", "end")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs``: doc_id and spans, an array of (start, kind, end) in that order.

    kind is the place in ``ORDER``; positions are code points, the end exclusive.
    A null text is empty.  Rows that repeat both id and text get the same spans;
    a null doc_id keeps its row.  An empty table gives an empty result; other
    columns are not read.
    """
    parts = materialize(find_parts(docs))
    spans = parts.filter(F.col("kind") < len(BASE)).unionByName(link_parts(parts, scope))
    spans = spans.groupBy("id", "fp", "len").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    rows, spans = row_key(docs), small_or_shuffled(spans)
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    return rows.join(spans, same_row(rows, spans), "left").select(rows["id"].alias("doc_id"), F.coalesce("spans", none).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in ORDER])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents"))
    kinds = F.col("spans.kind")
    count = [F.coalesce(F.size(F.filter(kinds, lambda x: x == F.lit(k))), F.lit(0)).cast("long").alias(f"n_{name}")
             for k, name in enumerate(BASE)]
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return out.select("doc_id", *count, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_FOUND = " UNION ALL ".join(f"""
SELECT doc_id, {i} AS kind, i, length(p) AS piece, regexp_extract(p, {_quoted(KINDS[k][0])}, 0) AS m,
  regexp_extract(p, {_quoted(KINDS[k][0])}, {2 if "([A" in KINDS[k][0] else 0}) AS v
FROM (SELECT doc_id, unnest(l) AS p, unnest(range(len(l))) AS i FROM (
  SELECT doc_id, regexp_extract_all(text, {_quoted("(?s:.*?)(?:" + KINDS[k][0] + ")")}, 0) AS l FROM d))""" for i, k in enumerate(ORDER))

OP4_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({_FOUND}),
p AS (SELECT doc_id, kind, m, v, CAST(sum(piece) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e FROM f),
s AS (SELECT doc_id, kind, e - length(m) AS s, e,
        CASE WHEN kind IN (1, 3) THEN 'id' WHEN kind = 4 THEN 'endpoint' ELSE 'secret' END AS role FROM p
      WHERE CASE kind WHEN 0 THEN length(v) >= 8 WHEN 1 THEN length(m) >= 16 WHEN 3 THEN length(v) >= 3
        WHEN 5 THEN regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') ELSE true END),
l AS (SELECT w.doc_id, w.kind, w.s, w.e, max(o.s < w.e AND o.e > w.s AND o.kind < 3) AS inside,
        max(o.role = 'id' AND NOT (o.s < w.e AND o.e > w.s)) AS has_id,
        max(o.role = 'secret' AND NOT (o.s < w.e AND o.e > w.s)) AS has_secret,
        max(o.role = 'endpoint' AND NOT (o.s < w.e AND o.e > w.s)) AS has_endpoint
      FROM s w JOIN s o ON o.doc_id = w.doc_id AND o.s <= w.e + {SCOPE} AND o.e >= w.s - {SCOPE}
      WHERE w.kind >= 3 GROUP BY ALL),
r AS (SELECT doc_id, kind, s, e FROM s WHERE kind < 3 UNION ALL
      SELECT doc_id, kind, s, e FROM l WHERE NOT inside AND CASE kind WHEN 5 THEN has_id OR has_endpoint
        WHEN 3 THEN has_secret ELSE has_id AND has_secret END),
t AS (SELECT *, [{", ".join(_quoted(k) for k in ORDER)}][kind + 1] || ':' || s || ':' || e AS x FROM r),
g AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
        string_agg(x, ',' ORDER BY s, kind, e) FILTER (kind < 3) AS base, string_agg(x, ',' ORDER BY s, kind, e) AS spans FROM t GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)
"""
