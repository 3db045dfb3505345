"""Rows every operator must take: nulls, empties, long texts, ties, repeats, extra columns with clashing names."""

LONG = "Long words of one line go on. " * 20_000
ROWS = [
    (1, "Plain words stand here in a line.\nAnother line of plain words stands there too.", "en", "a"),
    (2, "Plain words stand here in a line.\nAnother line of plain words stands there too.", "en", "a"),
    (2, "Plain words stand here in a line.\nAnother line of plain words stands there too.", "en", "a"),
    (3, None, None, None),
    (4, "", "en", ""),
    (5, " \n\t \n", "en", "b"),
    (6, LONG, "en", "b"),
    (7, "é" * 40 + " ü 漢字   x", "de", None),
    (None, "No id has this row of several plain words.", "en", "a"),
    (None, "No id has this row of several plain words.", "en", "a"),
    (None, None, None, None),
    (8, "x" * 50_000, "en", "c"),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["fp", "id", "row", "size", "key", "component", "component_id", "score", "found", "lines", "spans", "bucket", "label", "host"]


def docs(spark, rows=ROWS, extra=True):
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], COLUMNS)
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHING]) if extra else df


def benchmark(spark):
    return spark.createDataFrame(
        [(1, "plain words stand here"), (2, None), (None, "Another line of plain words stands there too"), (3, ""),
         (4, "go on long words of one line go on long words of one line go on long words")], "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (6, 1, None), (None, 1, 1), (7, None, 0), (99, 0, 1)],
                                 "doc_id long, quality int, toxic int")
