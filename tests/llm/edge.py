"""A small table with the awkward cases: nulls, ties, repeats, long texts, clashing names."""

from pyspark.sql import functions as F

LINE = "This line of more than forty characters is on many pages"
LONG = " ".join(f"word{i % 977}" for i in range(40_000))
ROWS = [
    (1, "alpha beta gamma\n" + LINE, "en"),
    (2, "\t" + LINE.upper() + " \nother words here", "en"),
    (3, LINE + "\n" + LINE + "\nend", "en"),
    (4, LINE, "de"),
    (5, "x\n" + LINE, "de"),
    (5, "x\n" + LINE, "de"),  # a repeated row
    (6, None, "fr"),
    (7, "", "fr"),
    (None, "x\n" + LINE + "\ny", None),
    (None, None, None),
    (8, LONG, "en"),
    (9, LONG, "en"),
    (10, "12 34 !!", "en"),
    (11, "Ünïcödé straße 漢字 🙂 Ǆ İ", "de"),
    (12, "\n\n\n", "de"),
    (13, "one", "en"),
]
#: Names that the operators use inside.
CLASH = ("row", "out", "n", "id", "fp", "lines", "words", "hits", "suspects", "of", "key", "u0", "g", "draw", "a.b", "n_chars")


def frame(spark, rows=ROWS, clash=True):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for name in CLASH if clash else ():
        df = df.withColumn(name, F.lit(7))
    return df


def tuples(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
