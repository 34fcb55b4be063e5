"""Awkward rows: nulls, empty and long texts, ties, repeats, and extra columns whose
names clash with those the operators use."""

from __future__ import annotations

LONG = "lorem " * 30_000 + "x" * 200_000
DOCS = [
    (1, None, "en", "b", 0), (2, "", "en", "b", 0), (3, " \t\n ", None, None, 1), (None, "null id text", "en", None, 1),
    (4, "one", "de", "a", 2), (4, "one", "de", "a", 2), (5, "one", "de", "a", 2), (5, "other text here", None, "a", 2),
    (6, LONG, "en", "c", 3), (7, "the cat sat on the mat and the dog lay by the door", "en", "a", 4),
    (8, "The CAT sat on the mat and the dog lay by the door!", "en", "a", 5),
    (9, "üñï 𝒳𝒴 emoji 😀 a@b.co, \x0b +1 (555) 123-4567 4111 1111 1111 1111 10.0.0.1 999.1.1.1", "fr", "é", 6),
    (10, "line\nline\nline\nline\n" + "w " * 40, "en", "a", 7), (11, "AAAA BBBB " * 30, "en", "a", 7),
    *((100 + i, "copy of the same passage " * 6, "en", "hot", 8) for i in range(60)),
    *((200 + i, f"near copy {'and more words of it ' * 30} {i % 3}", "en", "hot", 9) for i in range(30)),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = "row_id _rank _cell _unit _group size n shard slot copies taken fp u v s votes base extra spans row held_out".split()


def docs(spark, rows=None):
    df = spark.createDataFrame(DOCS if rows is None else rows, SCHEMA)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASHES}).repartition(5)


def parquet(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
