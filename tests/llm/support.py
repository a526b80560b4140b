"""Rows that every operator must bear: nulls, empty and long texts, ties, repeated rows, clashing column names."""

DOCS = [
    (1, "one two three four five six seven eight nine ten\nsecond line of the text", "en", "a", 5),
    (1, "one two three four five six seven eight nine ten\nsecond line of the text", "en", "a", 5),
    (2, None, "en", "a", None), (3, "", None, None, 0), (None, "a text without an id is still a text", "en", "b", 1),
    (None, None, None, None, None), (4, " \n\t\n ", "en", "b", 1), (5, "x " * 30_000, "en", "c", 60_000),
    (6, "ünïcödé 😀 text with ßharp words", "de", "c", 3), (2, "another text under id two", "fr", "a", 2),
]


def docs_frame(spark):
    """DOCS with extra columns named like ones the operators use inside."""
    df = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("clash") for c in ("n", "words", "sig", "line", "size", "copies", "kind", "gone", "target")})
