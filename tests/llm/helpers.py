"""Small tables with the cases every operator has to bear."""

LONG = "word " * 60_000 + "x" * 3_000


def documents(spark, rows, extra=True):
    """Documents from (doc_id, text) or whole rows; with columns whose names operators use inside."""
    rows = [(*row, "en", "s", None)[:5] if len(row) == 2 else row for row in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if not extra:
        return docs
    clash = ("id", "block", "codes", "ids", "n", "row", "bucket", "component_id", "kept", "size", "word", "range", "part")
    return docs.selectExpr("*", *(f"doc_id AS {c}" for c in clash))


CASES = [(1, "A plain text, with some words."), (2, None), (3, ""), (4, "   \n\n \t"), (None, "no key"), (None, None),
         (5, "twice the same row"), (5, "twice the same row"), (6, LONG), (7, "汉字 и кириллица 😀 été"), (8, "\u0000 \x1c '' !!")]
