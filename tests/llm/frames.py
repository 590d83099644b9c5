"""Small frames with the awkward cases every operator must handle."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, size int, source_size int, shard string"

LONG = "lorem ipsum dolor " * 60_000        # over a megabyte, one text


def docs(spark, rows, extra=True):
    """(doc_id, text[, source]) rows as a documents frame with clashing extra columns."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1]) if r[1] else 0, 7, 8, 9, "x") for r in rows]
    df = spark.createDataFrame(full, DOCS)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def collect(df):
    return [tuple(r) for r in df.collect()]
