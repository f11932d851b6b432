import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from (doc_id, text[, lang, source]) rows."""

    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if extra:  # columns with names that the operators use inside
            from pyspark.sql import functions as F

            clash = ("size", "start", "bucket", "node", "digest", "text_key", "row", "words", "label", "score", "kept", "d")
            df = df.withColumns({c: F.lit(f"x-{c}") for c in clash})
        return df

    return make
