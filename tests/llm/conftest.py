"""Small tables for the text operators."""

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts, first=0, extra=False):
        """A documents table; ``extra`` adds columns whose names operators use themselves."""
        rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        if extra:
            for name in ("fp", "ids", "score", "n_tokens", "key", "__id", "rejected", "failures"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
