import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (id, text, lang, source) with columns of awkward names beside them."""

    def of(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] else None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.withColumns({c: F.lit(-1) for c in ("row", "size", "component", "_src", "key", "copies", "n", "taken", "a.b", "c`d")})

    return of
