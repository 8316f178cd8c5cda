import zlib

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Make a documents table; extra columns clash with names the operators use inside."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)
        if extra:
            df = df.selectExpr("*", "1 as score", "'x' as length", "2 as part", "3 as key", "4 as n", "5 as span", "6 as _key", "7 as _text",
                               "8 as _id", "'b' as _body", "9 as _spans", "10 as row", "11 as own_id", "12 as body", "13 as n_near", "14 as lo")
        return df

    return make


@pytest.fixture
def folded():
    return lambda doc_id, folds: zlib.crc32(str(doc_id).encode()) % folds
