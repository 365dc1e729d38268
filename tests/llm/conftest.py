import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, __x long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from strobe.session import ship_package

    ship_package(spark)


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with the columns of the table and
    some whose names operators might use."""

    def make(pairs, extra=True):
        rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            for name in ("_label", "kept", "base", "open", "node", "key", "score", "component", "signature"):
                df = df.withColumn(name, df["doc_id"] * 0 - 1)
        return df

    return make
