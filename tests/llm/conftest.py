import os

os.environ.setdefault("OMP_NUM_THREADS", "1")  # small matrices; threads only get in each other's way
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

import pytest

EMPTY = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, source]) tuples; extra columns clash with names used inside operators."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else 0, 1, "x") for r in rows]
        return spark.createDataFrame(full, EMPTY + ", size INT, `key` STRING")

    return make
