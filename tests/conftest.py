import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, memory="4g", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows as a DataFrame; times are naive UTC datetimes."""

    def make(rows, schema):
        plain = schema.replace("TIMESTAMP", "STRING")
        texts = [tuple(v.isoformat(sep=" ") if isinstance(v, datetime) else v for v in row) for row in rows]
        df = spark.createDataFrame(texts, plain)
        for column in schema.split(","):
            name, kind = column.split()
            if kind == "TIMESTAMP":
                df = df.withColumn(name, df[name].cast("timestamp_ntz"))
        return df

    return make


def tuples(df):
    return [tuple(row) for row in df.collect()]
