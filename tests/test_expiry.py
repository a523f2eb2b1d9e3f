import re
from datetime import datetime, timedelta

import pytest
from conftest import tuples
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from ledgerline.operators import expiry, maintain

NOW = datetime(2024, 5, 10, 12)
SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()), StructField("expireat", TimestampNTZType())])


def rows(hours):
    return [(i, f"r{i}", None if h is None else NOW + timedelta(hours=h)) for i, h in enumerate(hours)]


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.glob("*/*.parquet")}


@pytest.mark.parametrize(
    "hours",
    [
        [-100, -30, -13, -12, -1, 0, 0, 1, 11, 12, 40, None, None],  # before, around and after the day
        [-5, -1],  # nothing lives on
        [0, 5, 100, None],  # nothing goes
        [None, None],
        [-400, -300],
        [],
    ],
)
def test_purge_leaves_what_a_filter_leaves(spark, tmp_path, hours):
    table = spark.createDataFrame(rows(hours), SCHEMA)
    path = str(tmp_path / "t")
    expiry.write_by_expiry(table, path)
    want = sorted(tuples(maintain.purge(table, NOW)), key=str)
    before = files(tmp_path / "t")
    # Twice: a purge that is run again finds nothing to do.
    for _ in range(2):
        if hours:
            lazily = expiry.outliving(expiry.read_by_expiry(spark, path, SCHEMA), NOW).drop(expiry.DAY)
            assert sorted(tuples(lazily), key=str) == want
        expiry.purge_by_expiry(spark, path, SCHEMA, NOW)
        left = spark.createDataFrame([], SCHEMA) if not (tmp_path / "t").exists() else expiry.read_by_expiry(spark, path, SCHEMA).drop(expiry.DAY)
        assert sorted(tuples(left), key=str) == want
    after = files(tmp_path / "t")
    untouched = lambda found: {k: v for k, v in found.items() if k.split("/")[0] > "expireday=2024-05-10"}
    assert untouched(after) == untouched(before)
    assert not any(k.split("/")[0] < "expireday=2024-05-10" for k in after if "__HIVE" not in k)


def test_months(spark, tmp_path):
    table = spark.createDataFrame(rows([-2000, -300, -200, -1, 0, 1, 400, 2000, None]), SCHEMA)
    path = str(tmp_path / "t")
    expiry.write_by_expiry(table, path, unit="month")
    want = sorted(tuples(maintain.purge(table, NOW)), key=str)
    read = lambda: expiry.read_by_expiry(spark, path, SCHEMA)
    assert sorted(tuples(expiry.outliving(read(), NOW, "month").drop(expiry.DAY)), key=str) == want
    expiry.purge_by_expiry(spark, path, SCHEMA, NOW, "month")
    assert sorted(tuples(read().drop(expiry.DAY)), key=str) == want
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {
        "expireday=2024-05-01", "expireday=2024-08-01", "expireday=__HIVE_DEFAULT_PARTITION__"
    }


def test_days_that_are_over_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    expiry.write_by_expiry(spark.createDataFrame(rows([-100, -50, -30, -1, 1, 30, None]), SCHEMA), path)
    living = expiry.outliving(expiry.read_by_expiry(spark, path, SCHEMA), NOW)
    text = living._jdf.queryExecution().explainString(living._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PartitionFilters: \[.*expireday", text)
    read = {f.rsplit("/", 2)[1] for f in living.inputFiles()}
    scan = living._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert len(read) == 6 and scan.selectedPartitions().totalNumberOfFiles() < len(living.inputFiles()) - 1


def test_rows_that_never_expire_are_split(spark, tmp_path):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        hours = [None] * 30_000 + [24 * d for d in range(1, 6)] * 20
        expiry.write_by_expiry(spark.createDataFrame(rows(hours), SCHEMA).repartition(8), str(tmp_path / "t"))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    per = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").iterdir() if p.is_dir()}
    # Days alone in their shuffle partition have one file each.
    assert per.pop("expireday=__HIVE_DEFAULT_PARTITION__") > 1 and min(per.values()) == 1 and len(per) == 5
