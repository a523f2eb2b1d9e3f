from datetime import datetime

import pytest
from conftest import tuples

from ledgerline.sources import schemas
from ledgerline.sources.snapshots import SnapshotStore

NOW = datetime(2024, 5, 1, 12)


def test_old_extract_takes_the_current_shape(frame):
    old = frame([(1, 2, "S", "", "", NOW, None, 0)], "Id INT, stateid INT, statename STRING, invocationdata STRING, arguments STRING, createdat TIMESTAMP, expireat TIMESTAMP, updatecount INT")
    new = schemas.normalize_snapshot(old, "job")
    assert new.columns == schemas.SCHEMAS["job"].names
    assert [f.dataType for f in new.schema] == [f.dataType for f in schemas.SCHEMAS["job"]]
    assert tuples(new) == [(1, 2, "S", "{}", "[]", NOW, None)]


def test_missing_update_count_is_zero(frame):
    old = frame([(1, 1, "q", None)], "id LONG, jobid LONG, queue STRING, fetchedat TIMESTAMP")
    assert schemas.normalize_snapshot(old, "jobqueue").first().updatecount == 0


def test_empty_payloads_become_empty_documents(frame):
    rows = frame([(None, ""), ("x", "[1]")], "invocationdata STRING, arguments STRING")
    assert tuples(schemas.fill_payloads(rows, "job")) == [("{}", "[]"), ("x", "[1]")]


def test_a_version_appears_whole_or_not_at_all(spark, frame, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.current() is None
    with pytest.raises(ValueError):
        store.read("counter")
    rows = frame([(1, "k", 5, NOW)], "id LONG, key STRING, value LONG, expireat TIMESTAMP")
    assert store.publish({"counter": rows, "aggregatedcounter": rows}) == 0
    broken = rows.selectExpr("id", "key", "raise_error('lost') AS value", "expireat")
    with pytest.raises(Exception, match="lost"):
        store.publish({"counter": rows.limit(0), "aggregatedcounter": broken})
    assert store.current() == 0 and store.read("counter").count() == 1
    assert store.publish({"counter": rows.limit(0)}, cluster_by={"counter": ["key"]}) == 1
    assert store.read("counter").count() == 0 and store.read("counter", 0).count() == 1


def test_old_versions_can_go_but_not_the_newest(spark, frame, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    rows = frame([(1, "k", 5, NOW)], "id LONG, key STRING, value LONG, expireat TIMESTAMP")
    for _ in range(3):
        store.publish({"counter": rows})
    store.drop_before(99)
    assert store.current() == 2 and store.read("counter").count() == 1
    with pytest.raises(ValueError):
        store.read("counter", 0)


def test_a_version_keeps_the_tables_it_does_not_publish(spark, frame, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    rows = frame([(1, "k", 5, NOW)], "id LONG, key STRING, value LONG, expireat TIMESTAMP")
    server = frame([("s", "{}", NOW)], "id STRING, data STRING, lastheartbeat TIMESTAMP")
    store.publish({"counter": rows, "aggregatedcounter": rows, "server": server})
    for _ in range(3):
        store.publish({"counter": rows.limit(0), "aggregatedcounter": rows})
    assert store.read("server").count() == 1 and store.read("counter").count() == 0
    assert store.read("server", 1).count() == 1 and store.read("counter", 0).count() == 1
    store.drop_before(store.current())
    assert tuples(store.read("server")) == [("s", "{}", NOW)] and store.read("aggregatedcounter").count() == 1
    with pytest.raises(ValueError):
        store.read("list")


def test_publishing_a_version_twice_changes_nothing(spark, frame, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    rows = frame([(1, "k", 5, NOW)], "id LONG, key STRING, value LONG, expireat TIMESTAMP")
    store.publish({"counter": rows}, 3)
    store.publish({"counter": rows.limit(0)}, 3)
    assert store.read("counter").count() == 1


def test_read_uses_the_declared_schema(spark, frame, tmp_path):
    frame([("s", "{}", NOW)], "id STRING, data STRING, lastheartbeat TIMESTAMP").write.parquet(f"{tmp_path}/server")
    assert tuples(schemas.read_table(spark, f"{tmp_path}/server", "server")) == [("s", "{}", NOW)]
