"""Every named query against its SQL, over the whole supplied tables at sf0.01."""

import os

import pytest

import test_apply

import __spark_entry__ as entry
import check
from ledgerline.plans.apply_queries import FIRST_ID
from ledgerline.plans.mapping import Ledger
from ledgerline.plans.registry import all_checks, all_queries

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables are absent")


@pytest.fixture(scope="module")
def engine():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, engine, name):
    outcome = check.check(spark, engine, FOLDER, name)
    assert outcome.startswith("ok") and not outcome.endswith("EMPTY"), outcome


def collected(df):
    return [tuple(row) for row in df.collect()]


def test_list_query_equals_replay(spark):
    ledger = Ledger(spark, SMALL)
    start = collected(ledger["keyed_snapshot"].select("id", "key", "item", "expireat"))
    log = []
    for seq, key, item, op, at, low, high in sorted(
        collected(
            ledger["list_commands"].where("committed").select("seq", "key", "item", "op", "expire_at", "trim_from", "trim_to")
        )
    ):
        log.append((seq, key, item, "trim", None, 1, 20) if op == "expire" else (seq, key, item, op, at, low, high))
    got = entry.queries()["apply_list_with_trims"](spark, SMALL).collect()
    want = test_apply.replay_list(start, log, base=FIRST_ID)
    assert sorted(str(list(row)) for row in got) == want


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_checks())


def test_flagship(spark):
    assert entry.entry(spark).columns[0] == "job_id"
