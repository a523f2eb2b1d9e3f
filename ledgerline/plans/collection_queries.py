"""Keyed-collection reads as named queries."""

from __future__ import annotations

from ledgerline.operators import collections as keyed
from ledgerline.plans.mapping import ASOF_EVENTS, ASOF_JOBS, Ledger
from ledgerline.plans.registry import query

SCORES = (0.0, 5000.0)
TOP = 25
START, END = 2, 20

query("set_items", "SELECT key, value FROM ll_set")(lambda ledger: keyed.set_items(ledger["set"]))

query(
    "set_lowest",
    f"""
SELECT key, value FROM (SELECT key, value, row_number() OVER (PARTITION BY key ORDER BY score, id) AS rn
                        FROM ll_set WHERE score BETWEEN {SCORES[0]} AND {SCORES[1]}) WHERE rn = 1""",
)(lambda ledger: keyed.set_lowest(ledger["set"], *SCORES))

query(
    "set_lowest_n",
    f"""
SELECT key, rank, value, score
FROM (SELECT key, value, score, row_number() OVER (PARTITION BY key ORDER BY score, id) AS rank
      FROM ll_set WHERE score BETWEEN {SCORES[0]} AND {SCORES[1]}) WHERE rank <= {TOP}""",
)(lambda ledger: keyed.set_lowest_n(ledger["set"], *SCORES, TOP))


def _range_check(table: str, order: str) -> str:
    return f"""
SELECT key, rn - 1 AS position, value
FROM (SELECT key, value, row_number() OVER (PARTITION BY key ORDER BY {order}) AS rn FROM ll_{table})
WHERE rn BETWEEN {START + 1} AND {END + 1}"""


query("set_range", _range_check("set", "id"))(lambda ledger: keyed.set_range(ledger["set"], START, END))
query("list_range", _range_check("list", "id DESC"))(lambda ledger: keyed.list_range(ledger["list"], START, END))

query(
    "list_items",
    "SELECT key, row_number() OVER (PARTITION BY key ORDER BY id DESC) - 1 AS position, value FROM ll_list",
)(lambda ledger: keyed.list_items(ledger["list"]))

query(
    "trim_list",
    f"""
SELECT source.id, source.key, source.value, source.expireat FROM ll_list source
WHERE source.id IN (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY key ORDER BY id) AS rn FROM ll_list)
                    WHERE rn BETWEEN {START + 1} AND {END + 1})""",
)(lambda ledger: keyed.trim_lists(ledger["list"], START, END))

for _table, _asof in (("set", ASOF_EVENTS), ("list", ASOF_JOBS), ("hash", ASOF_EVENTS)):
    query(f"{_table}_count", f"SELECT key, count(key) AS n FROM ll_{_table} GROUP BY key")(
        lambda ledger, table=_table: keyed.key_counts(ledger[table])
    )
    query(
        f"{_table}_ttl",
        f"""
SELECT key, coalesce(date_diff('microsecond', {{TS:{_asof}}}, min(expireat)) / 1e6, -1e0) AS ttl_seconds
FROM ll_{_table} GROUP BY key""",
    )(lambda ledger, table=_table, asof=_asof: keyed.key_ttl(ledger[table], asof))

query("hash_entries", "SELECT key, field, value FROM ll_hash")(lambda ledger: keyed.hash_entries(ledger["hash"]))

query("hash_value", "SELECT key, value FROM ll_hash WHERE field = 'Brand'")(
    lambda ledger: keyed.hash_value(ledger["hash"], "Brand")
)

query(
    "counter_value",
    """
SELECT key, CAST(sum(value) AS BIGINT) AS value
FROM (SELECT key, value FROM ll_counter UNION ALL SELECT key, value FROM ll_aggregatedcounter) GROUP BY key""",
)(lambda ledger: keyed.counter_value(ledger["counter"], ledger["aggregatedcounter"]))


@query(
    "counter_value_of_jobs_done",
    """
SELECT DISTINCT k.key, CAST(coalesce((SELECT sum(value) FROM (SELECT key, value FROM ll_counter UNION ALL
  SELECT key, value FROM ll_aggregatedcounter) c WHERE c.key = k.key), 0) AS BIGINT) AS value
FROM (SELECT 'stats:' || event_type AS key FROM events
      UNION SELECT 'stats:succeeded' UNION SELECT 'stats:deleted') k""",
)
def _asked_counters(ledger: Ledger):
    asked = ledger.source("events").selectExpr("'stats:' || event_type AS key").distinct()
    fixed = ledger.spark.sql("SELECT explode(array('stats:succeeded', 'stats:deleted')) AS key")
    return keyed.counter_value(ledger["counter"], ledger["aggregatedcounter"], asked.union(fixed))
