"""The supplied star-schema tables seen as a ledger.

Each view is one SQL text that both Spark and a checking engine run; it depends on column values
only. ``@name`` is a supplied table, ``{TS:...}`` a timestamp literal, ``{TSTYPE}`` its type.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The clocks that stand for "now": one for the order-based tables, one for the event-based ones.
ASOF_JOBS = "1999-01-01 00:00:00"
ASOF_EVENTS = "2024-01-25 12:00:00"
ROLLUP_CUT = "2024-01-20 00:00:00"

_DAY = "replace(substr(CAST(l_shipdate AS STRING), 1, 19), ' ', 'T') || 'Z\"'"

VIEWS = {
    "state": f"""
SELECT ((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey AS id,
       l_orderkey AS jobid,
       CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Failed'
            WHEN l_returnflag = 'A' THEN 'Deleted'
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Succeeded'
            WHEN l_returnflag = 'N' THEN 'Enqueued'
            WHEN l_linestatus = 'F' THEN 'Processing'
            ELSE 'Scheduled' END AS name,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'reason ' || CAST(l_linenumber AS STRING) END AS reason,
       l_shipdate + l_linenumber * INTERVAL '1' HOUR AS createdat,
       CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN
              '{{"FailedAt":"' || {_DAY} || ',"ExceptionType":"E' || CAST(l_suppkey % 10 AS STRING)
                || '","ExceptionMessage":"m","ExceptionDetails":"d"}}'
            WHEN l_returnflag = 'A' THEN '{{"DeletedAt":"' || {_DAY} || '}}'
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' AND l_linenumber % 3 = 0 THEN
              '{{"SUCCEEDEDAT":"' || {_DAY} || ',"PerformanceDuration":"' || CAST(l_partkey AS STRING) || '"}}'
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN
              '{{"SucceededAt":"' || {_DAY} || ',"PerformanceDuration":"' || CAST(l_partkey AS STRING)
                || '","latency":"' || CAST(l_suppkey AS STRING) || '"}}'
            WHEN l_returnflag = 'N' THEN '{{"EnqueuedAt":"' || {_DAY} || ',"Queue":"default"}}'
            WHEN l_linestatus = 'F' AND l_linenumber % 2 = 0 THEN
              '{{"StartedAt":"' || {_DAY} || ',"ServerId":"srv-' || CAST(l_suppkey AS STRING) || '"}}'
            WHEN l_linestatus = 'F' THEN
              '{{"StartedAt":"' || {_DAY} || ',"ServerName":"srv-' || CAST(l_suppkey AS STRING) || '"}}'
            ELSE '{{"EnqueueAt":"' || {_DAY} || ',"ScheduledAt":"' || {_DAY} || '}}' END AS data
FROM @lineitem""",
    # The latest state is picked by a number: an aggregate of numbers is hashed, one of text is sorted.
    "job": """
SELECT o.o_orderkey AS id, s.stateid, s.statename,
       '{"Type":"T' || CAST(o.o_custkey % 7 AS STRING) || '","Method":"M' || CAST(o.o_custkey % 3 AS STRING) || '"}'
         AS invocationdata,
       '["' || chr(92) || '"' || o.o_orderstatus || chr(92) || '""]' AS arguments,
       o.o_orderdate AS createdat,
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE o.o_orderdate + (o.o_orderkey % 40) * INTERVAL '1' DAY END
         AS expireat
FROM @orders o
LEFT JOIN (
  SELECT jobid, stateid,
         CASE code WHEN 1 THEN 'Failed' WHEN 2 THEN 'Deleted' WHEN 3 THEN 'Succeeded' WHEN 4 THEN 'Enqueued'
                   WHEN 5 THEN 'Processing' ELSE 'Scheduled' END AS statename
  FROM (SELECT jobid, max(id) AS stateid,
               max_by(CASE name WHEN 'Failed' THEN 1 WHEN 'Deleted' THEN 2 WHEN 'Succeeded' THEN 3
                                WHEN 'Enqueued' THEN 4 WHEN 'Processing' THEN 5 ELSE 6 END, id) AS code
        FROM ll_state GROUP BY jobid)) s
  ON s.jobid = o.o_orderkey""",
    "jobparameter": """
SELECT o_orderkey * 2 AS id, o_orderkey AS jobid, 'RetryCount' AS name, CAST(o_orderkey % 10 AS STRING) AS value
FROM @orders
UNION ALL
SELECT o_orderkey * 2 + 1, o_orderkey, 'CurrentCulture', CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE '"en-US"' END
FROM @orders WHERE o_orderstatus <> 'F'""",
    "jobqueue": """
SELECT o_orderkey * 2 AS id,
       CASE WHEN o_orderkey % 97 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS jobid,
       lower(substr(o_orderpriority, 3)) AS queue,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL
            ELSE {TS:1999-01-01 00:00:00} - (o_orderkey % 60) * INTERVAL '1' MINUTE END AS fetchedat,
       CAST(o_orderkey % 3 AS INT) AS updatecount
FROM @orders
UNION ALL
SELECT o_orderkey * 2 + 1, o_orderkey, lower(substr(o_orderpriority, 3)),
       CASE WHEN o_orderkey % 3 = 0 THEN NULL
            ELSE {TS:1999-01-01 00:00:00} - (o_orderkey % 45) * INTERVAL '1' MINUTE END, 0
FROM @orders WHERE o_orderpriority = '1-URGENT'""",
    # A second queue source: one waiting row per document.
    "jobqueue_documents": """
SELECT CAST(doc_id AS BIGINT) AS id, CAST(doc_id AS BIGINT) AS jobid, lang AS queue,
       CAST(NULL AS {TSTYPE}) AS fetchedat, 0 AS updatecount
FROM @documents""",
    "event_kind": """
SELECT event_id, ts, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'deleted' ELSE 'succeeded' END AS kind,
       CAST(CASE WHEN event_id % 10 = 0 THEN -1 ELSE 1 END AS BIGINT) AS delta
FROM @events""",
    "counter_all": """
SELECT event_id * 3 AS id, 'stats:' || kind AS key, delta AS value, CAST(NULL AS {TSTYPE}) AS expireat, ts
FROM ll_event_kind
UNION ALL
SELECT event_id * 3 + 1, 'stats:' || kind || ':' || substr(CAST(ts AS STRING), 1, 10), delta, ts + INTERVAL '30' DAY, ts
FROM ll_event_kind
UNION ALL
SELECT event_id * 3 + 2, 'stats:' || kind || ':' || substr(CAST(ts AS STRING), 1, 10) || '-'
         || substr(CAST(ts AS STRING), 12, 2), delta, ts + INTERVAL '1' DAY, ts
FROM ll_event_kind""",
    "counter": """
SELECT id, key, value, expireat FROM ll_counter_all WHERE ts >= {TS:2024-01-20 00:00:00}""",
    "aggregatedcounter": """
SELECT min(id) AS id, key, CAST(sum(value) AS BIGINT) AS value, max(expireat) AS expireat
FROM ll_counter_all WHERE ts < {TS:2024-01-20 00:00:00} GROUP BY key""",
    "set": """
SELECT c_custkey AS id, 'seg:' || c_mktsegment AS key, c_acctbal AS score, c_name AS value,
       CASE WHEN c_custkey % 7 = 0 THEN {TS:2024-01-25 12:00:00} + (c_custkey % 11 - 5) * INTERVAL '1' HOUR
            ELSE NULL END AS expireat
FROM @customer
UNION ALL
SELECT s_suppkey + 1000000000, 'recurring-jobs', s_acctbal, s_name, CAST(NULL AS {TSTYPE}) FROM @supplier""",
    "list": """
SELECT o_orderkey AS id, 'cust:' || CAST(o_custkey AS STRING) AS key,
       o_orderstatus || CAST(o_orderkey % 4 AS STRING) AS value,
       CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate + INTERVAL '10' DAY ELSE NULL END AS expireat
FROM @orders""",
    "hash": """
SELECT p_partkey * 4 AS id, 'recurring-job:' || CAST(p_partkey AS STRING) AS key, 'Name' AS field, p_name AS value,
       CAST(NULL AS {TSTYPE}) AS expireat FROM @part
UNION ALL
SELECT p_partkey * 4 + 1, 'recurring-job:' || CAST(p_partkey AS STRING), 'Brand', p_brand, CAST(NULL AS {TSTYPE})
FROM @part
UNION ALL
SELECT p_partkey * 4 + 2, 'recurring-job:' || CAST(p_partkey AS STRING), 'Size', CAST(p_size AS STRING),
       {TS:2024-01-25 12:00:00} + (p_size - 25) * INTERVAL '1' HOUR FROM @part WHERE p_type <> 'ECONOMY'""",
    "server": """
SELECT 'srv-' || CAST(s_suppkey AS STRING) AS id,
       '{"WorkerCount":' || CAST(s_suppkey % 20 + 1 AS STRING) || ',"Queues":["urgent","low"],"StartedAt":"2024-01-0'
         || CAST(s_suppkey % 9 + 1 AS STRING) || 'T00:00:00Z"}' AS data,
       {TS:2024-01-25 12:00:00} - (s_suppkey % 20) * INTERVAL '1' MINUTE AS lastheartbeat
FROM @supplier""",
    # Command logs: k is the number in props; five consecutive events form a transaction.
    "cmd_base": """
SELECT event_id AS seq, event_id - event_id % 5 AS txn_id, (event_id - event_id % 5) % 35 <> 0 AS committed,
       ts, user_id, event_type, value AS amount,
       CAST(replace(replace(props, '{"k": ', ''), '}', '') AS BIGINT) AS k
FROM @events""",
    "keyed_commands": """
SELECT seq, txn_id, committed, ts, 'k' || CAST(user_id AS STRING) AS key, 'v' || CAST(k % 10 AS STRING) AS item,
       CASE WHEN seq % 211 = 0 THEN 'remove_key'
            WHEN event_type IN ('click', 'view') THEN 'add'
            WHEN event_type = 'purchase' THEN 'add_score'
            WHEN event_type = 'signup' AND seq % 2 = 0 THEN 'expire'
            WHEN event_type = 'signup' THEN 'persist'
            ELSE 'remove' END AS op,
       CASE WHEN event_type = 'purchase' THEN amount ELSE CAST(0 AS DOUBLE) END AS score,
       CASE WHEN event_type = 'purchase' THEN 'p' || CAST(k AS STRING) ELSE 'e' || CAST(seq AS STRING) END AS value,
       CASE WHEN event_type = 'signup' AND seq % 2 = 0 THEN ts + INTERVAL '1' DAY ELSE NULL END AS expire_at
FROM ll_cmd_base""",
    "keyed_snapshot": """
SELECT c_custkey AS id, 'k' || CAST(CAST((c_custkey - c_custkey % 10) / 10 AS BIGINT) AS STRING) AS key,
       'v' || CAST(c_custkey % 10 AS STRING) AS item, c_acctbal AS score,
       CASE WHEN c_custkey % 4 = 0 THEN {TS:2024-02-15 00:00:00} ELSE NULL END AS expireat
FROM @customer""",
    # Lists know no whole-key removal; a trim that keeps nothing has the same effect.
    "list_commands": """
SELECT seq, txn_id, committed, ts, key, item,
       CASE op WHEN 'add' THEN 'insert' WHEN 'add_score' THEN 'insert' WHEN 'remove_key' THEN 'trim' ELSE op END AS op,
       CASE WHEN op = 'remove_key' THEN 1 END AS trim_from, CASE WHEN op = 'remove_key' THEN 0 END AS trim_to, expire_at
FROM ll_keyed_commands""",
    "job_requests": """
SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '{"Type":"T' || o_orderstatus || '"}' END
         AS invocationdata,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE '["1"]' END AS arguments, o_orderdate AS createdat,
       o_custkey + 0.25 AS expire_in, CAST(o_custkey % 10 AS STRING) AS retries, o_orderpriority AS priority
FROM @orders""",
    "job_commands": """
SELECT seq, txn_id, committed, ts, user_id * 7 + k % 7 + CASE WHEN seq % 503 = 0 THEN 2000000000 ELSE 0 END AS jobid,
       CASE event_type WHEN 'click' THEN 'set_state' WHEN 'view' THEN 'set_state' WHEN 'purchase' THEN 'add_state'
                       WHEN 'signup' THEN 'expire_job' ELSE 'persist_job' END AS op,
       CASE event_type WHEN 'click' THEN 'Processing' WHEN 'view' THEN 'Succeeded' WHEN 'purchase' THEN 'Scheduled' END
         AS name,
       CASE WHEN k % 3 = 0 THEN NULL ELSE 'k ' || CAST(k AS STRING) END AS reason,
       CASE WHEN k % 5 = 0 THEN '' ELSE '{"K":"' || CAST(k AS STRING) || '"}' END AS data,
       k * 3600 + 0.5 AS ttl_seconds
FROM ll_cmd_base""",
    "parameter_commands": """
SELECT seq, ts, user_id * 7 + k % 7 AS jobid,
       CASE WHEN k % 2 = 0 THEN 'RetryCount' ELSE 'Tag' || CAST(k % 3 AS STRING) END AS name,
       CASE WHEN k % 4 = 0 THEN NULL ELSE event_type END AS value
FROM ll_cmd_base""",
    "queue_commands": """
SELECT seq, txn_id, committed, user_id * 7 + k % 7 AS jobid, event_type || '-queue' AS queue
FROM ll_cmd_base WHERE event_type IN ('click', 'purchase')""",
    "counter_commands": """
SELECT seq, txn_id, committed, ts, 'stats:' || event_type AS key,
       CASE WHEN k % 4 = 0 THEN 'decrement' ELSE 'increment' END AS op,
       CASE WHEN k % 3 = 0 THEN NULL ELSE k * 60 + 0.75 END AS ttl_seconds
FROM ll_cmd_base""",
    "server_commands": """
SELECT seq, ts, 'srv-' || CAST(user_id AS STRING) AS id,
       CASE WHEN event_type = 'signup' THEN 'announce' WHEN event_type = 'error' AND seq % 4 = 0 THEN 'remove'
            ELSE 'heartbeat' END AS op,
       CASE WHEN event_type = 'signup' THEN '{"WorkerCount":' || CAST(k AS STRING) || ',"Queues":["default"]}' END AS data
FROM ll_cmd_base""",
    # One log over all tables: a transaction's five commands go to different ones.
    "transaction_log": """
SELECT seq, txn_id, committed, ts,
       CASE WHEN event_type = 'view' THEN 'job' WHEN event_type <> 'purchase' THEN 'set'
            ELSE CASE k % 4 WHEN 0 THEN 'queue' WHEN 1 THEN 'counter' WHEN 2 THEN 'hash' ELSE 'list' END END AS target,
       CASE WHEN event_type = 'view' THEN CASE k % 4 WHEN 0 THEN 'add_state' WHEN 1 THEN 'expire_job' ELSE 'set_state' END
            WHEN event_type = 'click' THEN 'insert'
            WHEN event_type = 'signup' THEN CASE WHEN k % 10 = 0 THEN 'remove_key' WHEN k % 10 = 1 THEN 'expire' ELSE 'remove' END
            WHEN event_type = 'error' THEN CASE WHEN k % 3 = 0 THEN 'remove' ELSE 'add_score' END
            ELSE CASE k % 4 WHEN 0 THEN 'enqueue' WHEN 1 THEN 'increment' WHEN 2 THEN 'add' ELSE 'insert' END END AS op,
       'k' || CAST(user_id AS STRING) AS key, 'v' || CAST(k % 20 AS STRING) AS item, amount AS score,
       'p' || CAST(k AS STRING) AS value, CASE WHEN event_type = 'signup' THEN ts + INTERVAL '1' DAY END AS expire_at,
       user_id * 7 + k % 7 + CASE WHEN seq % 503 = 0 THEN 2000000000 ELSE 0 END AS jobid,
       CASE WHEN event_type = 'view' THEN 'Succeeded' END AS name, 'k ' || CAST(k AS STRING) AS reason,
       '{"K":"' || CAST(k AS STRING) || '"}' AS data, CASE WHEN k % 3 = 0 THEN NULL ELSE k * 60 + 0.75 END AS ttl_seconds,
       event_type || '-queue' AS queue, CAST(NULL AS INT) AS trim_from, CAST(NULL AS INT) AS trim_to
FROM ll_cmd_base""",
    "lease_commands": """
SELECT seq, 2 * (user_id * 7 + k % 7) AS id, ts,
       CASE event_type WHEN 'click' THEN 'fetch' WHEN 'signup' THEN 'fetch' WHEN 'view' THEN 'keep_alive'
                       WHEN 'purchase' THEN 'ack' ELSE 'requeue' END AS op
FROM ll_cmd_base""",
    # The queue when the lease log starts: customers' rows, two in three leased within the last 50 minutes.
    "queue_at_start": """
SELECT 2 * c_custkey AS id,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE {TS:2024-01-01 00:00:00} - (c_custkey % 50) * INTERVAL '1' MINUTE END AS fetchedat
FROM @customer""",
    # Lease tokens presented by holders: every other row's is up to date, the others are stale.
    "lease_tokens": """
SELECT id, CASE WHEN id % 4 < 2 THEN fetchedat ELSE fetchedat - INTERVAL '1' SECOND END AS token,
       {TS:1999-01-01 00:00:00} AS ts
FROM ll_jobqueue WHERE fetchedat IS NOT NULL""",
    # Workers and the queues that each listens to.
    "listeners": """
SELECT o_orderkey AS worker,
       CASE CAST(floor(o_orderkey / 10) AS BIGINT) % 5 WHEN 0 THEN 'urgent' WHEN 1 THEN 'urgent,high' WHEN 2 THEN 'urgent,none' WHEN 3 THEN 'medium,urgent,low'
                           ELSE 'high,low,low' END AS queues
FROM @orders WHERE o_orderkey % 10 = 0""",
    # An extract in an older shape: narrow ids, empty payload text, a column since dropped.
    "old_job": """
SELECT CAST(id AS INT) AS id, CAST(id % 1000 AS INT) AS stateid, statename,
       CASE WHEN id % 3 = 0 THEN '' ELSE invocationdata END AS invocationdata,
       CASE WHEN id % 7 = 0 THEN '' ELSE arguments END AS arguments, createdat, expireat, 0 AS updatecount
FROM ll_job""",
    "old_jobqueue": """
SELECT CAST(id AS INT) AS id, CAST(jobid AS BIGINT) AS jobid, queue, fetchedat FROM ll_jobqueue""",
}

# The formula of state ids holds for some 11 million orders. On tables beyond that, the rows of an order's line are
# numbered instead: the same order, and again one id for rows that agree in all four columns.
_STATE_ID = "((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey"
_NUMBERED_ID = """CASE WHEN l_partkey IS NOT NULL AND l_suppkey IS NOT NULL THEN (l_orderkey * 8 + l_linenumber) * 1000000000
         + dense_rank() OVER (PARTITION BY l_orderkey * 8 + l_linenumber ORDER BY l_partkey, l_suppkey) END"""
# The formula's value, or null where it does not fit; and bounds within which it does, so that statistics of files tell.
_TRIED_ID = """try_add(try_multiply(try_add(try_multiply(try_add(try_multiply(
  l_orderkey, 8), l_linenumber), 1000000), l_partkey), 100000), l_suppkey)"""
_BOUNDS = {"l_orderkey": 11_529_000, "l_linenumber": 1_000, "l_partkey": 10_000_000, "l_suppkey": 1_000_000_000}

_VIEW = re.compile(r"\bll_(\w+)\b")
_SOURCE = re.compile(r"@(\w+)\b")
_LITERAL = re.compile(r"\{TS:([^}]*)\}")


def _needed(text: str, texts: dict[str, str] = VIEWS) -> list[str]:
    """Views a text uses, directly or not, each after those it builds on."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in _VIEW.findall(sql):
            if name not in order:
                visit(texts[name])
                order.append(name)

    visit(text)
    return list(dict.fromkeys(order))


def _with_views(text: str, texts: dict[str, str] = VIEWS) -> str:
    views = ",\n".join(f"ll_{name} AS ({texts[name]})" for name in _needed(text, texts))
    if not views:
        return text
    body = text.strip()
    # A text that brings its own WITH list continues ours.
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {views},\n{body[15:].lstrip()}"
    return f"WITH {views},\n{body[4:].lstrip()}" if body[:5].upper() == "WITH " else f"WITH {views}\n{body}"


def checking_sql(text: str) -> str:
    """``text`` over ledger views as one statement for the checking engine."""
    sql = _with_views(text)
    sql = _SOURCE.sub(r"\1", sql)
    return _LITERAL.sub(r"TIMESTAMP '\1'", sql).replace("{TSTYPE}", "TIMESTAMP")


class Ledger:
    """Ledger tables and command logs over one folder of supplied tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._texts: dict[str, str] | None = None

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _views(self, name: str) -> dict[str, str]:
        """The views' texts, with numbered state ids if some row's would not fit in 64 bits by the formula."""
        if "state" not in _needed(f"ll_{name}"):
            return VIEWS
        if self._texts is None:
            outside = " OR ".join(f"{column} < {-bound} OR {column} > {bound}" for column, bound in _BOUNDS.items())
            known = " AND ".join(f"{column} IS NOT NULL" for column in _BOUNDS)
            beyond = self.source("lineitem").where(outside).where(known).where(F.expr(_TRIED_ID).isNull())
            self._texts = VIEWS if beyond.isEmpty() else VIEWS | {"state": VIEWS["state"].replace(_STATE_ID, _NUMBERED_ID)}
        return self._texts

    def __getitem__(self, name: str) -> DataFrame:
        sql = _with_views(f"SELECT * FROM ll_{name}", self._views(name))
        sql = _SOURCE.sub(rf"parquet.`{self.folder}/\1.parquet`", sql)
        return self.spark.sql(_LITERAL.sub(r"TIMESTAMP_NTZ '\1'", sql).replace("{TSTYPE}", "TIMESTAMP_NTZ"))

    def over(self, name: str, events: str) -> DataFrame:
        """A view that reads only the events table, over another relation instead (here: a stream)."""
        sql = _SOURCE.sub(events, _with_views(f"SELECT * FROM ll_{name}"))
        return self.spark.sql(_LITERAL.sub(r"TIMESTAMP_NTZ '\1'", sql).replace("{TSTYPE}", "TIMESTAMP_NTZ"))

    def events_stream(self) -> DataFrame:
        """The events table as a stream of files, whether it is one file or a folder of them."""
        schema = self.source("events").schema
        # Only a pattern may stand for a single file.
        return self.spark.readStream.schema(schema).parquet(f"{self.folder}/events.parque[t]")


def stream_view(ledger: Ledger, name: str) -> DataFrame:
    """A view over the events table, computed on the stream of events."""
    relation = f"events_{uuid.uuid4().hex}"
    ledger.events_stream().createTempView(relation)
    try:
        return ledger.over(name, relation)
    finally:
        ledger.spark.catalog.dropTempView(relation)
