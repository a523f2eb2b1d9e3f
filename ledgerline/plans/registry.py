"""Named queries: each a Spark plan over a Ledger, most with an equivalent checking SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans.mapping import Ledger, checking_sql
from ledgerline.session import prepare

Plan = Callable[[Ledger], DataFrame]

PLANS: dict[str, Plan] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Plan], Plan]:
    """Registers a plan under ``name``; ``check`` is its SQL over the ledger views."""

    def add(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"duplicate query {name}")
        PLANS[name] = plan
        if check is not None:
            CHECKS[name] = check
        return plan

    return add


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return plan(Ledger(spark, folder))

        return run

    return {name: bind(plan) for name, plan in PLANS.items()}


def all_checks() -> dict[str, str]:
    return {name: checking_sql(text) for name, text in CHECKS.items()}
