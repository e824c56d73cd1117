"""Query registry: a name, the Spark plan, and the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under `name`, with the SQL that returns the same rows if there is one."""

    def keep(plan: Plan) -> Plan:
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return keep
