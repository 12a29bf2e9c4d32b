"""Registry of named queries and their DuckDB oracle SQL.

Plan modules register with ``@register(name, sql)``; importing this module
imports them all.  Keys follow the inventory ids (``L01_...``, ``C01_...``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "L01_yearly_kpis"


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# populate
from ledgerloom.plans import kpi  # noqa: E402,F401
from ledgerloom.plans import dims  # noqa: E402,F401
from ledgerloom.plans import eda  # noqa: E402,F401
from ledgerloom.plans import dashboard  # noqa: E402,F401
from ledgerloom.plans import cleaning  # noqa: E402,F401
from ledgerloom.plans import quality  # noqa: E402,F401
from ledgerloom.plans import profiles  # noqa: E402,F401
from ledgerloom.plans import raw_profiles  # noqa: E402,F401
from ledgerloom.plans import streams  # noqa: E402,F401
