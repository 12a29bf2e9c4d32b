"""Global dashboard slicer (B1) and filter choices (B2).

Every predicate is a plain column comparison.  The year range is applied by
``sales(..., years=...)`` on the orders' own date column, so parquet
statistics skip row groups; the other predicates stand on derived columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Slice:
    """Dashboard filter state.  Empty lists mean "no filter" (as the
    sidebar treats an empty multiselect)."""

    years: tuple[int, int] | None = None
    subcategories: Sequence[str] = field(default_factory=tuple)
    states: Sequence[str] = field(default_factory=tuple)
    prime: str = "All"          # All | Prime | Non-Prime
    festival: str = "All"       # All | Festival only | Non-festival

    def columns(self) -> list[str]:
        return ["order_year", "subcategory", "customer_state", "is_prime_member", "is_festival_sale"]


ALL = Slice()


def apply_slice(df: DataFrame, s: Slice = ALL) -> DataFrame:
    out = df
    if s.years is not None and "order_year" in df.columns:  # else ``sales(..., years=...)`` has applied them
        out = out.where(F.col("order_year").between(s.years[0], s.years[1]))
    if s.subcategories:
        out = out.where(F.col("subcategory").isin(list(s.subcategories)))
    if s.states:
        out = out.where(F.col("customer_state").isin(list(s.states)))
    if s.prime == "Prime":
        out = out.where(F.col("is_prime_member"))
    elif s.prime == "Non-Prime":
        out = out.where(~F.col("is_prime_member"))
    if s.festival == "Festival only":
        out = out.where(F.col("is_festival_sale"))
    elif s.festival == "Non-festival":
        out = out.where(~F.col("is_festival_sale"))
    return out


def needed_columns(s: Slice) -> list[str]:
    cols = []
    if s.subcategories:
        cols.append("subcategory")
    if s.states:
        cols.append("customer_state")
    if s.prime != "All":
        cols.append("is_prime_member")
    if s.festival != "All":
        cols.append("is_festival_sale")
    return cols


def filter_choices(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a slicer column (B2)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
