"""Column-expression helpers (all JVM-side, whole-stage-codegen friendly)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import config


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def paise(c: str | Column) -> Column:
    """Money value as exact integer paise."""
    return F.round(col(c) * 100).cast("long")


def msum(c: str | Column) -> Column:
    """Exact money sum (integer paise): the same bits at any partitioning."""
    return F.sum(paise(c)) / 100.0


def mavg(c: str | Column) -> Column:
    """Money mean over non-null values from the exact paise sum."""
    return F.sum(paise(c)) / F.count(col(c)) / 100.0


def money(c: str | Column) -> Column:
    """Money output convention: round to 2 decimals."""
    return F.round(col(c), 2)


def ratio(c: str | Column) -> Column:
    """Rate / share / mean output convention: round to 6 decimals."""
    return F.round(col(c), 6)


def flag(c: str | Column) -> Column:
    """Boolean predicate as 0/1 double, so ``avg`` is a share of true."""
    return col(c).cast("double")


def lit_map(mapping: Mapping) -> Column:
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def lookup(mapping: Mapping, key: str | Column) -> Column:
    """Literal key -> value lookup; null when the key is absent."""
    return F.try_element_at(lit_map(mapping), col(key))


#: Every upper and lower case spelling of the missing-value tokens.
_NULL_SPELLINGS = sorted({"".join(s) for t in config.NULL_TOKENS for s in product(*[{x, x.upper()} for x in t])})


def is_null_token(c: str | Column) -> Column:
    """True for null or a missing-value token after trim + lower-case."""
    c = col(c)
    return c.isNull() | is_blank_text(c)


def is_blank_text(c: str | Column) -> Column:
    """A missing-value token after trim, in any case; null for null.  The
    tokens' spellings are looked up, so no text is lower-cased."""
    return F.trim(col(c)).isin(*_NULL_SPELLINGS)


def null_if_token(c: str | Column) -> Column:
    return F.when(~is_null_token(c), col(c))


def band(c: str | Column, edges: Sequence[float], labels: Sequence[str], open_end: bool = False) -> Column:
    """Right-closed fixed bins ``(e[i], e[i+1]]`` -> label; outside -> null
    (I6).  ``open_end``: the last bin has no upper edge, so no large value is lost."""
    c = col(c)
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = c > lo if open_end and hi == edges[-1] else (c > lo) & (c <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def band_ord(c: str | Column, edges: Sequence[float]) -> Column:
    """1-based ordinal of the fixed bin, null outside."""
    c = col(c)
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]), start=1):
        cond = (c > lo) & (c <= hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def pct_label(cur: str | Column, prev: str | Column) -> Column:
    """``+x.x%`` change label, null when previous is 0/null."""
    cur, prev = col(cur), col(prev)
    change = F.try_divide(cur, F.when(prev != 0, prev)) - 1
    return F.when(change.isNotNull(), F.format_string("%+.1f%%", change * 100))


def inr_scale(c: str | Column) -> Column:
    """Money scale unit: Cr (>= 1e7), L (>= 1e5), else plain."""
    c = F.abs(col(c))
    return F.when(c >= 1e7, F.lit("Cr")).when(c >= 1e5, F.lit("L")).otherwise(F.lit(""))


def inr_label(c: str | Column, digits: int = 1) -> Column:
    """``₹x.x Cr`` / ``₹x.x L`` / ``₹x`` display string."""
    v = col(c)
    a = F.abs(v)
    return (
        F.when(a >= 1e7, F.format_string(f"₹%,.{digits}f Cr", v / 1e7))
        .when(a >= 1e5, F.format_string(f"₹%,.{digits}f L", v / 1e5))
        .otherwise(F.format_string("₹%,.0f", v))
    )
