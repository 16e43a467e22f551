"""Column-level cleaning primitives (pure Column -> Column builders)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .money import dow_sunday1, rounded, safe_divide


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardise_domain(c: Column | str, allowed: Iterable[str], default: str) -> Column:
    """Keep the value if it is in ``allowed``, else ``default`` (NULL -> default)."""
    col = _col(c)
    return F.when(col.isin(list(allowed)), col).otherwise(F.lit(default))


def full_name(first: Column | str, last: Column | str) -> Column:
    """Non-NULL parts joined with one space; all parts NULL gives ''."""
    return F.concat_ws(" ", _col(first), _col(last))


def margin_pct(price: Column | str, cost: Column | str) -> Column:
    """round((price - cost) / price * 100, 2); NULL on zero price."""
    p, c = _col(price), _col(cost)
    return rounded(safe_divide(p - c, p) * F.lit(100), 2)


def all_not_null(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


_OPS = {
    ">": lambda c, b: c > b, ">=": lambda c, b: c >= b, "<": lambda c, b: c < b,
    "<=": lambda c, b: c <= b, "=": lambda c, b: c == b, "!=": lambda c, b: c != b,
}


def compare(c: Column | str, op: str, bound) -> Column:
    """Range predicate; NULL input drops the row when used in ``filter``."""
    return _OPS[op](_col(c), bound)


def date_parts(ts: Column | str, prefix: str, with_day: bool = True) -> dict[str, Column]:
    """year / month / day / day-of-week (1 = Sunday) of a timestamp."""
    t = _col(ts)
    parts = {f"{prefix}_year": F.year(t), f"{prefix}_month": F.month(t)}
    if with_day:
        parts[f"{prefix}_day"] = F.dayofmonth(t)
    parts[f"{prefix}_dow"] = dow_sunday1(t)
    return parts


def try_cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast every column named in ``schema`` with NULL-on-failure semantics.

    Columns are matched case-insensitively; columns absent from ``df`` come
    out as typed NULLs; extra columns are dropped.
    """
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(f"`{src}`").try_cast(f.dataType).alias(f.name))
    return df.select(*out)
