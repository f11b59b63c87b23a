"""Declarative data-quality rules.

A rule yields two boolean expressions:

* ``report``: counted as a violation in the rule report; NULL counts as
  no violation (a conditional sum skips it);
* ``drop``: removes the row during cleaning; a NULL condition removes it
  too (``filter(~cond)`` keeps only rows whose negation is TRUE).

Every rule also renders itself as DuckDB SQL, which the oracle queries use.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    return repr(v)


def _fmt_bound(v: float) -> str:
    return repr(v)


@dataclass(frozen=True)
class Rule:
    """One domain or range rule over one column.

    kind = "member": value must be in ``values`` (``null_ok`` lets NULL pass)
    kind = "pattern": value text must match the regex ``pattern``
    kind = "range": ``lo <= value <= hi`` after a cast to double; NULL passes
    """

    name: str
    kind: str
    column: str
    values: Sequence[str] = ()
    pattern: str | None = None
    lo: float | None = None
    hi: float | None = None
    null_ok: bool = False

    @property
    def family(self) -> str:
        return "range" if self.kind == "range" else "domain"

    @property
    def expected(self) -> str | None:
        if self.kind == "range":
            return f"[{_fmt_bound(self.lo)}, {_fmt_bound(self.hi)}]"
        return None

    # ---- Spark -----------------------------------------------------------
    def _violation(self) -> Column:
        c = F.col(self.column)
        if self.kind == "member":
            v = ~c.isin(list(self.values))
            return (c.isNotNull() & v) if self.null_ok else v
        if self.kind == "pattern":
            return ~c.cast("string").rlike(self.pattern)
        raise ValueError(self.kind)

    def _as_double(self) -> Column:
        return F.col(self.column).try_cast("double")

    def report(self) -> Column:
        if self.kind == "range":
            x = self._as_double()
            cond = F.col(self.column).isNotNull() & ((x < self.lo) | (x > self.hi))
        else:
            cond = self._violation()
        return F.coalesce(cond, F.lit(False))

    def drop(self) -> Column:
        if self.kind == "range":
            x = self._as_double()
            keep = F.col(self.column).isNull() | ((x >= self.lo) & (x <= self.hi))
            return F.coalesce(~keep, F.lit(True))
        return F.coalesce(self._violation(), F.lit(True))

    # ---- DuckDB ----------------------------------------------------------
    def _violation_sql(self) -> str:
        c = self.column
        if self.kind == "member":
            lst = ", ".join(_sql_lit(v) for v in self.values)
            v = f"NOT ({c} IN ({lst}))"
            return f"({c} IS NOT NULL AND {v})" if self.null_ok else v
        if self.kind == "pattern":
            return f"NOT regexp_matches(CAST({c} AS VARCHAR), {_sql_lit(self.pattern)})"
        raise ValueError(self.kind)

    def report_sql(self) -> str:
        if self.kind == "range":
            x = f"TRY_CAST({self.column} AS DOUBLE)"
            cond = f"({self.column} IS NOT NULL AND ({x} < {self.lo} OR {x} > {self.hi}))"
        else:
            cond = self._violation_sql()
        return f"coalesce({cond}, FALSE)"

    def drop_sql(self) -> str:
        if self.kind == "range":
            x = f"TRY_CAST({self.column} AS DOUBLE)"
            keep = f"({self.column} IS NULL OR ({x} >= {self.lo} AND {x} <= {self.hi}))"
            return f"coalesce(NOT {keep}, TRUE)"
        return f"coalesce({self._violation_sql()}, TRUE)"


def member(name: str, column: str, values: Sequence[str], null_ok: bool = False) -> Rule:
    return Rule(name, "member", column, values=tuple(values), null_ok=null_ok)


def pattern(name: str, column: str, regex: str) -> Rule:
    return Rule(name, "pattern", column, pattern=regex)


def in_range(column: str, lo: float, hi: float) -> Rule:
    return Rule(f"{column} range", "range", column, lo=lo, hi=hi)


@dataclass(frozen=True)
class TableSpec:
    """What to profile and how to clean one source table."""

    source: str
    numeric_cols: Sequence[str] = ()
    cardinality_cols: Sequence[str] = ()
    rules: Sequence[Rule] = ()
    pk: Sequence[str] = ()
    order_by: Sequence[str] = ()  # survivor order for duplicate keys
    keep: str = "first"
    active_col: str | None = None
    column_types: dict = field(default_factory=dict)  # column -> Spark type name

    @property
    def domain_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.family == "domain"]

    @property
    def range_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.family == "range"]
