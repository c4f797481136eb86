"""Row policies and column tags applied when a table is read."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class RowPolicy:
    """A SQL filter and the principals it is granted to."""
    filter: str
    grantees: tuple[str, ...]


@dataclass(frozen=True)
class ColumnTag:
    """Protected columns and the principals who may read them."""
    columns: tuple[str, ...]
    readers: tuple[str, ...] = ()


class AccessDenied(PermissionError):
    """A principal selected columns it may not read."""


def allowed_rows(df: DataFrame, principal: str, policies: Iterable[RowPolicy]) -> DataFrame:
    """Any of the filters granted to the principal. With policies but no grant: no rows."""
    policies = list(policies)
    if not policies:
        return df
    granted = [F.coalesce(F.expr(p.filter), F.lit(False)) for p in policies if principal in p.grantees]
    return df.where(reduce(Column.__or__, granted, F.lit(False)))


def denied_columns(df: DataFrame, principal: str, tags: Iterable[ColumnTag]) -> list[str]:
    closed = {c for t in tags if principal not in t.readers for c in t.columns}
    return [c for c in df.columns if c in closed]


def governed_read(df: DataFrame, principal: str, policies: Iterable[RowPolicy] = (),
                  tags: Iterable[ColumnTag] = (), columns: list[str] | None = None,
                  denied: str = "refuse") -> DataFrame:
    """What a principal sees of a table.

    ``denied`` says what happens to a selected column the principal may not read:
    ``refuse`` raises, ``drop`` leaves it out, ``null`` and ``hash`` mask its values.
    Filters see the real values, since they belong to the policy and not to the reader.
    """
    closed = denied_columns(df, principal, tags)
    selected = columns or df.columns
    hit = [c for c in selected if c in closed]
    rows = allowed_rows(df, principal, policies)
    if not hit:
        return rows.select(*selected)
    if denied == "refuse":
        raise AccessDenied(f"{principal} may not read {', '.join(hit)}; select the table without them")
    if denied == "drop":
        return rows.select(*[c for c in selected if c not in hit])
    if denied == "null":
        def mask(c):
            return F.lit(None).cast(df.schema[c].dataType).alias(c)
    elif denied == "hash":
        def mask(c):
            return F.sha2(F.col(c).cast("string"), 256).alias(c)
    else:
        raise ValueError(f"unknown treatment {denied!r}")
    return rows.select(*[mask(c) if c in hit else F.col(c) for c in selected])
