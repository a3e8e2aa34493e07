"""Label tables joined to prior-history tables (C6, D7, B11; M7-M10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .response import keep_first


def outer_by_id(
    left: DataFrame,
    right: DataFrame,
    key: str = "id",
    fill: dict | None = None,
    dedupe_order: list[str] | None = None,
) -> DataFrame:
    """Full outer join on ``key`` (SQL null semantics: null keys never match).

    ``dedupe_order`` keeps one row per key afterwards (the reference's
    ``drop_duplicates``); leave it out when both sides are already unique per
    key, which saves an aggregation. ``fill`` replaces nulls per column.
    """
    out = left.join(right, key, "full_outer")
    if dedupe_order is not None:
        out = keep_first(out, key, dedupe_order)
    if fill:
        out = out.fillna(fill)
    return out


def bounded_with_history(
    waits: DataFrame,
    history_df: DataFrame,
    col: str,
    lo: float,
    hi: float,
    key: str = "id",
    fill_col: str = "badges",
) -> DataFrame:
    """Waits in the open range ``lo < col < hi`` with their history.

    The bounds imply a non-null wait, so the reference's outer join reduces
    to a left join from the waits; the range filter runs before the join.
    """
    w = waits.where((F.col(col) > lo) & (F.col(col) < hi))
    return w.join(history_df, key, "left").fillna({fill_col: ""})
