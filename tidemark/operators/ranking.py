"""Ranking within groups, also when a group is far too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import name, names, with_exprs
from tidemark.operators.intervals import same_keys
from tidemark.session import shared_dir

ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in the low bits


def _row_number(group: Sequence[str], order_by: Sequence[str]) -> str:
    return f"row_number() over (partition by {names(group)} order by {', '.join(order_by)})"


def top_one(df: DataFrame, group: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row of each group. Spark keeps one row per group and task before it shuffles."""
    return with_exprs(df, {"_rn": _row_number(group, order_by)}).filter("_rn = 1").drop("_rn")


def rank_rows(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str], into: str, partitions: int | None = None
) -> DataFrame:
    """``row_number`` per group, for groups of any size. ``order_by`` must be total, so that the rank is repeatable.

    Rows are range-partitioned by (group, order); rank = place in partition + rows of the group before it.

    The ranged rows are checkpointed, so that counting and numbering see the same layout even
    if executors are lost in between. The offsets hold one row per group and range partition.
    """
    shared_dir(df.sparkSession)
    order = [_sort_column(e) for e in [*map(name, group), *order_by]]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = with_exprs(ranged.sortWithinPartitions(*order), {"_place": "monotonically_increasing_id()"})
    placed = with_exprs(placed.checkpoint(), {"_part": f"shiftright(_place, {ROW_BITS})"})

    keys = [*group, "_part"]
    counts = placed.groupBy(*keys).agg(F.expr("min(_place) as _start"), F.expr("count(*) as _n"))
    earlier = f"partition by {names(group)} order by _part rows between unbounded preceding and 1 preceding"
    before = f"coalesce(sum(_n) over ({earlier}), 0L) as _before"
    offsets = counts.selectExpr(*map(name, keys), "_start", before)
    joined = placed.alias("p").join(offsets.alias("o"), F.expr(same_keys("p", "o", keys)))
    return joined.selectExpr(
        *[f"p.{name(c)}" for c in df.columns], f"cast(p._place - o._start + o._before + 1 as int) as {name(into)}"
    )


def _sort_column(order: str):
    """``expression [asc|desc]`` as a sort column."""
    text, _, direction = order.rpartition(" ")
    if direction.lower() in ("asc", "desc"):
        return getattr(F.expr(text), direction.lower())()
    return F.expr(order).asc()
