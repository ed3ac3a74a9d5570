"""High-watermark loads, keyed merge and the closing of rows that left the feed."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import aliased, literal, name, with_exprs
from tidemark.operators.cleaning import deduplicate
from tidemark.operators.intervals import keyed_by_chunk, with_next

FOREVER = literal(fixed.OPEN_TIMESTAMP)


def watermark(df: DataFrame | None, column: str) -> Any:
    """Highest value, or None for a missing or empty frame. A plain value, so that it prunes files."""
    return None if df is None else df.selectExpr(f"max({name(column)})").first()[0]


def incremental_filter(source: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """Rows strictly above the target's watermark; all rows when the target holds none."""
    high = watermark(target, column)
    return source if high is None else source.filter(F.col(column) > F.lit(high))


def late_rows(source: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """The rows ``incremental_filter`` leaves out, for a reject table."""
    high = watermark(target, column)
    return source.filter("false") if high is None else source.filter(~F.coalesce(F.col(column) > F.lit(high), F.lit(False)))


def append_evolving(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; columns only one side has are null on the other."""
    return target.unionByName(batch, allowMissingColumns=True)


def merge_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Batch rows replace target rows with equal keys, the rest is kept or added.

    ``order_by`` picks the survivor among batch rows with equal keys; without it one would be picked by
    chance, so it must be given. Null keys match nothing.
    """
    if not order_by:
        raise ValueError("order_by must name what decides between batch rows with equal keys")
    batch = deduplicate(batch, keys, order_by)
    incoming = batch.select(*keys).distinct()
    return append_evolving(target.join(incoming, list(keys), "left_anti").select(*target.columns), batch)


def highest(df: DataFrame, column: str) -> Column:
    """The watermark as a scalar subquery: nothing runs until the plan that holds it does."""
    return df.selectExpr(f"max({name(column)}) as latest").scalar()


def close_absent(
    fact: DataFrame, latest: Any, latest_ids: DataFrame, key: str = "offer_id",
    valid_from: str = "valid_from", valid_to: str = "valid_to",
) -> DataFrame:
    """End open rows older than the latest poll whose id that poll lacks; they end at ``latest``.

    ``latest`` is a value or a column (a scalar subquery); ``latest_ids`` are the ids of that poll.
    A null id is never closed. The join carries no hint: the ids grow with the feed, and AQE
    broadcasts them when their real size allows it.
    """
    if latest is None:
        return fact
    ids = latest_ids.selectExpr(f"{name(key)} as _live").dropna().distinct()
    marked = fact.join(ids, F.expr(f"{name(key)} = _live"), "left")
    marked = marked.withColumn("_latest", latest if isinstance(latest, Column) else F.lit(latest))
    ends_now = (
        f"{name(valid_to)} = {FOREVER} and {name(valid_from)} < _latest"
        f" and {name(key)} is not null and _live is null"
    )
    closed = with_exprs(marked, {valid_to: f"case when {ends_now} then _latest else {name(valid_to)} end"})
    return closed.drop("_live", "_latest")


def next_polls(polls: DataFrame, poll: str) -> DataFrame:
    """Each distinct poll with the one after it, worked out month by month."""
    named = polls.select(poll).distinct().selectExpr(name(poll), "0 as _feed")
    return with_next(named, ["_feed"], poll, "_next_poll", chunk=f"trunc({name(poll)}, 'month')").drop("_feed")


def close_by_replay(
    rows: DataFrame, key: str = "offer_id", poll: str = "valid_from", valid_to: str = "valid_to",
    polls: DataFrame | None = None,
) -> DataFrame:
    """``valid_to`` as it stands after ``close_absent`` has run once per poll, in one set-based pass.

    A row ends at the first poll at or after its own that is followed by one without its id: the
    end of its unbroken run. The last poll stays open. Rows that share key and poll end alike.
    Only distinct (key, poll) pairs are replayed, month by month, with one summary row per month
    carried across, so an id seen in very many polls does not land in one task.
    """
    k, p = name(key), name(poll)
    order = next_polls(rows if polls is None else polls, poll)
    slim = rows.selectExpr(f"{k} as _id", f"{p} as _poll").distinct()
    seen = slim.join(order.withColumnRenamed(poll, "_at"), F.expr("_poll = _at"), "left").drop("_at")
    seen = keyed_by_chunk(seen, ["_id"], "trunc(_poll, 'month')")
    seen = with_exprs(seen, {"_next_seen": "lead(_poll) over (partition by _key order by _poll)"})
    gap = "_next_seen is not null and not (_next_seen <=> _next_poll)"
    seen = with_exprs(seen, {"_gap": f"case when {gap} then _next_poll end"})
    # From the latest backwards a running minimum is the first gap at or after each row.
    local = with_exprs(seen, {"_here": "min(_gap) over (partition by _key order by _poll desc)"})

    month = local.groupBy("_key").agg(*[F.expr(e) for e in aliased({
        "_first": "min(_poll)", "_first_gap": "min(_gap)", "_last": "max_by(struct(_next_poll as v), _poll)",
    })])
    months = "partition by _key._id order by _key._chunk"
    goes_on = f"_last.v is not null and _last.v <=> lead(_first) over ({months})"
    month = with_exprs(month, {"_month_end": f"case when not ({goes_on}) then coalesce(_last.v, {FOREVER}) end"})
    later = f"min(coalesce(_first_gap, _month_end)) over ({months} rows between 1 following and unbounded following)"
    beyond = month.selectExpr("_key", f"coalesce(_month_end, {later}) as _beyond")
    ends = local.alias("r").join(beyond.alias("b"), F.expr("r._key = b._key"), "left").selectExpr(
        "_id", "_poll", f"case when _id is null then {FOREVER} else coalesce(_here, _beyond) end as _end"
    )
    # A null id is never closed, as no poll can be said to lack it.
    joined = rows.join(ends, F.expr(f"{k} <=> _id and {p} <=> _poll"), "left")
    return with_exprs(joined, {valid_to: "_end"}).select(*rows.columns)
