"""Validity intervals ``[valid_from, valid_to)``: building, expanding and joining them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.scalars import surrogate_key
from tidemark.functions.text import aliased, literal, name, names, with_exprs


def same_keys(left: str, right: str, keys: Sequence[str]) -> str:
    """Null-safe equality on ``keys``, as grouping and windows treat nulls."""
    return " and ".join(f"{left}.{name(k)} <=> {right}.{name(k)}" for k in keys)


def keyed_by_chunk(df: DataFrame, keys: Sequence[str], chunk: str) -> DataFrame:
    """Add ``_key``, the keys and chunk as one struct.

    Windows, summaries and the join back all use it, so the rows are shuffled once. A struct
    also compares null-safe under plain equality, which keeps that partitioning usable.
    """
    fields = "".join(f"{literal(k)}, {name(k)}, " for k in keys)
    return with_exprs(df, {"_key": f"named_struct({fields}'_chunk', {chunk})"})


def carry_across(
    df: DataFrame, keys: Sequence[str], summaries: Mapping[str, str], carried: Mapping[str, str]
) -> DataFrame:
    """Attach to each row of a frame with ``_key`` what its key's other chunks hold.

    ``summaries`` aggregates a (key, chunk); ``carried`` reads those summaries over a window of
    the key's chunks, written with ``{w}``. Only summaries are windowed per key, so the rows of
    one key may spread over many tasks.
    """
    by_key = f"partition by {', '.join(f'_key.{name(k)}' for k in keys)} order by _key._chunk"
    summary = df.groupBy("_key").agg(*[F.expr(e) for e in aliased(summaries)])
    beyond = summary.selectExpr("_key", *aliased({n: e.replace("{w}", by_key) for n, e in carried.items()}))
    joined = df.alias("r").join(beyond.alias("c"), F.expr("r._key = c._key"), "left")
    return joined.selectExpr("r.*", *[f"c.{name(n)}" for n in carried])


def next_in_chunks(df: DataFrame, keys: Sequence[str], order_by: str, into: str, tie: Sequence[str] = ()) -> DataFrame:
    """``with_next`` on a frame that has ``_key``."""
    inside = f"partition by _key order by {names([order_by, *tie])}"
    local = with_exprs(df, {into: f"lead({name(order_by)}) over ({inside})"})
    wide = carry_across(local, keys, {"_first": f"min({name(order_by)})"}, {"_after": "lead(_first) over ({w})"})
    return with_exprs(wide, {into: f"coalesce({name(into)}, _after)"}).drop("_after")


def with_next(
    df: DataFrame, keys: Sequence[str], order_by: str, into: str, tie: Sequence[str] = (), chunk: str | None = None
) -> DataFrame:
    """Add ``into``: the key's next ``order_by`` value.

    Plain form: one window per key, right when a key has few rows (one per day, say).
    With ``chunk``, an expression that never decreases along ``order_by`` (its month, say), a
    key's rows are split by chunk and only one summary row per chunk crosses chunk borders.
    """
    if chunk is None:
        order = names([order_by, *tie])
        return with_exprs(df, {into: f"lead({name(order_by)}) over (partition by {names(keys)} order by {order})"})
    return next_in_chunks(keyed_by_chunk(df, keys, chunk), keys, order_by, into, tie).drop("_key")


def with_previous(
    df: DataFrame, keys: Sequence[str], order_by: str, value: str, into: str,
    tie: Sequence[str] = (), chunk: str | None = None,
) -> DataFrame:
    """Add ``into``: ``value`` of the key's previous row; chunked as in ``with_next``."""
    order = names([order_by, *tie])
    if chunk is None:
        return with_exprs(df, {into: f"lag({name(value)}) over (partition by {names(keys)} order by {order})"})
    inside = f"partition by _key order by {order}"
    local = with_exprs(
        keyed_by_chunk(df, keys, chunk),
        {into: f"lag({name(value)}) over ({inside})", "_place": f"row_number() over ({inside})"},
    )
    last = f"max_by(struct({name(value)} as v), struct({order}))"
    wide = carry_across(local, keys, {"_last": last}, {"_before": "lag(_last) over ({w})"})
    settled = f"case when _place = 1 then _before.v else {name(into)} end"
    return with_exprs(wide, {into: settled}).drop("_key", "_place", "_before")


def changes_only(
    df: DataFrame, keys: Sequence[str], order_by: str, value: str,
    tie: Sequence[str] = (), chunk: str | None = None,
) -> DataFrame:
    """Keep rows whose value differs from the key's previous one, and rows without a previous value."""
    seen = with_previous(df, keys, order_by, value, "_previous", tie, chunk)
    return seen.filter(f"{name(value)} != _previous or _previous is null").drop("_previous")


def scd2(
    df: DataFrame, keys: Sequence[str], order_by: str, skey_columns: Sequence[str],
    gap_days: int = 1, tie: Sequence[str] = (), chunk: str | None = None,
) -> DataFrame:
    """Versions with ``skey``, ``valid_from``, ``valid_to``, ``is_latest``.

    ``valid_to`` is the key's next start minus ``gap_days``. The default of one day leaves the
    day before each change uncovered under ``[valid_from, valid_to)``; 0 closes that gap.
    """
    versions = with_next(df, keys, order_by, "_next", tie, chunk)
    return with_exprs(
        versions,
        {
            "skey": surrogate_key(*map(name, skey_columns)),
            "valid_from": f"cast({name(order_by)} as date)",
            "valid_to": f"coalesce(date_sub(cast(_next as date), {gap_days}), {literal(fixed.OPEN_DATE)})",
            "is_latest": "_next is null",
        },
    ).drop("_next")


def calendar_expand(schedule: DataFrame, start: str = "start_hour", end: str = "end_hour", hour: str = "hour") -> DataFrame:
    """One row per hour of each ``[start, end)`` row; empty ranges give none, hours stay in a day.

    Equal to joining a weekday-by-hour calendar, but row-local: no join, no shuffle.
    """
    first, last = f"greatest({name(start)}, 0L)", f"least({name(end)}, 24L) - 1"
    hours = f"explode(case when {first} <= {last} then sequence({first}, {last}) end) as {name(hour)}"
    kept = [name(c) for c in schedule.columns if c not in (start, end)]
    # greatest and least skip nulls; an unknown bound covers no hour.
    known = f"day_of_week between 1 and 7 and {name(start)} is not null and {name(end)} is not null"
    return schedule.filter(known).selectExpr(*kept, hours)


def hourly_calendar(spark: SparkSession) -> DataFrame:
    """The 168 weekday-hours."""
    return spark.range(1, 8).selectExpr("id as day_of_week", "explode(sequence(0L, 23L)) as hour")


def range_join(
    facts: DataFrame, dim: DataFrame, at: str, start: str, end: str, on: str | None = None, how: str = "left"
) -> DataFrame:
    """Join on ``start <= at < end`` as written. Without ``on`` Spark compares each fact with each row."""
    cond = f"{at} >= {name(start)} and {at} < {name(end)}"
    return facts.join(dim, F.expr(cond if on is None else f"{on} and {cond}"), how)


def interval_join(
    facts: DataFrame, dim: DataFrame, at: str, start: str = "valid_from", end: str = "valid_to",
    how: str = "left", salts: int = 1,
) -> DataFrame:
    """``range_join`` on dates as an equi-join: each dim row is repeated for the days it covers.

    ``start`` and ``end`` must not be columns of ``facts`` too. From the last boundary in the dim
    onward nothing changes, so later facts use that day as their key and open rows expand only up
    to it. The boundary is a scalar subquery over the dim, so planning runs nothing. The range
    condition stays as a residual: the result is exact, also for a dim of empty intervals only.

    The join carries no hint. AQE broadcasts the dim when its real size allows it and splits hot
    days otherwise; where a plan above needs the rows of a day together, ``salts`` spreads them
    at the price of that many copies of the dim.
    """
    lo, hi, forever = name(start), name(end), literal(fixed.OPEN_DATE)
    some = dim.filter(f"{lo} < {hi}")
    horizon = some.selectExpr(f"max(case when {hi} < {forever} then {hi} else {lo} end) as horizon").scalar()
    bounded = some.withColumn("_stop", F.least(F.expr(f"date_sub({hi}, 1)"), horizon))
    expanded = bounded.selectExpr("*", f"explode(sequence({lo}, _stop, interval 1 day)) as _day").drop("_stop")
    timed = facts.withColumn("_at_day", F.least(F.expr(at), horizon))
    cond = f"_at_day = _day and {at} >= {lo} and {at} < {hi}"
    if salts > 1:
        # The row hash spreads different rows, the task number spreads copies of one row.
        spread = f"pmod(pmod(xxhash64({names(facts.columns)}), {salts}L) + spark_partition_id(), {salts}L)"
        timed = with_exprs(timed, {"_salt": spread})
        expanded = expanded.selectExpr("*", f"explode(sequence(0L, {salts - 1}L)) as _salt_d")
        cond += " and _salt = _salt_d"
    return timed.join(expanded, F.expr(cond), how).drop("_day", "_at_day", "_salt", "_salt_d")


def asof_join(
    facts: DataFrame, dim: DataFrame, at: str, start: str = "valid_from", end: str = "valid_to", keys: Sequence[str] = (),
    how: str = "left", chunk: str = "trunc({t}, 'month')", salts: int = 1,
) -> DataFrame:
    """``range_join`` on equal ``keys`` for a dim whose intervals do not overlap within a key, on times of any precision.

    Facts and dim rows are put in one order of time, and each fact takes the last dim row before it, if that has not ended. No dim row
    is repeated for the time it covers, and nothing but this union is shuffled. ``chunk`` is an expression of the time ``{t}`` that
    never decreases with it: a key's rows are split by chunk, and one dim row per chunk is carried into the later ones. ``salts`` splits
    a hot chunk's facts further, at the price of that many copies of the dim.

    Null keys match nothing, nor do null times; empty intervals hold nothing. ``facts`` and ``dim`` must not share columns but the keys.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    given = [f"cast({name(k)} as {facts.schema[k].dataType.simpleString()}) as {name(k)}" for k in keys]
    own = [c for c in dim.columns if c not in keys]
    some = dim.filter(f"{name(start)} < {name(end)}").selectExpr(
        *given, f"cast({name(start)} as timestamp) as _t", "0 as _kind", f"struct({names(own)}) as _dim", f"explode(sequence(0, {salts - 1})) as _salt" if salts > 1 else "0 as _salt",
    )
    # Different rows are spread by their hash, copies of one row by the task that reads them.
    spread = f"cast(pmod(pmod(xxhash64({names(facts.columns)}), {salts}L) + spark_partition_id(), {salts}L) as int)" if salts > 1 else "0"
    asked = facts.selectExpr(*map(name, keys), f"cast({at} as timestamp) as _t", "1 as _kind", f"struct({names(facts.columns)}) as _fact", f"{spread} as _salt")
    by = [*keys, "_salt"]
    keyed = keyed_by_chunk(asked.unionByName(some, allowMissingColumns=True), by, chunk.format(t="_t"))
    local = with_exprs(keyed, {"_here": "last(_dim, true) over (partition by _key order by _t, _kind rows between unbounded preceding and current row)"})
    wide = carry_across(
        local, by, {"_last": "max_by(_dim, _t) filter (where _kind = 0)"},
        {"_before": "last(_last, true) over ({w} rows between unbounded preceding and 1 preceding)"},
    )
    found = wide.filter("_kind = 1").selectExpr("_fact", "_t", "coalesce(_here, _before) as _dim")
    known = " and ".join(["_t is not null", *[f"_fact.{name(k)} is not null" for k in keys], f"_t < _dim.{name(end)}"])
    held = found.selectExpr("_fact.*", f"case when {known} then _dim end as _dim")
    if how == "inner":
        held = held.filter("_dim is not null")
    return held.selectExpr(*map(name, facts.columns), *[f"_dim.{name(c)} as {name(c)}" for c in own])
