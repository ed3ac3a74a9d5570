"""Silver to staging: 64-bit types, one projection per dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark import fixed
from tidemark.functions.scalars import to_whole, utc_timestamp
from tidemark.functions.text import aliased, name
from tidemark.operators.incremental import incremental_filter
from tidemark.sources import lake as lk

_WIDER = {T.IntegerType(): T.LongType(), T.FloatType(): T.DoubleType()}

# Dataset -> (silver schema, load watermark, merge key).
LAYOUT = {
    lk.OFFERS.name: (fixed.OFFERS_SILVER, "ingested_at", ("offer_id", "ingested_at")),
    lk.RATES.name: (fixed.RATES_SILVER, "timestamp", ("from_currency", "to_currency", "timestamp")),
    lk.TIERS.name: (fixed.TIERS_SILVER, "valid_from", ("tariff_description", "valid_from")),
    lk.SCHEDULE.name: (
        fixed.SCHEDULE_SILVER, "valid_from", ("day_of_week", "start_hour", "end_hour", "valid_from")
    ),
}


def stage(silver: DataFrame, dataset: str) -> DataFrame:
    """Widen to 64 bit; measures kept as whole numbers round half away from zero. Stamps go last."""
    fields = LAYOUT[dataset][0].fields
    out = {}
    for f in [*fields[2:], *fields[:2]]:
        if f.name in fixed.WHOLE_NUMBER_MEASURES:
            out[f.name] = to_whole(name(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            out[f.name] = utc_timestamp(name(f.name))
        else:
            out[f.name] = f"cast({name(f.name)} as {_WIDER.get(f.dataType, f.dataType).simpleString()})"
    return silver.selectExpr(*aliased(out))


def stage_increment(silver: DataFrame, dataset: str, target: DataFrame | None) -> DataFrame:
    """What the next load adds to ``target``: rows above its watermark."""
    return incremental_filter(stage(silver, dataset), target, LAYOUT[dataset][1])
