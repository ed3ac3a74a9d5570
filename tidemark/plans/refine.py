"""Bronze to silver: the cleaning steps of each dataset."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import fixed
from tidemark.functions.text import with_exprs
from tidemark.operators import cleaning as clean
from tidemark.sources import lake as lk

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Refinement:
    dataset: lk.Dataset
    schema: T.StructType
    steps: tuple[Step, ...]

    def transform(self, bronze: DataFrame, clock: str = "current_timestamp()") -> DataFrame:
        cleaned = clean.apply_steps(bronze, self.steps)
        return clean.cast_to_schema(clean.stamp_processed(cleaned, clock), self.schema)

    def run(self, spark: SparkSession, lake: lk.Lake, clock: str = "current_timestamp()") -> bool:
        """Read bronze, clean, write silver. False when disabled, without bronze, or without rows.

        Silver keeps every poll as a partition of its own, so a gold run that fails is made up for by the next one.
        """
        bronze = lk.read_table(spark, lake.path("bronze", self.dataset)) if self.dataset.enabled else None
        if bronze is None:
            return False
        silver = with_exprs(self.transform(bronze, clock), {lk.POLL: lk.poll_label()})
        return lk.write_unless_empty(silver, lake.path("silver", self.dataset), partition_by=[lk.POLL], only_partitions=True)


def _unique(*keys: str) -> Step:
    return partial(_first_row, keys=keys)


def _first_row(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    # Any survivor is allowed; taking the lowest remaining values makes reruns agree.
    return clean.deduplicate(df, keys, [c for c in df.columns if c not in keys])


REFINEMENTS = {
    r.dataset.name: r
    for r in (
        Refinement(
            lk.OFFERS, fixed.OFFERS_SILVER,
            (clean.strip_non_ascii, clean.trim_spaces, clean.empty_to_null, clean.strip_core_suffix,
             _unique("offer_id", "offer_type")),
        ),
        Refinement(
            lk.RATES, fixed.RATES_SILVER,
            (clean.trim_spaces, clean.empty_to_null, _unique("from_currency", "to_currency", "timestamp")),
        ),
        # Descriptions are Cyrillic, so no ASCII stripping here.
        Refinement(
            lk.TIERS, fixed.TIERS_SILVER,
            (clean.trim_spaces, clean.empty_to_null, clean.decimal_comma_to_point, clean.parse_valid_from,
             _unique("tariff_description", "valid_from")),
        ),
        Refinement(
            lk.SCHEDULE, fixed.SCHEDULE_SILVER,
            (clean.trim_spaces, clean.empty_to_null, clean.parse_valid_from,
             _unique("day_of_week", "start_hour", "end_hour", "tariff_type", "valid_from")),
        ),
    )
}
