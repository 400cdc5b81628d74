"""The stateless first half of the pipelines on streams, and day sums with a watermark.

Deriving observations from stay points needs no state, so the same functions take a streaming DataFrame. Sums by user,
unit, band and local day close when the watermark has passed the day's end; midpoint splitting needs a whole user day
and belongs behind that point, on the closed days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwell.functions import bands as B
from dwell.operators import fill


def observation_stream(stays: DataFrame, units: fill.Cells | fill.Hexes, options: fill.Options, schema_map: dict | None = None) -> DataFrame:
    return fill.observations(fill.marked(stays, units, options, schema_map=schema_map), options)


def daily_strict(seen: DataFrame, delay: str = "1 day") -> DataFrame:
    """Strict minutes by user, unit, band and day; a day is final once the watermark passes it."""
    strict = seen.where(F.col("strict") > 0).withColumn("day_start", F.timestamp_millis(F.col("day") * B.DAY))
    return strict.withWatermark("day_start", delay).groupBy(F.window("day_start", "1 day").alias("w"), "key", "unit", "window").agg(F.sum("strict").alias("tau_strict_min")).select(F.col("w.start").alias("day_start"), "key", "unit", "window", "tau_strict_min")
