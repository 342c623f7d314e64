"""Epoch and wall-clock conversions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the zone whose wall clock the GPU logs are written in.
GPU_LOG_ZONE = "America/New_York"


def from_epoch(seconds: Column) -> Column:
    """TIMESTAMP of (possibly fractional) epoch seconds."""
    return F.timestamp_seconds(seconds)


def wall_offset(seconds: Column, zone: str = GPU_LOG_ZONE) -> Column:
    """Seconds by which the wall clock of `zone`, read as if it were UTC, is ahead of UTC."""
    wall = F.timestamp_seconds(seconds)
    micros = F.unix_micros(wall) - F.unix_micros(F.to_utc_timestamp(wall, zone))
    return micros / F.lit(1e6)


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)
