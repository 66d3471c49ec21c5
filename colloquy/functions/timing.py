"""Sample counts and seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def centis(samples: Column | str, sampling_rate: int) -> Column:
    """Hundredths of a second, rounded half up in integer arithmetic."""
    col = F.col(samples) if isinstance(samples, str) else samples
    return F.floor((col * 100 + sampling_rate // 2) / F.lit(sampling_rate)).cast("bigint")


def seconds(samples: Column | str, sampling_rate: int) -> Column:
    """Seconds with two decimals."""
    return centis(samples, sampling_rate) / F.lit(100.0)
