"""Streaming forms of what needs no future: packet counts, duplicates, sessions between gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.series import KEY


def packet_counts(stream: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Packets and mean fuel of each generator and window, final once the watermark has passed."""
    out = stream.withWatermark("timestamp", late).groupBy(F.window("timestamp", window), KEY)
    return out.agg(F.count(F.lit(1)).alias("n"), F.avg("fuel_level_l").alias("mean_fuel")).select(KEY, F.col("window.start").alias("start"), "n", "mean_fuel")


def without_repeats(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """The first packet of each generator and timestamp."""
    return stream.withWatermark("timestamp", late).dropDuplicatesWithinWatermark([KEY, "timestamp"])


def sessions(stream: DataFrame, gap: str = "2 minutes", late: str = "10 minutes") -> DataFrame:
    """Stretches of telemetry without a gap longer than `gap`; between them lie the gap events."""
    out = stream.withWatermark("timestamp", late).groupBy(F.session_window("timestamp", gap), KEY)
    return out.agg(F.count(F.lit(1)).alias("n")).select(KEY, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
