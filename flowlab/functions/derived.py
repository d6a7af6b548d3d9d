"""The engineered features, as a table of (name, inputs, rule).

A feature is built only where all its inputs exist, so the same list serves narrow and wide
tables. Features of the second group read features of the first.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Derived(NamedTuple):
    name: str
    inputs: tuple[str, ...]
    rule: Callable[..., Column]


def total(a: Column, b: Column) -> Column:
    return a + b


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    """``top / bottom`` where the divisor is positive, else 0.0 (also for a NULL divisor)."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def log_of_positive(value: Column) -> Column:
    """log(1 + value), negative and missing values counted as 0."""
    return F.log1p(F.when(value >= 0, value).otherwise(F.lit(0.0)))


TOTALS = (
    Derived("total_packets", ("fwd_packets_count", "bwd_packets_count"), total),
    Derived("total_payload_bytes", ("fwd_total_payload_bytes", "bwd_total_payload_bytes"), total),
)
RATIOS = (
    Derived("fwd_bwd_packet_ratio", ("fwd_packets_count", "bwd_packets_count"), ratio_or_zero),
)
LOGS = (
    Derived("log_duration", ("duration",), log_of_positive),
    Derived("log_bytes_rate", ("bytes_rate",), log_of_positive),
    Derived("log_packets_rate", ("packets_rate",), log_of_positive),
)
OVER_TOTALS = (
    Derived("avg_payload_per_packet", ("total_payload_bytes", "total_packets"), ratio_or_zero),
)
