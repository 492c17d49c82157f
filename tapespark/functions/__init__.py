"""Column-level building blocks."""

from tapespark.functions.casting import conform
from tapespark.functions.feed import (
    feed_date,
    feed_file_name,
    protocol_version,
    valid_text,
)
from tapespark.functions.pricing import notional, vwap

__all__ = [
    "conform",
    "feed_date",
    "feed_file_name",
    "notional",
    "protocol_version",
    "valid_text",
    "vwap",
]
