"""Where rows come from: files, feed text, calendars."""

from tapespark.sources.calendar import calendar_of, feed_calendar, trading_days
from tapespark.sources.feed import list_feed_files, read_feed_text, with_file_date
from tapespark.sources.files import (
    csv_rejects,
    read_daily,
    read_many_csv,
    read_parquet,
    read_trades_csv,
)

__all__ = [
    "calendar_of",
    "csv_rejects",
    "feed_calendar",
    "list_feed_files",
    "read_daily",
    "read_feed_text",
    "read_many_csv",
    "read_parquet",
    "read_trades_csv",
    "trading_days",
    "with_file_date",
]
