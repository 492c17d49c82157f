"""Where rows go."""

from tapespark.sinks.writers import (
    write_counted,
    write_csv,
    write_daily,
    write_parquet,
    write_summary,
)

__all__ = ["write_counted", "write_csv", "write_daily", "write_parquet", "write_summary"]
