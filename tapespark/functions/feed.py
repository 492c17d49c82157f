"""Names, dates and text of the daily feed files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The feed moved to protocol 1.6 on this day, and file names carry the
# last digit of the protocol version.
VERSION_CUTOVER = "20171101"
FEED_FILE_PATTERN = r"data_feeds_\d{8}_\d{8}_IEXTP1_TOPS1\.\d\.pcap\.gz"
FEED_STEM = "data_feeds_"


def protocol_version(date_str: Column) -> Column:
    return F.when(date_str < VERSION_CUTOVER, "1.5").otherwise("1.6")


def feed_file_name(date_str: Column) -> Column:
    return F.concat(
        F.lit(FEED_STEM), date_str, F.lit("_"), date_str,
        F.lit("_IEXTP1_TOPS"), protocol_version(date_str), F.lit(".pcap.gz"),
    )


def feed_date(path: Column) -> Column:
    """Trading day named by a feed file's path; NULL when the name does not fit.

    The last stem counts, so a parent folder which looks like a feed file does not
    mislead.
    """
    digits = F.split_part(F.substring_index(path, FEED_STEM, -1), F.lit("_"), F.lit(1))
    return F.try_to_date(digits, "yyyyMMdd")


def valid_text(value: Column) -> Column:
    """The text without the bytes which are not valid UTF-8."""
    repaired = F.replace(F.make_valid_utf8(value), F.lit("�"), F.lit(""))
    return F.when(F.is_valid_utf8(value), value).otherwise(repaired)
