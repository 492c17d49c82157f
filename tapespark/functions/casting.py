"""Bringing loosely typed rows to a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: A time's offset from UTC, after its hours.
OFFSET = r":\d.*(?:[Zz]|[+-]\d{1,2}(?::?\d{2})?)\s*$"


def safe_cast(value: Column, target: T.DataType, source: T.DataType | None = None) -> Column:
    """Null-preserving cast; what cannot be converted becomes NULL, NaN too."""
    if isinstance(source, T.BinaryType) and isinstance(target, T.StringType):
        # Bytes that are not text become NULL; decoding them would end the job.
        return F.try_validate_utf8(value.cast("string"))
    if isinstance(target, T.TimestampNTZType) and (source is None or isinstance(source, T.StringType)):
        return _utc(value)
    cast = value.try_cast(target)
    if isinstance(target, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(cast), cast)
    return cast


def _utc(text: Column) -> Column:
    """A time without zone; one with an offset is brought to UTC first."""
    told = F.try_to_timestamp(text)
    moved = F.convert_timezone(F.current_timezone(), F.lit("UTC"), told.cast("timestamp_ntz"))
    return F.when(text.rlike(OFFSET), moved).otherwise(text.try_cast("timestamp_ntz"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, typed; absent ones are NULL."""
    given = {field.name: field.dataType for field in df.schema.fields}
    return df.select(*[
        (
            safe_cast(F.col(f"`{field.name}`"), field.dataType, given[field.name])
            if field.name in given
            else F.lit(None).cast(field.dataType)
        ).alias(field.name)
        for field in schema.fields
    ])
