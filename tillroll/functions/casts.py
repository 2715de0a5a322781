"""Text-to-number casts that give NULL on bad text, whatever the session's ANSI setting."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"


def whole_number(column: Column, source_type: T.DataType) -> Column:
    """Integer cast that truncates decimals: '6.7' and '6.0' give 6, '1e2' and 'abc' give NULL.

    Plain integers take the first, cheap cast; only text it refuses reaches the pattern.
    """
    direct = column.try_cast("int")
    if not isinstance(source_type, T.StringType):
        return direct
    truncated = column.try_cast("decimal(38,10)").try_cast("int")
    return F.coalesce(direct, F.when(column.rlike(PLAIN_NUMBER), truncated))


def real_number(column: Column) -> Column:
    return column.try_cast("double")


def instant(column: Column) -> Column:
    return column.try_cast("timestamp")
