"""Object keys and file paths as columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def notified_key(key: Column) -> Column:
    """Key as sent in a notification: '+' stands for a space, %XX for a byte."""
    return F.url_decode(key)


def decoded_path(path: Column) -> Column:
    """`_metadata.file_path` without percent-encoding; a literal '+' stays a '+'."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def source_name(path: Column) -> Column:
    """Last path segment with every '.json' removed."""
    return F.replace(F.regexp_extract(path, "[^/]+$", 0), F.lit(".json"), F.lit(""))


def source_key(path: Column) -> Column:
    """Name plus a hash of the whole path, so equal names in two folders stay apart."""
    return F.concat_ws("-", source_name(path), F.lower(F.hex(F.xxhash64(path))))
