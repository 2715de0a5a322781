"""Judging one line of order-event JSON with built-in functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schemas import REQUIRED_EVENT_KEYS

# What str.strip() removes around an ASCII line.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"

_EVENT = "struct<" + ", ".join(f"{key}: variant" for key in REQUIRED_EVENT_KEYS) + ">"
_OPTIONS = {"columnNameOfCorruptRecord": "broken", "allowSingleQuotes": "false"}
_END_MARK = "end of event"

# A closing bracket behind an object: the one thing that could end the list around the line early.
_CLOSED_LIST = r"\}\s*\]"


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITESPACE))


def parsed_event(line: Column) -> Column:
    """Struct `events`, `end_mark`, `broken`, with the required keys as variants.

    The JSON reader stops behind the first value, so the line is read inside a list with an end
    mark behind it: whatever follows the event breaks the text, adds a second item or hides the
    mark. Keys of no interest are skipped, not built.
    """
    wrapped = F.concat(F.lit('{"events":['), line, F.lit(f'],"end_mark":"{_END_MARK}"}}'))
    schema = f"events array<{_EVENT}>, end_mark string, broken string"
    return F.from_json(wrapped, schema, _OPTIONS)


def _is_one_event(line: Column, parsed: Column) -> Column:
    alone = (
        parsed["broken"].isNull()
        & parsed["end_mark"].eqNullSafe(F.lit(_END_MARK))
        & (F.size(parsed["events"]) == 1)
    )
    as_member = F.concat(F.lit('{"event":'), line, F.lit("}"))
    fits = F.from_json(as_member, "broken string", _OPTIONS)["broken"].isNull()
    return alone & F.when(line.rlike(_CLOSED_LIST), fits).otherwise(True)


def is_positive_number(value: Column) -> Column:
    """JSON number (or true, which counts as 1) above zero; text that looks like a number is not."""
    positive = F.try_variant_get(value, "$", "double") > 0
    return F.coalesce(positive & (F.schema_of_variant(value) != "STRING"), F.lit(False))


def rejection_reason(line: Column, parsed: Column) -> Column:
    """Why the line is no valid event, NULL if it is one. The first reason that applies wins."""
    event = F.get(parsed["events"], F.lit(0))
    readable = F.is_valid_utf8(line) & _is_one_event(line, parsed)
    missing = F.lit(False)
    for key in REQUIRED_EVENT_KEYS:
        missing = missing | event[key].isNull()
    return (
        F.when(~F.coalesce(readable, F.lit(False)), "malformed_json")
        .when(missing, "missing_fields")
        .when(~is_positive_number(event["quantity"]), "invalid_quantity")
        .when(~is_positive_number(event["price"]), "invalid_price")
    )
