"""Cleaning of raw order lines. All steps are narrow: one pass, no shuffle, no Python worker."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.casts import instant, real_number, whole_number
from tillroll.schemas import OPTIONAL_COLUMNS, RAW_RENAMES


def backfill_optional(
    df: DataFrame, optional: Mapping[str, T.DataType] = OPTIONAL_COLUMNS
) -> DataFrame:
    """Add every optional column the frame lacks as a typed NULL."""
    present = {name.lower() for name in df.columns}
    return df.withColumns(
        {
            name: F.lit(None).cast(kind)
            for name, kind in optional.items()
            if name.lower() not in present
        }
    )


def clean_orders(
    raw: DataFrame, optional: Mapping[str, T.DataType] = OPTIONAL_COLUMNS
) -> DataFrame:
    """Typed, filtered order lines with revenue and partition columns.

    Kept are lines with a customer, an invoice that is not cancelled, and positive quantity and
    price. A line whose date does not parse is kept with a NULL date. Duplicates are kept, and
    columns this function does not know pass through.
    """
    named = backfill_optional(raw.withColumnsRenamed(RAW_RENAMES), optional)
    typed = named.withColumns(
        {
            "Quantity": whole_number(F.col("Quantity"), named.schema["Quantity"].dataType),
            "UnitPrice": real_number(F.col("UnitPrice")),
            "CustomerID": real_number(F.col("CustomerID")),
        }
    )
    kept = typed.where(
        F.col("CustomerID").isNotNull()
        & ~F.startswith(F.col("Invoice").cast("string"), F.lit("C"))
        & (F.col("Quantity") > 0)
        & (F.col("UnitPrice") > 0)
    )
    return kept.withColumns(
        {
            "Revenue": F.col("Quantity") * F.col("UnitPrice"),
            "InvoiceDate": instant(F.col("InvoiceDate")),
        }
    ).withColumns({"year": F.year("InvoiceDate"), "month": F.month("InvoiceDate")})
