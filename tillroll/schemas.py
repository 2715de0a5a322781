"""Column contracts of the lake. Names and types are part of the data format."""

from pyspark.sql import types as T

RAW_COLUMNS = (
    "Invoice",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "Price",
    "Customer ID",
    "Country",
)

RAW_RENAMES = {"Customer ID": "CustomerID", "Price": "UnitPrice"}

# Columns that newer files may carry; older files get NULL of this type.
OPTIONAL_COLUMNS = {"loyalty_tier": T.StringType()}

CURATED_SCHEMA = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
        T.StructField("loyalty_tier", T.StringType()),
        T.StructField("Revenue", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

CURATED_PARTITIONS = ("year", "month", "ingest_batch")

# Where the writer of a curated table notes columns the schema does not declare; scans skip it.
NOTED_COLUMNS = "_noted_columns"

# Where compaction notes which batches it replaced; scans skip it.
COMPACTION_LOG = "_compactions"

REQUIRED_EVENT_KEYS = ("invoice", "stockcode", "quantity", "price", "customerid")

# Arrival notification of the object store.
NOTIFICATION_SCHEMA = (
    "Records array<struct<s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>"
)

# Message left behind for a file that could not be ingested.
DEAD_LETTER_SCHEMA = (
    "timestamp timestamp, "
    "requestContext struct<requestId: string, condition: string, approximateInvokeCount: int>, "
    "requestPayload struct<Records: array<struct<eventName: string, eventTime: timestamp, "
    "s3: struct<bucket: struct<name: string>, object: struct<key: string, size: bigint>>>>>, "
    "responsePayload struct<errorMessage: string, errorType: string, stackTrace: array<string>>"
)
