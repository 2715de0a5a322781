"""Small inputs shared by the tests."""

from tillroll.schemas import RAW_COLUMNS

RAW = list(RAW_COLUMNS)

# One good line; the others are named by what is changed in it.
GOOD = {
    "Invoice": "700001",
    "StockCode": "MUG-1",
    "Description": "blue mug",
    "Quantity": "4",
    "InvoiceDate": "2014-07-03 11:05:00",
    "Price": "3.50",
    "Customer ID": "31",
    "Country": "Norway",
}


def line(**changes):
    """The good line with some columns changed."""
    return tuple({**GOOD, **changes}[name] for name in RAW)


SECOND = line(Invoice="700002", StockCode="LAMP", Description="lamp", Quantity="3", Price="8.25", **{"Customer ID": "44"})
DROPPED = {
    "cancelled": line(Invoice="C700003"),
    "nobody": line(**{"Customer ID": None}),
    "returned": line(Quantity="-2"),
    "given away": line(Price="0"),
}
LINES = [line(), SECOND, *DROPPED.values()]


def raw_frame(spark, rows=LINES, columns=RAW):
    schema = ", ".join(f"`{name}` string" for name in columns)
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def plan_of(df):
    return df._jdf.queryExecution().toString()
