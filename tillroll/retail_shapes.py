"""Retail-shaped inputs derived from the star-schema tables the queries are checked on.

The tables are clean, so dirt is derived from keys and flags; see FIXTURES.md.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_YEAR_WITH_TIER = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(
    spark: SparkSession, sf_dir: str, tier: bool = False, period: Column | None = None
) -> DataFrame:
    """Raw order lines as text, eight columns, or nine with the loyalty tier.

    Among them are cancelled lines, numbers no cast reads or one has to cut, dates nobody can read,
    missing and second descriptions, and descriptions with quotes and line breaks. `period` is a
    condition on the order date itself, which reaches the scan.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = table(spark, sf_dir, "orders")
    buyers = (
        (orders if period is None else orders.where(period))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    number, part = F.col("l_linenumber"), F.col("l_partkey") % 41
    units = F.col("l_quantity").cast("int")
    signed = F.when(number == 7, -units).otherwise(units).cast("string")
    price = (F.floor("l_extendedprice") / 100).cast("string")
    customer = F.col("o_custkey").cast("string")
    columns = {
        "Invoice": F.concat(
            F.when(F.col("l_returnflag") == "R", "C").otherwise(""),
            F.col("l_orderkey").cast("string"),
        ),
        "StockCode": F.col("l_partkey").cast("string"),
        "Description": F.when(number == 5, F.lit(None))
        .when(number == 4, F.concat("p_name", F.lit(" (second)")))
        .when(number == 3, F.concat("p_name", F.lit('\n"quoted", on two lines')))
        .otherwise(F.col("p_name")),
        "Quantity": F.when(part == 5, "abc")
        .when(part == 6, F.concat(signed, F.lit(".7")))
        .when(part == 7, "1e2")
        .otherwise(signed),
        "InvoiceDate": F.when(F.col("l_orderkey") % 97 == 0, "unknown").otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
        ),
        "Price": F.when(F.col("l_tax") == 0, "0").when(part == 8, "n/a").otherwise(price),
        "Customer ID": F.when(
            F.col("o_custkey") % 10 != 0,
            F.when(F.col("o_custkey") % 17 == 3, F.concat(F.lit("x"), customer)).otherwise(customer),
        ),
        "Country": F.col("n_name"),
    }
    if tier:
        columns["loyalty_tier"] = F.get(
            F.array(F.lit("Gold"), F.lit("Silver"), F.lit("Bronze")), F.col("o_custkey") % 3
        )
    return lines.select(*(column.alias(name) for name, column in columns.items()))


def _has_tier() -> Column:
    return F.col("o_orderdate") >= F.lit(f"{FIRST_YEAR_WITH_TIER}-01-01").cast("timestamp_ntz")


def old_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from before the tier column existed, and any without a date."""
    return raw_orders(spark, sf_dir, period=~_has_tier() | F.col("o_orderdate").isNull())


def new_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_orders(spark, sf_dir, tier=True, period=_has_tier())


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines with their source number, padded with white space and mixed with blank lines."""
    kind = F.col("event_id") % 10
    units = 1 + F.col("event_id") % 9
    quantity = (
        F.when(kind == 0, (-units).cast("string"))
        .when(kind == 3, F.concat(F.lit('"'), units.cast("string"), F.lit('"')))
        .otherwise(units.cast("string"))
    )
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    price = (
        F.when(kind == 4, F.concat(F.lit("-"), amount))
        .when(kind == 5, F.concat(F.lit('"'), amount, F.lit('"')))
        .otherwise(amount)
    )
    customer = F.when(kind == 1, "").otherwise(
        F.concat(F.lit(',"customerid":'), F.col("user_id").cast("string"))
    )
    line = F.concat(
        F.lit('{"invoice":"'),
        F.col("event_id").cast("string"),
        F.lit('","stockcode":"'),
        F.col("event_type"),
        F.lit('","quantity":'),
        quantity,
        F.lit(',"price":'),
        price,
        customer,
        F.when(kind == 2, "").otherwise("}"),
    )
    return table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % 20).alias("source"), line.alias("line")
    )


def mixed_source(events: DataFrame) -> DataFrame:
    """The same lines dealt to sources that each hold good and bad ones."""
    return events.withColumn("source", F.floor(F.col("event_id") / 10) % 20)


def padded_lines(events: DataFrame) -> DataFrame:
    """Each line with blanks around it, and a blank line behind every seventh."""
    padded = F.concat(F.lit("  "), F.col("line"), F.lit(" \t"))
    blanks = F.when(F.col("event_id") % 7 == 0, F.array(padded, F.lit("   "))).otherwise(
        F.array(padded)
    )
    return events.withColumn("line", F.explode(blanks))


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One arrival notification per event, naming one object or two, keys URL-encoded."""
    number = F.col("event_id").cast("string")

    def record(key: Column) -> Column:
        return F.concat(
            F.lit('{"s3":{"bucket":{"name":"raw"},"object":{"key":"'), key, F.lit('"}}}')
        )

    named = F.concat(F.col("event_type"), F.lit("+orders%2B"), number, F.lit(".json"))
    first = record(F.concat(F.lit("incoming/"), named))
    second = record(F.concat(F.lit("incoming/sub%20dir/"), number, F.lit(".json.json")))
    records = F.when(F.col("event_id") % 2 == 0, first).otherwise(F.concat_ws(",", first, second))
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit('{"Records":['), records, F.lit("]}")).alias("payload")
    )


def dead_letter_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dead-letter message per event, three minutes and more after it."""
    number = F.col("event_id").cast("string")
    key = F.concat(F.lit("incoming/bad+file+"), number, F.lit(".json"))

    def iso(at: Column) -> Column:
        return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    gone = F.col("ts") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(3), F.col("event_id") % 60
    )
    message = F.concat(
        F.lit('{"timestamp":"'),
        iso(gone),
        F.lit('","requestContext":{"requestId":"req-'),
        number,
        F.lit('","condition":"RetriesExhausted","approximateInvokeCount":3},'),
        F.lit('"requestPayload":{"Records":[{"eventName":"ObjectCreated:Put","eventTime":"'),
        iso(F.col("ts")),
        F.lit('","s3":{"bucket":{"name":"raw"},"object":{"key":"'),
        key,
        F.lit('","size":'),
        (F.col("event_id") % 1000).cast("string"),
        F.lit('}}}]},"responsePayload":{"errorMessage":"No valid events in '),
        key,
        F.lit('","errorType":"ValidationError","stackTrace":["a","b"]}}'),
    )
    return table(spark, sf_dir, "events").select(message.alias("message"))
