"""The registered queries as plain SQL for DuckDB over the same tables."""

_RAW = """
raw AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS "Invoice",
         CAST(l_partkey AS VARCHAR) AS "StockCode",
         CASE l_linenumber WHEN 5 THEN NULL WHEN 4 THEN p_name || ' (second)'
              WHEN 3 THEN p_name || chr(10) || '"quoted", on two lines' ELSE p_name
         END AS "Description",
         CASE l_partkey % 41 WHEN 5 THEN 'abc' WHEN 6 THEN units || '.7' WHEN 7 THEN '1e2'
              ELSE units END AS "Quantity",
         CASE WHEN l_orderkey % 97 = 0 THEN 'unknown'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS "InvoiceDate",
         CASE WHEN l_tax = 0 THEN '0' WHEN l_partkey % 41 = 8 THEN 'n/a'
              ELSE CAST(floor(l_extendedprice) / 100 AS VARCHAR) END AS "Price",
         CASE WHEN o_custkey % 10 <> 0
              THEN CASE WHEN o_custkey % 17 = 3 THEN 'x' ELSE '' END || CAST(o_custkey AS VARCHAR)
         END AS "Customer ID",
         n_name AS "Country",
         CASE WHEN year(o_orderdate) >= 2000
              THEN CASE o_custkey % 3 WHEN 0 THEN 'Gold' WHEN 1 THEN 'Silver' ELSE 'Bronze' END
         END AS loyalty_tier
  FROM (SELECT *, CAST(CASE WHEN l_linenumber = 7 THEN -CAST(l_quantity AS INTEGER)
                            ELSE CAST(l_quantity AS INTEGER) END AS VARCHAR) AS units
        FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""

_EVOLVED = (
    _RAW
    + """,
typed AS (
  SELECT * REPLACE (
           CAST(trunc(TRY_CAST(CASE WHEN regexp_full_match("Quantity", '[-+]?[0-9]+([.][0-9]*)?')
                                    THEN "Quantity" END AS DOUBLE)) AS INTEGER) AS "Quantity",
           TRY_CAST("InvoiceDate" AS TIMESTAMP) AS "InvoiceDate",
           TRY_CAST("Price" AS DOUBLE) AS "Price",
           TRY_CAST("Customer ID" AS DOUBLE) AS "Customer ID")
  FROM raw
),
evolved AS (
  SELECT "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price" AS "UnitPrice",
         "Customer ID" AS "CustomerID", "Country", loyalty_tier, "Quantity" * "Price" AS "Revenue",
         CAST(year("InvoiceDate") AS INTEGER) AS year,
         CAST(month("InvoiceDate") AS INTEGER) AS month
  FROM typed
  WHERE "Customer ID" IS NOT NULL AND "Invoice" NOT LIKE 'C%' AND "Quantity" > 0 AND "Price" > 0
)"""
)

_CLEAN = (
    _EVOLVED
    + """,
clean AS (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS loyalty_tier) FROM evolved)"""
)

_DAILY = (
    _CLEAN
    + """,
daily AS (
  SELECT CAST("InvoiceDate" AS DATE) AS order_date, round(sum("Revenue"), 2) AS total_revenue,
         count(DISTINCT "Invoice") AS num_orders, count(DISTINCT "CustomerID") AS num_customers,
         CAST(sum("Quantity") AS BIGINT) AS total_units
  FROM clean GROUP BY 1
)"""
)

_RFM = (
    _CLEAN
    + """,
rfm AS (
  SELECT "CustomerID",
         CAST(date_diff('day', CAST(max("InvoiceDate") AS DATE),
              (SELECT CAST(max("InvoiceDate") AS DATE) FROM clean)) AS INTEGER) AS recency_days,
         count(DISTINCT "Invoice") AS frequency, round(sum("Revenue"), 2) AS monetary
  FROM clean GROUP BY "CustomerID"
)"""
)

_SEGMENTS = (
    _RFM
    + """,
scored AS (
  SELECT "CustomerID" AS customerid, recency_days, frequency, monetary,
         CAST(ntile(4) OVER (ORDER BY recency_days ASC NULLS LAST, "CustomerID") AS BIGINT) AS r_score,
         CAST(ntile(4) OVER (ORDER BY frequency DESC NULLS LAST, "CustomerID") AS BIGINT) AS f_score,
         CAST(ntile(4) OVER (ORDER BY monetary DESC NULLS LAST, "CustomerID") AS BIGINT) AS m_score
  FROM rfm
),
segments AS (
  SELECT *, CASE WHEN r_score = 1 AND f_score = 1 AND m_score = 1 THEN 'Champions'
                 WHEN r_score <= 2 AND f_score <= 2 THEN 'Loyal'
                 WHEN r_score = 1 AND f_score >= 3 THEN 'New Customers'
                 WHEN r_score = 4 AND f_score = 4 THEN 'Lost'
                 WHEN r_score >= 3 AND m_score <= 2 THEN 'At Risk'
                 ELSE 'Other' END AS segment
  FROM scored
)"""
)

_PRODUCTS = (
    _CLEAN
    + """,
described AS (
  SELECT "StockCode" AS code, "Description" AS description, min("InvoiceDate") AS seen
  FROM clean WHERE "Description" IS NOT NULL GROUP BY 1, 2
),
earliest AS (
  SELECT code, description FROM described
  QUALIFY row_number() OVER (PARTITION BY code ORDER BY seen NULLS LAST, description) = 1
),
totals AS (
  SELECT "StockCode", round(sum("Revenue"), 2) AS total_revenue,
         CAST(sum("Quantity") AS BIGINT) AS total_units, count(DISTINCT "Invoice") AS num_orders
  FROM clean GROUP BY "StockCode"
),
products AS (
  SELECT "StockCode", description, total_revenue, total_units, num_orders
  FROM totals LEFT JOIN earliest ON "StockCode" = code
)"""
)

_TREND = """
SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
       round(sum(total_revenue), 2) AS total_revenue, CAST(sum(num_orders) AS BIGINT) AS num_orders,
       CAST(sum(num_customers) AS BIGINT) AS num_customers,
       CAST(sum(total_units) AS BIGINT) AS total_units
FROM daily GROUP BY 1, 2 ORDER BY 1, 2"""

_EVENTS = """
plain AS (
  SELECT event_id, event_id % 20 AS source,
         '{"invoice":"' || event_id || '","stockcode":"' || event_type || '","quantity":'
         || CASE event_id % 10 WHEN 0 THEN CAST(-(1 + event_id % 9) AS VARCHAR)
                               WHEN 3 THEN '"' || (1 + event_id % 9) || '"'
                               ELSE CAST(1 + event_id % 9 AS VARCHAR) END
         || ',"price":' || CASE event_id % 10 WHEN 4 THEN '-' || amount
                               WHEN 5 THEN '"' || amount || '"' ELSE amount END
         || CASE event_id % 10 WHEN 1 THEN '' ELSE ',"customerid":' || user_id END
         || CASE event_id % 10 WHEN 2 THEN '' ELSE '}' END AS line
  FROM (SELECT *, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount FROM events)
),
judged AS (
  SELECT *, CASE
    WHEN NOT json_valid(line) THEN 'malformed_json'
    WHEN NOT list_has_all(json_keys(line),
                          ['invoice', 'stockcode', 'quantity', 'price', 'customerid'])
      THEN 'missing_fields'
    WHEN json_type(line, '$.quantity') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE')
      OR CAST(line->>'$.quantity' AS DOUBLE) <= 0 THEN 'invalid_quantity'
    WHEN json_type(line, '$.price') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE')
      OR CAST(line->>'$.price' AS DOUBLE) <= 0 THEN 'invalid_price'
  END AS reason
  FROM plain
)"""


def _checks(source: str, rows: int, columns: tuple[str, ...], total: float, years: list[str]) -> str:
    """The four rules over `source`, one row each."""
    listed = ", ".join(f"'{year}'" for year in years)
    nulls = ", ".join(f"count(*) FILTER ({c} IS NULL) / count(*) AS null_{c}" for c in columns)
    worst = f"greatest({', '.join(f'null_{c}' for c in columns)}, 0)"
    broken = " , ".join(
        f"CASE WHEN null_{c} > 0 THEN printf('{c} null rate %.4f', null_{c}) END" for c in columns
    )
    quoted = "'[''' || array_to_string({0}, ''', ''') || ''']'"
    return f""",
m AS (
  SELECT count(*) AS n, {nulls}, sum("Revenue") AS total,
         list_sort(list(DISTINCT CAST(year AS VARCHAR))) AS years
  FROM {source}
),
w AS (SELECT *, {worst} AS worst,
      list_sort(list_filter([{listed}], lambda y: NOT list_contains(years, y))) AS missing FROM m)
SELECT 'row_count' AS "check", n >= {rows} AS passed,
       CASE WHEN n >= {rows} THEN 'Row count ' || n || ' OK'
            ELSE 'Row count ' || n || ' below minimum {rows}' END AS message,
       CAST(n AS DOUBLE) AS observed, CAST({rows} AS DOUBLE) AS threshold FROM w
UNION ALL
SELECT 'critical_nulls', worst <= 0,
       CASE WHEN worst <= 0 THEN 'Null rates within threshold (max allowed 0.0)'
            ELSE array_to_string([x FOR x IN [{broken}] IF x IS NOT NULL], '; ') END,
       CAST(worst AS DOUBLE), CAST(0 AS DOUBLE) FROM w
UNION ALL
SELECT 'revenue_sanity', total >= {total!r},
       CASE WHEN total >= {total!r} THEN 'Total revenue ' || format('{{:,.2f}}', total) || ' OK'
            ELSE 'Total revenue ' || format('{{:,.2f}}', total) || ' below minimum {total:,.2f}' END,
       round(total, 2), CAST({total!r} AS DOUBLE) FROM w
UNION ALL
SELECT 'partitions', len(missing) = 0,
       CASE WHEN len(missing) = 0
            THEN 'All expected year partitions present: ' || {quoted.format("years")}
            ELSE 'Missing year partitions: ' || {quoted.format("missing")} END,
       CAST(len(missing) AS DOUBLE), CAST(0 AS DOUBLE) FROM w"""


_YEARS = [str(year) for year in range(1995, 2002)]

ORACLE = {
    "raw_scan": f"WITH {_RAW} SELECT * FROM raw",
    "curated_scan": f"WITH {_CLEAN} SELECT * FROM clean",
    "incremental_clean": f"WITH {_EVOLVED} SELECT * FROM evolved",
    "archived_replay": f"WITH {_EVOLVED} SELECT * FROM evolved",
    "clean_orders": f"WITH {_CLEAN} SELECT * FROM clean",
    "backfill_optional": f"""WITH {_RAW}
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS loyalty_tier) FROM raw""",
    "schema_evolution": f"WITH {_EVOLVED} SELECT * FROM evolved",
    "union_parts": f"WITH {_RAW} SELECT * FROM raw",
    "loyalty_tier_counts": f"""WITH {_EVOLVED}
SELECT coalesce(loyalty_tier, '(legacy)') AS loyalty_tier, count(*) AS num_rows
FROM evolved GROUP BY 1""",
    "daily_revenue": f"""WITH {_DAILY}
SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM daily ORDER BY order_date""",
    "customer_rfm": f"WITH {_RFM} SELECT * FROM rfm",
    "top_products": f"""WITH {_PRODUCTS}
SELECT * FROM products ORDER BY total_revenue DESC NULLS LAST, "StockCode" """,
    "monthly_revenue": f"""WITH {_CLEAN}
SELECT year, month, round(sum("Revenue"), 2) AS total_revenue,
       count(DISTINCT "Invoice") AS num_orders, count(DISTINCT "CustomerID") AS num_customers
FROM clean GROUP BY year, month ORDER BY year, month""",
    "revenue_trend": f"WITH {_DAILY} {_TREND}",
    "customer_segments": f"WITH {_SEGMENTS} SELECT * FROM segments",
    "segment_summary": f"""WITH {_SEGMENTS},
totals AS (
  SELECT segment, count(*) AS customers,
         CAST(sum(CAST(round(monetary * 100) AS BIGINT)) AS HUGEINT) AS cents
  FROM segments GROUP BY segment
)
SELECT segment, customers, CAST((2 * cents + customers) // (2 * customers) AS DOUBLE) / 100 AS average_spend
FROM totals ORDER BY segment""",
    "top_products_ranked": f"""WITH {_PRODUCTS}
SELECT "StockCode" AS stockcode, description, total_revenue, total_units, num_orders,
       CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS BIGINT) AS revenue_rank
FROM products ORDER BY total_revenue DESC NULLS LAST, "StockCode" LIMIT 50""",
    "quality_checks": f"WITH {_CLEAN}"
    + _checks("clean", 1000, ("Invoice", "CustomerID", "Revenue"), 1e6, _YEARS),
    "quality_failures": f"WITH {_EVOLVED}"
    + _checks("evolved", 10**15, ("invoice", "loyalty_tier"), 1e18, [*_YEARS, "2002", "2003"]),
    "gated_build": f"WITH {_DAILY} {_TREND}",
    "event_lines": f"WITH {_EVENTS} SELECT event_id, source, line FROM plain",
    "event_validation": f"WITH {_EVENTS} SELECT event_id, source, line, reason FROM judged",
    "valid_events": f"WITH {_EVENTS} SELECT event_id, source, line FROM judged WHERE reason IS NULL",
    "rejected_events": f"""WITH {_EVENTS}
SELECT event_id, source, line, reason FROM judged WHERE reason IS NOT NULL""",
    "event_file_stats": f"""WITH {_EVENTS}
SELECT (event_id // 10) % 20 AS source, count(*) FILTER (reason IS NULL) AS n_valid,
       count(*) FILTER (reason IS NOT NULL) AS n_bad
FROM judged GROUP BY 1""",
    "dead_files": f"""WITH {_EVENTS}
SELECT 'orders_' || source || '.json' AS source, 'ValidationError' AS error_type,
       'No valid events in orders_' || source || '.json' AS error_message, count(*) AS n_lines
FROM judged GROUP BY source HAVING count(*) FILTER (reason IS NULL) = 0""",
    "event_ingest": f"WITH {_EVENTS} SELECT line, reason FROM judged",
    "event_redrop": f"WITH {_EVENTS} SELECT line, reason FROM judged",
    "event_compaction": f"WITH {_EVENTS} SELECT line, reason FROM judged",
    "event_replay": f"""WITH {_EVENTS}
SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, line, reason
FROM judged
UNION ALL
SELECT 'dead', 'ValidationError', CAST(count(*) AS VARCHAR) FROM judged WHERE event_id % 10 < 6""",
    "catalog_reports": f"""WITH {_SEGMENTS}, {_PRODUCTS.replace(_CLEAN + ",", "")},
{_DAILY.replace(_CLEAN + ",", "")}
SELECT 'gate' AS report, 'row_count' AS name, CAST(count(*) AS DOUBLE) AS value FROM clean
UNION ALL
SELECT 'monthly', coalesce(CAST(year AS VARCHAR), 'none') || '-' || coalesce(CAST(month AS VARCHAR), 'none'),
       CAST(count(DISTINCT "CustomerID") AS DOUBLE) FROM clean GROUP BY year, month
UNION ALL
SELECT 'trend', coalesce(CAST(year(order_date) AS VARCHAR), 'none') || '-'
                || coalesce(CAST(month(order_date) AS VARCHAR), 'none'),
       CAST(sum(num_customers) AS DOUBLE) FROM daily GROUP BY year(order_date), month(order_date)
UNION ALL
SELECT 'segments', segment, CAST(count(*) AS DOUBLE) FROM segments GROUP BY segment
UNION ALL
SELECT * FROM (
  SELECT 'products', "StockCode", CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS DOUBLE)
  FROM products ORDER BY total_revenue DESC NULLS LAST, "StockCode" LIMIT 50)""",
    "incremental_warehouse": f"""WITH {_SEGMENTS}, {_PRODUCTS.replace(_CLEAN + ",", "")},
{_DAILY.replace(_CLEAN + ",", "")}
SELECT 'daily_revenue' AS report, coalesce(CAST(order_date AS VARCHAR), 'none') AS name,
       CAST(total_revenue AS DOUBLE) AS value_0, CAST(num_orders AS DOUBLE) AS value_1,
       CAST(num_customers AS DOUBLE) AS value_2, CAST(total_units AS DOUBLE) AS value_3 FROM daily
UNION ALL
SELECT 'customer_rfm', CAST("CustomerID" AS VARCHAR), CAST(recency_days AS DOUBLE),
       CAST(frequency AS DOUBLE), monetary, NULL FROM rfm
UNION ALL
SELECT 'top_products', "StockCode", total_revenue, CAST(num_orders AS DOUBLE),
       CAST(total_units AS DOUBLE), NULL FROM products
UNION ALL
SELECT 'customer_segments', CAST(customerid AS VARCHAR), CAST(r_score AS DOUBLE),
       CAST(f_score AS DOUBLE), CAST(m_score AS DOUBLE), NULL FROM segments""",
    "incremental_products": f"""WITH {_PRODUCTS}
SELECT * FROM products ORDER BY total_revenue DESC NULLS LAST, "StockCode" """,
    "compacted_scan": f"WITH {_CLEAN} SELECT * FROM clean",
    "passed_through": f"""WITH {_CLEAN}
SELECT "Invoice", "StockCode", "Country" AS store FROM clean""",
    "notification_keys": """
SELECT event_id, 'raw' AS bucket, 'incoming/' || event_type || ' orders+' || event_id || '.json' AS key,
       event_type || ' orders+' || event_id AS source_name
FROM events
UNION ALL
SELECT event_id, 'raw', 'incoming/sub dir/' || event_id || '.json.json', CAST(event_id AS VARCHAR)
FROM events WHERE event_id % 2 <> 0""",
    "dead_letter_triage": """
SELECT 'req-' || event_id AS request_id, 'RetriesExhausted' AS condition, CAST(3 AS INTEGER) AS attempts,
       'raw' AS bucket, 'incoming/bad file ' || event_id || '.json' AS key, event_id % 1000 AS size,
       'ValidationError' AS error_type,
       'No valid events in incoming/bad+file+' || event_id || '.json' AS error_message,
       CAST(180 + event_id % 60 AS DOUBLE) AS seconds_to_dead_letter
FROM events""",
}
