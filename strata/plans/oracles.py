"""What each registered query must return, as SQL over the test tables.

The statements start again from the base tables and do not follow the plans of
the queries: merges are unions of what is kept, changed and added, streams are
their final state, feeds are computed from numbers and not from text.
"""

from __future__ import annotations

ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# ---- shared parts ---------------------------------------------------------------------

_NOISY = """CASE WHEN o_orderkey % 7 = 0 THEN '  ' ELSE '' END
    || CASE WHEN o_orderkey % 3 = 0 THEN upper({0}) ELSE {0} END
    || CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE '' END"""

_STATUS = """CASE WHEN o_orderkey % 110 = 0 THEN NULL
    WHEN o_orderkey % 90 = 0 THEN 'returned'
    ELSE CASE o_orderstatus WHEN 'O' THEN 'created' WHEN 'F' THEN 'paid' WHEN 'P' THEN 'cancelled' END END"""

#: Order feed with the typed values beside the texts.
FEED = f"""
copies AS (
  SELECT o.*, lower(n_name) AS nation, 0 AS copy
  FROM orders o LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT o.*, lower(n_name) AS nation, 1 AS copy
  FROM orders o LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderkey % 20 = 0
),
feed AS (
  SELECT
    CAST(o_orderkey AS VARCHAR) AS order_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN o_orderkey % 70 = 0 THEN NULL WHEN o_orderkey % 130 = 0 THEN 'not a time'
      ELSE strftime(o_orderdate + to_hours(copy), '%Y-%m-%d %H:%M:%S') END AS order_ts,
    CASE WHEN o_orderkey % 70 = 0 OR o_orderkey % 130 = 0 THEN NULL
      ELSE o_orderdate + to_hours(copy) END AS order_time,
    {_NOISY.format("lower(o_orderpriority)")} AS channel,
    lower(o_orderpriority) AS channel_clean,
    CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE CAST(o_totalprice + copy AS VARCHAR) END AS amount,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_totalprice + copy END AS amount_value,
    {_NOISY.format(f"({_STATUS})")} AS status,
    {_STATUS} AS status_clean,
    upper(nation) AS country
  FROM copies
)"""

SILVER = f"""{FEED},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY order_id ORDER BY order_time DESC NULLS LAST, amount_value DESC NULLS LAST) AS rn
  FROM feed
),
silver AS (
  SELECT order_id, customer_id, order_ts, channel, amount, status, country, amount_value, order_time,
    status_clean, channel_clean, CAST(order_time AS DATE) AS order_date,
    order_time IS NOT NULL AND amount_value IS NOT NULL
      AND coalesce(status_clean, '') IN ('created', 'paid', 'cancelled') AS is_valid
  FROM ranked WHERE rn = 1
)"""

_EXACT_SUM = "CAST(round(sum(CAST({0} AS DECIMAL(18, 4))), 2) AS DOUBLE)"

GOLD = f"""{SILVER},
paid AS (
  SELECT order_date, channel_clean AS channel, amount_value,
    CAST(floor(amount_value * 10000.0 + 0.5) AS BIGINT) AS units
  FROM silver WHERE is_valid AND status_clean = 'paid'
),
gold AS (
  SELECT order_date, channel, count(*) AS paid_orders,
    {_EXACT_SUM.format("amount_value")} AS revenue,
    CAST((2 * sum(units) + 100 * count(*)) // (200 * count(*)) AS DOUBLE) / 100.0 AS mean_ticket
  FROM paid GROUP BY order_date, channel
)"""

EVENTS = """
made AS (
  SELECT l_orderkey AS sale_id, l_linenumber AS line_no,
    CASE l_returnflag WHEN 'N' THEN 'SALE' WHEN 'A' THEN 'ADJUSTMENT' WHEN 'R' THEN 'CANCEL' END AS event_type,
    CAST(l_shipdate AS DATE) AS event_date, l_partkey AS product_id, l_suppkey AS supplier_id,
    l_quantity AS quantity, CAST(year(l_shipdate) AS INTEGER) AS source_batch_id,
    CAST(floor(l_extendedprice * (1 - l_discount) * 100.0 + 0.5) AS BIGINT) AS amount_cents
  FROM lineitem
),
events_clean AS (
  SELECT * EXCLUDE (rn), sale_id || '-' || line_no AS sales_event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY sale_id, line_no ORDER BY event_date DESC, event_type,
      product_id, supplier_id, quantity, source_batch_id, amount_cents) AS rn FROM made)
  WHERE rn = 1
)"""

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category,
    p_retailprice AS list_price, 2 AS source_batch_id
  FROM part WHERE p_size <> 50
)"""

CUSTOMERS = """
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
    n_name AS nation, r_name AS region
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""

LEDGER = f"""{EVENTS},
ledger AS (
  SELECT sale_id, count(*) AS n_events,
    CAST(coalesce(sum(amount_cents) FILTER (event_type = 'SALE'), 0) AS BIGINT) AS sale_cents,
    CAST(coalesce(sum(amount_cents) FILTER (event_type = 'ADJUSTMENT'), 0) AS BIGINT) AS adjustment_cents,
    count(*) FILTER (event_type = 'ADJUSTMENT') AS adjustment_rows,
    count(*) FILTER (event_type = 'CANCEL') AS cancel_rows
  FROM events_clean GROUP BY sale_id
),
net AS (
  SELECT *, CASE WHEN cancel_rows > 0 THEN CAST(0 AS BIGINT)
    ELSE sale_cents + adjustment_cents END AS net_cents FROM ledger
)"""

TOP = f"""{EVENTS}, {PRODUCTS},
top AS (
  SELECT product_id, count(*) AS sale_rows, sum(amount_cents) AS cents
  FROM events_clean WHERE event_type = 'SALE' GROUP BY product_id
  ORDER BY cents DESC, product_id LIMIT {{k}}
),
named AS (
  SELECT top.product_id, product_name, sale_rows, CAST(cents AS DOUBLE) / 100.0 AS sale_amount
  FROM top LEFT JOIN products ON top.product_id = products.product_id
)"""

PAST_SALES = f"""{EVENTS},
past AS (SELECT * FROM events_clean WHERE event_type = 'SALE'),
whole AS (SELECT CAST(sum(amount_cents) AS DOUBLE) AS cents FROM past)"""

# customers that are overdrawn go, one segment only meets inserts, the others are updated
MERGED = """
merged AS (
  SELECT c_custkey AS account_id, c_name AS name, c_acctbal AS balance, 'kept' AS action
  FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT c_custkey, c_name, c_acctbal + 1, 'updated'
  FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'
  UNION ALL
  SELECT c_custkey, c_name, c_acctbal, 'deleted' FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT -1 - s_suppkey * 3, s_name, s_acctbal, 'inserted' FROM supplier
)"""

# the third delivery: every tenth line ends after the name, every fifteenth of the others has a value too many
RESCUED_PARTS = """
SELECT p_partkey AS part_key, p_name AS name, 'shop' AS source_system, p_size % 3 + 1 AS source_batch_id,
  CASE WHEN p_size % 3 = 2 AND (p_partkey % 10 = 0 OR p_partkey % 7 = 0) THEN NULL ELSE p_size END AS size,
  CASE WHEN p_size % 3 = 1 THEN '{"brand":"' || p_brand || '"}'
    WHEN p_size % 3 = 0 THEN NULL
    WHEN p_partkey % 10 = 0 THEN '{"_corrupt_record":"' || p_partkey || ',' || p_name || '"}'
    WHEN p_partkey % 15 = 0 AND p_partkey % 7 = 0 THEN '{"size":"big ' || p_size || '","_corrupt_record":"'
      || p_partkey || ',' || p_name || ',big ' || p_size || ',more"}'
    WHEN p_partkey % 15 = 0 THEN '{"_corrupt_record":"' || p_partkey || ',' || p_name || ',' || p_size || ',more"}'
    WHEN p_partkey % 7 = 0 THEN '{"size":"big ' || p_size || '"}' END AS rescued_data
FROM part"""

# ---- one statement per query ----------------------------------------------------------

ORACLES: dict[str, str] = {
    "feed_profile": f"""WITH {FEED}
SELECT count(*) AS n_rows, count(order_id) AS rows_with_key, count(DISTINCT order_id) AS distinct_keys,
  count(*) FILTER (order_ts IS NULL) AS order_ts_nulls,
  count(*) FILTER (amount IS NULL) AS amount_nulls,
  count(*) FILTER (status IS NULL) AS status_nulls
FROM feed""",
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "bronze_lineage": """
SELECT o_orderkey, 'orders.parquet' AS source_file, 'shop' AS source_system, 1 AS source_batch_id,
  true AS has_time FROM orders""",
    "csv_round_trip": "SELECT * FROM part",
    "csv_hostile_texts": """
SELECT doc_id, text || CASE doc_id % 6 WHEN 0 THEN chr(10) || 'b' WHEN 1 THEN chr(13) WHEN 2 THEN chr(34) || ',' || chr(34)
  WHEN 3 THEN chr(92) WHEN 4 THEN chr(13) || chr(10) || ' ' ELSE '' END AS text
FROM documents WHERE text <> ''""",
    "ragged_feed_rescue": """
SELECT p_partkey AS part_key, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_size END AS size,
  CASE WHEN p_partkey % 10 = 0 THEN '{"_corrupt_record":"' || p_partkey || '"}'
    WHEN p_partkey % 15 = 0 THEN '{"_corrupt_record":"' || p_partkey || ',' || p_size || ',more"}' END AS rescued_data
FROM part""",
    "publish_round_trip": "SELECT * FROM customer",
    "typed_parse_rescue": f"""WITH {FEED}
SELECT order_id, order_time AS order_ts, amount_value AS amount,
  CASE
    WHEN order_ts = 'not a time' AND amount = 'n/a' THEN '{{"order_ts":"not a time","amount":"n/a"}}'
    WHEN order_ts = 'not a time' THEN '{{"order_ts":"not a time"}}'
    WHEN amount = 'n/a' THEN '{{"amount":"n/a"}}'
  END AS rescued_data
FROM feed""",
    "silver_orders": f"WITH {SILVER} SELECT * FROM silver",
    "quality_summary": f"""WITH {SILVER}
SELECT is_valid, count(*) AS n_rows, count(DISTINCT order_id) AS distinct_orders,
  {_EXACT_SUM.format("coalesce(amount_value, 0)")} AS observed_amount
FROM silver GROUP BY is_valid""",
    "invalid_orders": f"WITH {SILVER} SELECT * FROM silver WHERE NOT is_valid",
    "expectations_report": f"""WITH {FEED}
SELECT 'has_order_id' AS rule, 'fail' AS action, count(*) FILTER (order_id IS NULL) AS failed_rows,
  count(*) AS checked_rows FROM feed
UNION ALL SELECT 'readable_amount', 'drop', count(*) FILTER (amount_value IS NULL), count(*) FROM feed
UNION ALL SELECT 'readable_time', 'drop', count(*) FILTER (order_time IS NULL), count(*) FROM feed
UNION ALL SELECT 'known_status', 'warn',
  count(*) FILTER (status_clean IS NULL OR status_clean = 'returned'), count(*) FROM feed
UNION ALL SELECT 'large_order', 'warn',
  count(*) FILTER (amount_value IS NULL OR amount_value >= 400000), count(*) FROM feed""",
    "expectations_drop": f"""WITH {FEED}
SELECT order_id, order_time, amount_value, status_clean FROM feed
WHERE amount_value IS NOT NULL AND order_time IS NOT NULL""",
    "gold_daily_revenue": f"WITH {GOLD} SELECT * FROM gold",
    "daily_channel_rank": f"""WITH {GOLD}
SELECT g.*, CAST(1 + (SELECT count(DISTINCT b.revenue) FROM gold b
    WHERE b.order_date = g.order_date AND b.revenue > g.revenue) AS INTEGER) AS rank_in_day
FROM gold g""",
    "consumer_view": f"WITH {GOLD} SELECT * FROM gold WHERE revenue > 100000",
    "status_by_country": f"""WITH {SILVER}
SELECT country, status_clean AS status, count(*) AS n_rows,
  {_EXACT_SUM.format("coalesce(amount_value, 0)")} AS observed_amount
FROM silver GROUP BY country, status_clean""",
    "layer_checks": f"""WITH {GOLD}
SELECT 'bronze_rows' AS "check", CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed FROM feed
UNION ALL
SELECT 'silver_orders', CAST(count(DISTINCT order_id) AS DOUBLE), count(DISTINCT order_id) > 0 FROM silver
UNION ALL
SELECT 'gold_revenue', CAST(sum(CAST(revenue AS DECIMAL(18, 2))) AS DOUBLE), sum(revenue) > 0 FROM gold""",
    "medallion_gold": f"WITH {GOLD} SELECT * FROM gold",
    "silver_sales_events": f"WITH {EVENTS} SELECT * FROM events_clean",
    "dim_current": f"WITH {PRODUCTS} SELECT * FROM products",
    "dim_customer": f"WITH {CUSTOMERS} SELECT * FROM customers",
    "obt_sales": f"""WITH {EVENTS}, {PRODUCTS}, {CUSTOMERS}
SELECT e.*, o_custkey AS customer_id, customer_name, segment, nation, region,
  product_name, brand, category, list_price
FROM events_clean e
LEFT JOIN orders ON sale_id = o_orderkey
LEFT JOIN customers c ON o_custkey = c.customer_id
LEFT JOIN products p ON e.product_id = p.product_id""",
    "daily_sales": f"""WITH {EVENTS}
SELECT event_date,
  count(*) FILTER (event_type = 'SALE') AS sale_rows,
  count(*) FILTER (event_type = 'ADJUSTMENT') AS adjustment_rows,
  count(*) FILTER (event_type = 'CANCEL') AS cancel_rows,
  CAST(coalesce(sum(quantity) FILTER (event_type = 'SALE'), 0) AS BIGINT) AS sold_quantity,
  CAST(coalesce(sum(amount_cents) FILTER (event_type = 'SALE'), 0) AS DOUBLE) / 100.0 AS sale_amount,
  CAST(coalesce(sum(amount_cents) FILTER (event_type = 'ADJUSTMENT'), 0) AS DOUBLE) / 100.0
    AS adjustment_amount
FROM events_clean GROUP BY event_date""",
    "batch_event_counts": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS source_batch_id,
  count(*) FILTER (l_returnflag = 'N') AS sale_rows,
  count(*) FILTER (l_returnflag = 'A') AS adjustment_rows,
  count(*) FILTER (l_returnflag = 'R') AS cancel_rows
FROM lineitem GROUP BY 1""",
    "sales_net_ledger": f"WITH {LEDGER} SELECT * FROM net",
    "correction_latency": f"""WITH {EVENTS},
firsts AS (
  SELECT sale_id, min(event_date) AS first_sale FROM events_clean WHERE event_type = 'SALE' GROUP BY sale_id
),
delays AS (
  SELECT f.sale_id, CAST(min(e.event_date) - f.first_sale AS INTEGER) AS days
  FROM firsts f LEFT JOIN events_clean e
    ON e.sale_id = f.sale_id AND e.event_type <> 'SALE' AND e.event_date >= f.first_sale
  GROUP BY f.sale_id, f.first_sale
)
SELECT CASE WHEN days IS NULL THEN 'not corrected' WHEN days = 0 THEN 'same day' WHEN days <= 7 THEN '1-7 days'
    WHEN days <= 30 THEN '8-30 days' WHEN days <= 90 THEN '31-90 days' ELSE 'over 90 days' END AS delay_group,
  count(*) AS n_sales, CAST(coalesce(sum(days), 0) AS BIGINT) AS total_days
FROM delays GROUP BY 1""",
    "weekday_profile": """WITH days AS (
  SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1
)
SELECT CAST(isodow(day) AS BIGINT) AS weekday, count(*) AS n_days, CAST(sum(n) AS BIGINT) AS n_rows,
  min(n) AS least_rows, max(n) AS most_rows, CAST(sum(n) AS DOUBLE) / count(*) AS mean_rows
FROM days GROUP BY 1""",
    "product_mix": f"""WITH {PAST_SALES}, {PRODUCTS}
SELECT m.product_id, CAST(m.cents AS BIGINT) AS amount_cents, CAST(m.cents AS DOUBLE) / whole.cents AS share,
  product_name, brand
FROM (SELECT product_id, sum(amount_cents) AS cents FROM past GROUP BY product_id) m
CROSS JOIN whole LEFT JOIN products ON m.product_id = products.product_id""",
    "territory_mix": f"""WITH {PAST_SALES}
SELECT region, nation, CAST(m.cents AS BIGINT) AS amount_cents, CAST(m.cents AS DOUBLE) / whole.cents AS share
FROM (
  SELECT r_name AS region, n_name AS nation, sum(amount_cents) AS cents
  FROM past LEFT JOIN supplier ON supplier_id = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
  GROUP BY r_name, n_name) m CROSS JOIN whole""",
    "top_products": f"WITH {TOP.format(k=10)} SELECT * FROM named",
    "kpi_summary": f"""WITH {LEDGER}, {TOP.format(k=1).removeprefix(EVENTS + ",")}
SELECT 'sales' AS metric, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS label FROM net
UNION ALL SELECT 'gross_sales', CAST(sum(sale_cents) AS DOUBLE) / 100.0, NULL FROM net
UNION ALL SELECT 'net_revenue', CAST(sum(net_cents) AS DOUBLE) / 100.0, NULL FROM net
UNION ALL SELECT 'correction_rate',
  CAST(count(*) FILTER (adjustment_rows > 0) AS DOUBLE) / count(*), NULL FROM net
UNION ALL SELECT 'cancel_rate', CAST(count(*) FILTER (cancel_rows > 0) AS DOUBLE) / count(*), NULL FROM net
UNION ALL SELECT 'best_product', sale_amount, product_name FROM named""",
    "layer_reconcile": f"""WITH {EVENTS}
SELECT m.source_batch_id, m.n AS made_rows, m.n AS bronze_rows,
  coalesce(c.n, 0) AS silver_rows, coalesce(c.n, 0) AS gold_rows
FROM (SELECT source_batch_id, count(*) AS n FROM made GROUP BY 1) m
LEFT JOIN (SELECT source_batch_id, count(*) AS n FROM events_clean GROUP BY 1) c
  ON m.source_batch_id = c.source_batch_id""",
    "sales_pipeline_gold": f"""WITH {EVENTS}
SELECT source_batch_id, event_date,
  count(*) FILTER (event_type = 'SALE') AS sale_rows,
  count(*) FILTER (event_type = 'ADJUSTMENT') AS adjustment_rows,
  count(*) FILTER (event_type = 'CANCEL') AS cancel_rows,
  CAST(coalesce(sum(quantity) FILTER (event_type = 'SALE'), 0) AS BIGINT) AS sold_quantity,
  CAST(coalesce(sum(amount_cents) FILTER (event_type = 'SALE'), 0) AS DOUBLE) / 100.0 AS sale_amount,
  CAST(coalesce(sum(amount_cents) FILTER (event_type = 'ADJUSTMENT'), 0) AS DOUBLE) / 100.0
    AS adjustment_amount
FROM events_clean GROUP BY source_batch_id, event_date""",
    "sales_pipeline_wide": f"""WITH {EVENTS}, {PRODUCTS}, {CUSTOMERS}
SELECT e.*, o_custkey AS customer_id, customer_name, segment, nation, region,
  product_name, brand, category, list_price
FROM events_clean e
LEFT JOIN orders ON sale_id = o_orderkey
LEFT JOIN customers c ON o_custkey = c.customer_id
LEFT JOIN products p ON e.product_id = p.product_id""",
    "sales_pipeline_reconcile": f"""WITH {EVENTS}
SELECT m.source_batch_id, m.n AS made_rows, m.n AS bronze_rows,
  coalesce(c.n, 0) AS silver_rows, coalesce(c.n, 0) AS wide_rows, coalesce(c.n, 0) AS daily_rows
FROM (SELECT source_batch_id, count(*) AS n FROM made GROUP BY 1) m
LEFT JOIN (SELECT source_batch_id, count(*) AS n FROM events_clean GROUP BY 1) c
  ON m.source_batch_id = c.source_batch_id""",
    "merge_apply": f"WITH {MERGED} SELECT account_id, name, balance FROM merged WHERE action <> 'deleted'",
    "merge_metrics": f"""WITH {MERGED}
SELECT a.action, count(merged.action) AS n_rows
FROM (VALUES ('kept'), ('updated'), ('deleted'), ('inserted')) a(action)
LEFT JOIN merged ON merged.action = a.action GROUP BY a.action""",
    # the overdrawn come back only in the segment that is inserted after the deletion
    "merge_stream": """
SELECT c_custkey AS account_id, c_name AS name,
  CASE WHEN c_acctbal < 0 THEN c_acctbal + 5 WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1
    ELSE c_acctbal END AS balance
FROM customer WHERE c_acctbal >= 0 OR c_mktsegment = 'AUTOMOBILE'
UNION ALL
SELECT -1 - s_suppkey, s_name, s_acctbal + 5 FROM supplier""",
    "merge_stream_metrics": """WITH hits AS (
  SELECT 1 AS delivery, 'updated' AS action FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT 2, 'deleted' FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 3, 'inserted' FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'AUTOMOBILE'
  UNION ALL SELECT 3, 'inserted' FROM supplier
  UNION ALL SELECT 4, 'updated' FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'AUTOMOBILE'
  UNION ALL SELECT 4, 'updated' FROM supplier
)
SELECT d.delivery, a.action, count(hits.action) AS n_rows
FROM (VALUES (1), (2), (3), (4)) d(delivery)
CROSS JOIN (VALUES ('updated'), ('deleted'), ('inserted')) a(action)
LEFT JOIN hits ON hits.delivery = d.delivery AND hits.action = a.action
GROUP BY d.delivery, a.action""",
    "stream_ledger": f"WITH {LEDGER} SELECT * FROM net",
    "stream_ingest": """
SELECT event_id, ts, user_id, event_type, value, props, 'shop' AS source_system,
  CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS source_batch_id FROM events""",
    "stream_dedup": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "stream_expectations": """
SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type <> 'error'""",
    "stream_expectation_counts": """
SELECT 'has_id' AS rule, 'fail' AS action, count(*) FILTER (event_id IS NULL) AS failed_rows,
  count(*) AS checked_rows FROM events
UNION ALL SELECT 'no_error', 'drop', count(*) FILTER (event_type = 'error'), count(*) FROM events
UNION ALL SELECT 'worth_something', 'warn', count(*) FILTER (value < 1), count(*) FROM events""",
    "idempotent_load": """
SELECT event_id, ts, user_id, event_type, value, props, CASE WHEN event_type = 'signup' THEN 2 ELSE 1 END AS source_batch_id
FROM events""",
    "load_rescue": RESCUED_PARTS,
    "stream_rescue": RESCUED_PARTS,
    "table_file_stats": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows, true AS has_bytes FROM {t}"
        for t in ALL_TABLES
    ),
    "manifest_reconcile": """
SELECT url AS path,
  CASE WHEN split_part(url, '/', 4) = 'es' THEN 'missing' WHEN split_part(url, '/', 4) = 'de' THEN 'stale'
    WHEN contains(url, '#') THEN 'changed' ELSE 'ok' END AS state
FROM pages GROUP BY url""",
    "path_prefix_counts": """
SELECT split_part(url, '/', 4) AS prefix, count(*) AS n_files FROM pages GROUP BY 1""",
    "safe_identifiers": """WITH texts AS (
  SELECT url AS text FROM pages
  UNION ALL SELECT c_name FROM customer
  UNION ALL SELECT regexp_replace(c_name, '[A-Za-z0-9]', '-', 'g') FROM customer
  UNION ALL SELECT o_orderpriority FROM orders
),
plain AS (
  SELECT text, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_')
    AS name FROM texts
),
named AS (SELECT text, CASE WHEN name = '' THEN 'student' ELSE name END AS name FROM plain)
SELECT text, count(*) AS n_rows,
  left(CASE WHEN left(name, 1) BETWEEN '0' AND '9' THEN 'u_' || name ELSE name END, 40) AS identifier
FROM named GROUP BY text, name""",
}

# the incremental flow ends where the whole one does
ORACLES["sales_pipeline_incremental"] = ORACLES["sales_pipeline_gold"]
ORACLES["sales_incremental_wide"] = ORACLES["sales_pipeline_wide"]

ORACLES["merge_bucketed"] = ORACLES["merge_apply"]
ORACLES["ordered_gold"] = f"""WITH {GOLD}
SELECT *, row_number() OVER (ORDER BY order_date, revenue DESC, channel) AS position FROM gold"""
ORACLES["stream_quarantine"] = """
SELECT event_id, event_type, value, CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS source_batch_id,
  concat_ws(',', CASE WHEN event_type = 'error' THEN 'no_error' END, CASE WHEN coalesce(value < 5, true) THEN 'not_cheap' END) AS broken
FROM events"""
ORACLES["manifest_files"] = """
SELECT (page_id % 10) || '/' || page_id || '.html' AS path,
  CASE WHEN page_id % 7 = 0 THEN 'missing' WHEN page_id % 11 = 0 THEN 'stale' WHEN page_id % 13 = 0 THEN 'changed' ELSE 'ok' END AS state
FROM pages WHERE NOT (page_id % 7 = 0 AND page_id % 11 = 0)"""
ORACLES["merge_stream_parts"] = ORACLES["merge_stream"]
