"""DuckDB oracle SQL for every registered query (see ``__spark_entry__``).

The driver pre-registers its tables as views (customer, nation, part, orders,
lineitem, events, ...).  ``MODEL`` defines the model tables the engine's
adapters build (``shopflow.sources.driver_tables``) as CTEs named ``m_*``;
each oracle statement is written against them, independently of the Spark
code paths.
"""

from __future__ import annotations

MODEL = """
m_users AS (
  SELECT 'u' || CAST(c.c_custkey AS VARCHAR) AS user_id, c.c_name AS name,
         'user' || CAST(c.c_custkey AS VARCHAR) || '@shop.example' AS email,
         CAST(DATE '2020-01-01' + CAST(c.c_custkey % 1461 AS INTEGER) AS TIMESTAMP) AS signup_date,
         CASE c.c_custkey % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet' END AS device,
         CASE WHEN c.c_acctbal >= 6000 THEN 'Gold' WHEN c.c_acctbal >= 2000 THEN 'Silver'
              WHEN c.c_acctbal >= 0 THEN 'Bronze' END AS loyalty_tier,
         n.n_name AS location
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
m_products AS (
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         CASE p_type WHEN 'ECONOMY' THEN 'Home' WHEN 'SMALL' THEN 'Beauty' WHEN 'MEDIUM' THEN 'Clothing'
                     WHEN 'LARGE' THEN 'Electronics' WHEN 'STANDARD' THEN 'Other' END AS category,
         CAST(p_size AS INTEGER) AS inventory, CAST(p_size AS DOUBLE) / 50 AS popularity_score
  FROM part),
m_orders AS (
  SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS order_id, 'u' || CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(o_orderdate AS TIMESTAMP) AS created_at, CAST(o_totalprice AS DECIMAL(10,2)) AS total,
         CASE WHEN o_orderstatus = 'F' THEN 'completed' END AS status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'apple_pay'
              WHEN '3-MEDIUM' THEN 'google_pay' WHEN '4-NOT SPECIFIED' THEN 'paypal' END AS payment_method,
         o_orderkey AS _pos
  FROM orders),
m_cart AS (
  SELECT CAST(l_shipdate AS TIMESTAMP) + to_seconds(CAST(l_linenumber AS BIGINT)) AS "timestamp",
         'u' || CAST(l_suppkey AS VARCHAR) AS user_id, 's' || CAST(l_orderkey AS VARCHAR) AS session_id,
         'add_to_cart' AS event_type,
         CASE l_linenumber % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet' END AS device,
         'p' || CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_linenumber AS INTEGER) AS cart_total_items,
         l_orderkey AS _o, l_linenumber AS _l, l_partkey AS _p, l_suppkey AS _s, l_extendedprice AS _x,
         l_returnflag AS _rf
  FROM lineitem),
m_events AS (
  SELECT CAST(ts AS TIMESTAMP) AS "timestamp", 'u' || CAST(user_id AS VARCHAR) AS user_id,
         's' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'product_search'
              WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'checkout_start'
              WHEN 'purchase' THEN 'order_complete' END AS event_type,
         CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet' END AS device,
         CASE WHEN event_type = 'view'
              THEN (CASE WHEN k % 2 = 0 THEN '/Product/' ELSE '/home/' END) || CAST(k AS VARCHAR) END AS url_path,
         CASE WHEN event_type = 'signup' THEN 'q' || CAST(k AS VARCHAR) END AS query,
         CASE WHEN event_type = 'click' THEN 'p' || CAST(k AS VARCHAR) END AS product_id,
         CASE WHEN event_type = 'click' THEN 1 + k % 5 END AS quantity,
         CASE WHEN event_type = 'error' THEN "value" END AS cart_value,
         CASE WHEN event_type = 'purchase' THEN 'o' || CAST(event_id AS VARCHAR) END AS order_id,
         event_id AS _pos, k
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))
"""


def with_model(body: str) -> str:
    """Prefix the model CTEs; ``body`` may start with more CTEs (``q_*``)."""
    sep = ",\n" if body.lstrip().lower().startswith("q_") else "\n"
    return "WITH " + MODEL.strip() + sep + body.strip()


def _rate(num: str, den: str) -> str:
    # round half-up of 100*num/den to 2 places, in exact integer arithmetic
    return (f"CAST((20000 * {num} + {den}) // (2 * NULLIF({den}, 0)) AS DOUBLE) / 100")


FUNNEL_COUNTS_SQL = """
  SELECT CAST("timestamp" AS DATE) AS report_date,
         count(*) FILTER (WHERE event_type = 'product_search') AS searches,
         count(*) FILTER (WHERE event_type = 'page_view' AND lower(url_path) LIKE '%product%') AS product_views,
         count(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_cart_events,
         count(*) FILTER (WHERE event_type = 'checkout_start') AS checkout_starts,
         count(*) FILTER (WHERE event_type = 'order_complete') AS purchases
  FROM m_events
  WHERE event_type IN ('product_search', 'page_view', 'add_to_cart', 'checkout_start', 'order_complete')
  GROUP BY 1
"""

FUNNEL_SELECT = f"""
SELECT report_date, searches, product_views, add_to_cart_events, checkout_starts, purchases,
       {_rate('add_to_cart_events', 'product_views')} AS view_to_cart_rate,
       {_rate('checkout_starts', 'add_to_cart_events')} AS cart_to_checkout_rate,
       {_rate('purchases', 'checkout_starts')} AS checkout_to_purchase_rate,
       {_rate('purchases', 'product_views')} AS view_to_purchase_rate
FROM q_counts
"""


# Raw string exports (same derivation as ``driver_tables.raw_*``), then the
# cleaning rules applied in SQL: trim + lower + enum lookup, coercing parses.
RAW_USERS_SQL = """
q_users_raw AS (
  SELECT 'u' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name,
         CASE WHEN c_acctbal >= 0 AND c_acctbal < 100 THEN NULL
              ELSE ' User' || CAST(c_custkey AS VARCHAR) || '@Shop.Example ' END AS email,
         CASE WHEN c_custkey % 5 = 0 THEN 'not a date'
              ELSE strftime(DATE '2020-01-01' + CAST(c_custkey % 1461 AS INTEGER), '%Y-%m-%d %H:%M:%S') END
           AS signup_date,
         CASE c_custkey % 4 WHEN 0 THEN ' Desktop ' WHEN 1 THEN 'mobile' WHEN 2 THEN 'TABLET'
              ELSE 'watch' END AS device,
         CASE WHEN c_acctbal >= 6000 THEN ' GOLD ' WHEN c_acctbal >= 2000 THEN 'silver'
              WHEN c_acctbal >= 0 THEN 'Bronze' ELSE 'platinum' END AS loyalty_tier,
         n_name AS location
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
q_users_typed AS (
  SELECT user_id, name, lower(trim(email)) AS email, TRY_CAST(trim(signup_date) AS TIMESTAMP) AS signup_date,
         CASE lower(trim(device)) WHEN 'desktop' THEN 'desktop' WHEN 'mobile' THEN 'mobile'
              WHEN 'tablet' THEN 'tablet' END AS device,
         CASE lower(trim(loyalty_tier)) WHEN 'bronze' THEN 'Bronze' WHEN 'silver' THEN 'Silver'
              WHEN 'gold' THEN 'Gold' END AS loyalty_tier,
         location
  FROM q_users_raw WHERE user_id IS NOT NULL)"""

RAW_PRODUCTS_SQL = """
q_products_raw AS (
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name,
         CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_retailprice END AS price_num,
         CASE p_type WHEN 'ECONOMY' THEN ' HOME ' WHEN 'SMALL' THEN 'beauty' WHEN 'MEDIUM' THEN 'Clothing'
              WHEN 'LARGE' THEN 'ELECTRONICS' WHEN 'STANDARD' THEN 'other' ELSE 'promo' END AS category,
         p_size, p_partkey
  FROM part),
q_products_typed AS (
  SELECT product_id, name, CAST(price_num AS DECIMAL(10,2)) AS price,
         CASE lower(trim(category)) WHEN 'beauty' THEN 'Beauty' WHEN 'clothing' THEN 'Clothing'
              WHEN 'electronics' THEN 'Electronics' WHEN 'home' THEN 'Home' WHEN 'other' THEN 'Other' END
           AS category,
         CAST(p_size AS INTEGER) AS inventory,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) + 0.5 END AS popularity_score
  FROM q_products_raw)"""

RAW_ORDERS_SQL = """
q_orders_raw AS (
  SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS order_id, 'u' || CAST(o_custkey AS VARCHAR) AS user_id,
         CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
              WHEN o_orderkey % 3 = 0 THEN NULL
              ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 10 HOUR + INTERVAL 30 MINUTE
         END AS created_at,
         o_totalprice,
         CASE o_orderstatus WHEN 'F' THEN ' Completed' WHEN 'O' THEN 'cancelled' END AS status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'CREDIT_CARD' WHEN '2-HIGH' THEN 'apple_pay'
              WHEN '3-MEDIUM' THEN ' google_pay ' WHEN '4-NOT SPECIFIED' THEN 'PayPal' ELSE 'cash' END
           AS payment_method
  FROM orders),
q_orders_typed AS (
  SELECT order_id, user_id, created_at, CAST(o_totalprice AS DECIMAL(10,2)) AS total,
         CASE lower(trim(status)) WHEN 'completed' THEN 'completed' END AS status,
         CASE lower(trim(payment_method)) WHEN 'credit_card' THEN 'credit_card' WHEN 'apple_pay' THEN 'apple_pay'
              WHEN 'google_pay' THEN 'google_pay' WHEN 'paypal' THEN 'paypal' END AS payment_method
  FROM q_orders_raw)"""


# Expected outcome of every raw event line (``driver_tables.raw_event_lines``):
# the first failing check, in the validator's order.
RAW_EVENTS_SQL = """
q_checked AS (
  SELECT e.*, r."value",
    CASE WHEN k = 7 THEN 'Missing required common field: user_id'
         WHEN k = 3 THEN 'Missing required common field: device'
         WHEN r.event_type = 'view' AND k = 42 THEN 'Unknown event_type: Page_View'
         WHEN e.event_type = 'page_view' AND k % 17 = 0 THEN 'Cannot cast field ''http_status'' to int: 2xx'
         WHEN e.event_type = 'add_to_cart' AND k % 11 = 0 THEN 'Required int field is null: quantity'
         WHEN e.event_type = 'checkout_start' AND k % 19 = 0 THEN 'Cannot cast field ''cart_value'' to float: abc'
         WHEN k = 13 THEN 'Cannot cast field ''timestamp'' to datetime: bad'
    END AS reason
  FROM m_events e JOIN events r ON r.event_id = e._pos)"""


# Lines of the four further event types (``driver_tables.raw_more_event_lines``).
MORE_EVENTS_SQL = """
WITH m AS (
  SELECT *, CASE WHEN t = 0 AND n % 7 = 0 THEN 'Required int field is null: quantity'
                 WHEN t = 1 AND n % 5 = 0 THEN 'Required string field is null: product_id'
                 WHEN t = 2 AND n % 6 = 0 THEN 'Cannot cast field ''success'' to bool: maybe'
                 WHEN t = 3 AND n % 8 = 0 THEN 'Cannot cast field ''rating'' to int: x' END AS reason
  FROM (SELECT o_orderkey % 4 AS t, o_orderkey // 4 AS n, CAST(o_orderdate AS TIMESTAMP) AS "timestamp",
               'u' || o_custkey AS user_id, 's' || o_orderkey AS session_id,
               CASE o_orderkey % 4 WHEN 0 THEN 'remove_from_cart' WHEN 1 THEN 'wishlist_add' WHEN 2 THEN 'payment_attempt'
                    ELSE 'review_submit' END AS event_type
        FROM orders))"""


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["sales_daily"] = with_model("""
SELECT CAST(created_at AS DATE) AS report_date, count(*) AS order_count,
       CAST(sum(total) AS DOUBLE) AS total_revenue, count(DISTINCT user_id) AS purchasing_users
FROM m_orders WHERE status = 'completed' GROUP BY 1""")
    q["top_products"] = with_model("""
SELECT p.product_id, p.name AS product_name, coalesce(p.category, 'Unknown') AS category,
       CAST(sum(a.quantity) AS BIGINT) AS total_quantity, count(*) AS add_to_cart_count,
       CAST(sum(a.quantity * coalesce(p.price, 0)) AS DOUBLE) AS estimated_revenue
FROM m_cart a JOIN m_products p ON a.product_id = p.product_id
GROUP BY p.product_id, p.name, p.category""")
    q["top_products_top10"] = with_model("""
SELECT p.product_id, p.name AS product_name, p.category,
       CAST(sum(a.quantity) AS BIGINT) AS total_quantity, count(*) AS add_to_cart_count,
       CAST(round(sum(a.quantity * p.price), 2) AS DOUBLE) AS estimated_revenue
FROM m_cart a JOIN m_products p ON a.product_id = p.product_id
GROUP BY p.product_id, p.name, p.category
ORDER BY estimated_revenue DESC NULLS LAST, p.product_id LIMIT 10""")
    q["behavior_funnel_daily"] = with_model(f"q_counts AS ({FUNNEL_COUNTS_SQL})\n{FUNNEL_SELECT}")
    q["loyalty_segments"] = with_model("""
SELECT location, loyalty_tier, count(*) AS user_count FROM m_users GROUP BY 1, 2""")
    q["device_usage"] = with_model("""
SELECT device,
       count(*) FILTER (WHERE event_type = 'page_view') AS page_views,
       count(*) FILTER (WHERE event_type = 'product_search') AS searches,
       count(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_carts,
       count(*) FILTER (WHERE event_type = 'order_complete') AS completed_orders
FROM m_events WHERE event_type IN ('page_view', 'product_search', 'add_to_cart', 'order_complete')
GROUP BY device""")
    cart_cols = ('"timestamp", user_id, session_id, event_type, device, product_id, quantity, '
                 'cart_total_items')
    latest = with_model(f"""
SELECT {cart_cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY session_id, cart_total_items
                               ORDER BY _o DESC, _l DESC, _p DESC, _s DESC, _x DESC) AS rn
  FROM m_cart) WHERE rn = 1""")
    q["latest_by_key"] = latest
    q["latest_by_key_window"] = latest
    q["upsert"] = with_model("""
q_src AS (
  SELECT product_id, price, inventory FROM (
    SELECT 'p' || CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
           CAST(l_quantity AS INTEGER) AS inventory,
           row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC,
                              l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
    FROM lineitem) WHERE rn = 1)
SELECT coalesce(t.product_id, s.product_id) AS product_id, t.name,
       CASE WHEN s.product_id IS NOT NULL THEN s.price ELSE t.price END AS price,
       t.category,
       CASE WHEN s.product_id IS NOT NULL THEN s.inventory ELSE t.inventory END AS inventory,
       t.popularity_score
FROM m_products t FULL OUTER JOIN q_src s ON t.product_id = s.product_id""")
    q["insert_if_absent"] = with_model(f"""
q_batch AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY "timestamp", session_id
                                 ORDER BY _o, _l, _p, _s, _x) AS rn
    FROM m_cart) WHERE rn = 1),
q_stored AS (SELECT DISTINCT "timestamp", session_id FROM m_cart WHERE _rf = 'R')
SELECT {cart_cols} FROM q_batch b
WHERE NOT EXISTS (SELECT 1 FROM q_stored s WHERE s."timestamp" = b."timestamp"
                                            AND s.session_id = b.session_id)""")
    q["merge_additive"] = with_model(f"""q_counts AS ({FUNNEL_COUNTS_SQL})
{FUNNEL_SELECT}
WHERE searches + product_views + add_to_cart_events + checkout_starts + purchases > 0""")
    q["distinct_users_incremental"] = q["sales_daily"]
    q["full_row_distinct"] = with_model("""
SELECT DISTINCT order_id, user_id, created_at, total, status, payment_method FROM m_orders""")
    q["clean_users"] = with_model(f"""{RAW_USERS_SQL}
SELECT DISTINCT user_id, name, email, signup_date, device, loyalty_tier, location
FROM q_users_typed WHERE email IS NOT NULL AND loyalty_tier IS NOT NULL""")
    q["clean_products"] = with_model(f"""{RAW_PRODUCTS_SQL}
SELECT DISTINCT * FROM q_products_typed WHERE category IS NOT NULL""")
    q["clean_orders"] = with_model(f"""{RAW_ORDERS_SQL}
SELECT DISTINCT * FROM q_orders_typed
WHERE created_at IS NOT NULL AND status IS NOT NULL AND payment_method IS NOT NULL""")
    q["scan_csv_clean_orders"] = q["clean_orders"]
    q["clean_rejects"] = with_model(f"""{RAW_USERS_SQL}, {RAW_PRODUCTS_SQL.strip()}, {RAW_ORDERS_SQL.strip()}
SELECT 'users' AS table_name, CASE WHEN email IS NULL THEN 'invalid or missing email'
       ELSE 'invalid or missing loyalty_tier' END AS reason, count(*) AS n
FROM q_users_typed WHERE email IS NULL OR loyalty_tier IS NULL GROUP BY 2
UNION ALL
SELECT 'products', 'invalid or missing category', count(*) FROM q_products_typed WHERE category IS NULL
UNION ALL
SELECT 'orders', CASE WHEN created_at IS NULL THEN 'invalid or missing created_at'
                      WHEN status IS NULL THEN 'invalid or missing status'
                      ELSE 'invalid or missing payment_method' END, count(*)
FROM q_orders_typed WHERE created_at IS NULL OR status IS NULL OR payment_method IS NULL GROUP BY 2""")
    q["referential_check"] = with_model(f"""{RAW_USERS_SQL}, {RAW_ORDERS_SQL.strip()}
SELECT DISTINCT o.order_id, o.user_id FROM q_orders_typed o
WHERE o.created_at IS NOT NULL AND o.status IS NOT NULL AND o.payment_method IS NOT NULL
  AND o.user_id IS NOT NULL
  AND o.user_id NOT IN (SELECT user_id FROM q_users_typed
                        WHERE email IS NOT NULL AND loyalty_tier IS NOT NULL AND user_id IS NOT NULL)""")
    q["validate_events"] = with_model(f"""{RAW_EVENTS_SQL}
SELECT "timestamp", user_id, session_id, event_type, device,
       CASE WHEN event_type = 'page_view' THEN url_path END AS url_path,
       CASE WHEN event_type = 'page_view' THEN k END AS duration_sec,
       CASE WHEN event_type = 'page_view' THEN 200 END AS http_status,
       CASE WHEN event_type = 'product_search' THEN 'q' || CAST(k AS VARCHAR) END AS query,
       CASE WHEN event_type = 'product_search' THEN CASE WHEN k % 4 = 0 THEN 0 ELSE k END END AS results_count,
       CASE WHEN event_type = 'product_search' AND k % 5 = 0 THEN 3 END AS clicked_position,
       CASE WHEN event_type = 'checkout_start' THEN "value" + 0.0 END AS cart_value,
       CASE WHEN event_type = 'add_to_cart' THEN 'p' || CAST(k AS VARCHAR) END AS product_id,
       CASE WHEN event_type = 'add_to_cart' THEN 1 + k % 5 END AS quantity,
       CASE WHEN event_type = 'add_to_cart' THEN CASE WHEN k % 9 = 0 THEN 1 ELSE k END END AS cart_total_items,
       CAST(NULL AS VARCHAR) AS wishlist_name,
       CASE WHEN event_type = 'checkout_start' AND k % 2 = 0 THEN 'express' END AS shipping_method,
       CAST(NULL AS VARCHAR) AS payment_type, CAST(NULL AS BOOLEAN) AS success,
       CAST(NULL AS VARCHAR) AS error_code,
       CASE WHEN event_type = 'order_complete' THEN order_id END AS order_id,
       CASE WHEN event_type = 'order_complete' THEN 'fast' END AS fulfillment_speed,
       CAST(NULL AS INTEGER) AS rating, CAST(NULL AS INTEGER) AS text_length
FROM q_checked WHERE reason IS NULL""")
    q["validate_events_rejects"] = with_model(f"""{RAW_EVENTS_SQL}
SELECT reason, count(*) AS n FROM q_checked WHERE reason IS NOT NULL GROUP BY reason""")
    q["route_by_type_counts"] = with_model(f"""{RAW_EVENTS_SQL}
SELECT event_type, 'sessions_' || strftime("timestamp", '%Y%m%d') || '_events.json' AS source_file,
       count(*) AS records_inserted
FROM (SELECT DISTINCT event_type, "timestamp", session_id FROM q_checked WHERE reason IS NULL)
GROUP BY 1, 2""")
    q["envelope_roundtrip"] = with_model("""
SELECT order_id, user_id, created_at, CAST(total AS DOUBLE) AS total, status, payment_method FROM m_orders""")
    q["publish_json_orders"] = with_model("""
SELECT order_id AS "key", 3 AS schema_id,
       '{"order_id":' || to_json(order_id) || ',"user_id":' || to_json(user_id)
       || ',"created_at":' || to_json(strftime(created_at, '%Y-%m-%dT%H:%M:%S'))
       || ',"total":' || CAST(CAST(total AS DOUBLE) AS VARCHAR)
       || ',"status":' || coalesce(to_json(status), 'null')
       || ',"payment_method":' || coalesce(to_json(payment_method), 'null') || '}' AS payload
FROM m_orders""")
    q["scan_since_numeric_suffix"] = with_model("""
SELECT order_id, user_id, created_at, total, status, payment_method, _pos AS id_num FROM m_orders
WHERE _pos > (SELECT floor(avg(_pos)) FROM m_orders)""")
    q["scan_clustered"] = q["scan_since_numeric_suffix"]
    q["scan_since_position"] = with_model("""
SELECT * EXCLUDE (k) FROM m_events
WHERE _pos > (SELECT max(_pos) FROM m_events WHERE "timestamp" < TIMESTAMP '2024-01-15')""")
    q["land_orders_latest"] = with_model("""
SELECT order_id, user_id, created_at, CAST(total AS DOUBLE) AS total, status,
       CASE WHEN status = 'completed' THEN upper(payment_method) ELSE payment_method END AS payment_method
FROM m_orders""")
    q["json_field_extract"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""
    q["iso_text"] = with_model("""
SELECT _pos AS id, CASE WHEN microsecond("timestamp") % 1000000 = 0
                        THEN strftime("timestamp", '%Y-%m-%dT%H:%M:%S')
                        ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') END AS iso FROM m_events
UNION ALL
SELECT -_pos AS id, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS iso FROM m_orders""")
    q["parse_timestamp"] = with_model(f"""{RAW_ORDERS_SQL}
SELECT order_id, created_at FROM q_orders_typed""")
    q["cast_rules"] = """
SELECT event_id,
       CASE WHEN k % 4 = 0 OR k % 4 = 2 THEN k END AS as_int,
       "value" AS as_float,
       CASE k % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false END AS as_bool,
       CASE k % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN true ELSE false END AS is_blank
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""
    q["anti_join_ledger"] = """
SELECT DISTINCT 'sessions_' || strftime(ts, '%Y%m%d') || '_events.json' AS file_name
FROM events WHERE ts >= TIMESTAMP '2024-01-15'"""
    q["file_stream_new_only"] = with_model(f"""{RAW_EVENTS_SQL}
SELECT event_type, count(*) AS stored
FROM (SELECT DISTINCT event_type, "timestamp", session_id FROM q_checked WHERE reason IS NULL)
GROUP BY event_type""")
    q["additive_report_stream"] = q["merge_additive"]
    q["stream_static_top_products"] = with_model("""
q_bare AS (SELECT product_id, CASE WHEN bare THEN NULL ELSE name END AS name, CASE WHEN bare THEN NULL ELSE price END AS price,
                  CASE WHEN bare THEN NULL ELSE category END AS category
           FROM (SELECT *, CAST(substr(product_id, 2) AS BIGINT) % 11 = 0 AS bare FROM m_products))
SELECT p.product_id, p.name AS product_name, coalesce(p.category, 'Unknown') AS category,
       CAST(sum(a.quantity) AS BIGINT) AS total_quantity, count(*) AS add_to_cart_count,
       CAST(sum(a.quantity * coalesce(p.price, 0)) AS DOUBLE) AS estimated_revenue
FROM m_cart a JOIN q_bare p ON a.product_id = p.product_id
GROUP BY p.product_id, p.name, p.category""")
    q["top_products_exact"] = with_model(f"""
q_last AS (
  SELECT product_id, quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY session_id, cart_total_items
                                 ORDER BY _o DESC, _l DESC, _p DESC, _s DESC, _x DESC) AS rn
    FROM m_cart) WHERE rn = 1)
SELECT p.product_id, p.name AS product_name, coalesce(p.category, 'Unknown') AS category,
       CAST(sum(a.quantity) AS BIGINT) AS total_quantity, count(*) AS add_to_cart_count,
       CAST(sum(a.quantity * coalesce(p.price, 0)) AS DOUBLE) AS estimated_revenue
FROM q_last a JOIN m_products p ON a.product_id = p.product_id
GROUP BY p.product_id, p.name, p.category""")
    q["sales_stream"] = q["sales_daily"]
    q["report_backfill"] = q["sales_daily"]
    q["sales_signed"] = with_model("""
q_last AS (
  SELECT CASE WHEN c AND _pos % 5 = 0 THEN created_at + INTERVAL 1 DAY ELSE created_at END AS created_at,
         CASE WHEN c THEN total + 1 ELSE total END AS total,
         CASE WHEN NOT c THEN status WHEN status IS NULL THEN 'completed' END AS status,
         CASE WHEN c AND _pos % 7 = 0 THEN 'u1' ELSE user_id END AS user_id
  FROM (SELECT *, _pos % 3 = 0 AND _pos % 6 <> 0 AS c FROM m_orders))
SELECT CAST(created_at AS DATE) AS report_date, count(*) AS order_count, CAST(sum(total) AS DOUBLE) AS total_revenue,
       count(DISTINCT user_id) AS purchasing_users
FROM q_last WHERE status = 'completed' GROUP BY 1""")
    q["loyalty_signed"] = with_model("""
q_last AS (
  SELECT CASE WHEN c AND k % 5 = 0 THEN 'MOVED' ELSE location END AS location,
         CASE WHEN NOT c THEN loyalty_tier WHEN loyalty_tier = 'Gold' THEN 'Bronze' WHEN loyalty_tier = 'Bronze' THEN 'Silver'
              WHEN loyalty_tier = 'Silver' THEN 'Gold' END AS loyalty_tier
  FROM (SELECT *, k % 4 = 0 AND k % 8 <> 0 AS c FROM (SELECT *, CAST(substr(user_id, 2) AS BIGINT) AS k FROM m_users)))
SELECT location, loyalty_tier, count(*) AS user_count FROM q_last GROUP BY 1, 2""")
    q["loyalty_stream"] = q["loyalty_segments"]
    q["exact_report_stream"] = q["behavior_funnel_daily"]
    q["device_usage_full"] = with_model("""
SELECT device,
       count(*) FILTER (WHERE event_type = 'page_view') AS page_views,
       count(*) FILTER (WHERE event_type = 'product_search') AS searches,
       count(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_carts,
       count(*) FILTER (WHERE event_type = 'checkout_start') AS checkout_starts,
       count(*) FILTER (WHERE event_type = 'payment_attempt') AS payment_attempts,
       count(*) FILTER (WHERE event_type = 'order_complete') AS completed_orders
FROM m_events GROUP BY device""")
    q["device_stream"] = q["device_usage_full"]
    q["cursor_rejects"] = """
SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'key without a number' WHEN o_orderkey % 7 = 0 THEN 'missing key'
            ELSE 'exported' END AS reason, count(*) AS n FROM orders GROUP BY 1"""
    q["land_rejects"] = """
SELECT CASE event_id % 5 WHEN 0 THEN 'landed' WHEN 1 THEN 'bad magic byte' WHEN 2 THEN 'truncated header'
       WHEN 3 THEN 'payload is not a JSON object' ELSE 'timestamp does not parse' END AS reason, count(*) AS n
FROM events WHERE event_type = 'purchase' GROUP BY 1"""
    more = MORE_EVENTS_SQL
    q["validate_more_events"] = f"""{more}
SELECT "timestamp", user_id, session_id, event_type, 'mobile' AS device, CAST(NULL AS VARCHAR) AS url_path,
       CAST(NULL AS INTEGER) AS duration_sec, CAST(NULL AS INTEGER) AS http_status, CAST(NULL AS VARCHAR) AS query,
       CAST(NULL AS INTEGER) AS results_count, CAST(NULL AS INTEGER) AS clicked_position, CAST(NULL AS DOUBLE) AS cart_value,
       CASE WHEN t <> 2 THEN 'p' || n END AS product_id, CASE WHEN t = 0 THEN CAST(1 + n % 3 AS INTEGER) END AS quantity,
       CAST(NULL AS INTEGER) AS cart_total_items,
       CASE WHEN t = 1 THEN CASE WHEN n % 2 = 0 THEN 'gifts' ELSE 'default' END END AS wishlist_name,
       CAST(NULL AS VARCHAR) AS shipping_method, CASE WHEN t = 2 THEN 'card' END AS payment_type,
       CASE WHEN t = 2 THEN n % 6 = 1 END AS success, CASE WHEN t = 2 AND n % 3 = 0 THEN 'E1' END AS error_code,
       CAST(NULL AS VARCHAR) AS order_id, CAST(NULL AS VARCHAR) AS fulfillment_speed,
       CASE WHEN t = 3 THEN CASE WHEN n % 8 = 1 THEN 4 ELSE CAST(1 + n % 5 AS INTEGER) END END AS rating,
       CASE WHEN t = 3 THEN CASE WHEN n % 2 = 0 THEN CAST(n % 100 AS INTEGER) ELSE 0 END END AS text_length
FROM m WHERE reason IS NULL"""
    q["validate_more_rejects"] = f"""{more}
SELECT reason, count(*) AS n FROM m WHERE reason IS NOT NULL GROUP BY reason"""
    every = with_model(f"""{RAW_EVENTS_SQL},
q_more AS (SELECT * FROM ({more} SELECT * FROM m WHERE reason IS NULL)),
q_all AS (
  SELECT event_type, "timestamp", user_id, session_id FROM q_checked WHERE reason IS NULL
  UNION ALL SELECT event_type, "timestamp", user_id, session_id FROM q_more
  UNION ALL SELECT 'cart_view', CAST(l_shipdate AS TIMESTAMP), 'u' || l_suppkey, 's' || l_orderkey || '-' || l_linenumber
  FROM lineitem WHERE l_linenumber NOT IN (6, 7))""")
    q["publish_events_by_type"] = f"""{every}
SELECT topic, schema_id, count(*) AS n FROM q_all JOIN (VALUES
  ('page_view', 'events.page_view', 1), ('product_search', 'events.search', 2), ('cart_view', 'events.cart_view', 3),
  ('add_to_cart', 'events.add_to_cart', 4), ('remove_from_cart', 'events.remove_from_cart', 5), ('wishlist_add', 'events.wishlist', 6),
  ('checkout_start', 'events.checkout', 7), ('payment_attempt', 'events.payment', 8), ('order_complete', 'events.order', 9),
  ('review_submit', 'events.review', 10)) t(e, topic, schema_id) ON event_type = e GROUP BY 1, 2"""
    q["land_events"] = f"""{every}
SELECT event_type, count(*) AS n, CAST(sum(CAST(epoch(ts) AS BIGINT) % 1000) AS BIGINT) AS time_sum
FROM (SELECT DISTINCT event_type, user_id, session_id, date_trunc('second', "timestamp") AS ts FROM q_all) GROUP BY 1"""
    q["land_events_stream"] = f"""{every}
SELECT DISTINCT event_type, user_id, session_id, date_trunc('second', "timestamp") AS "timestamp",
       CAST(NULL AS VARCHAR) AS device, CAST(NULL AS VARCHAR) AS url_path, CAST(NULL AS INTEGER) AS duration_sec, CAST(NULL AS INTEGER) AS http_status
FROM q_all WHERE event_type <> 'page_view'
UNION ALL SELECT event_type, user_id, session_id, date_trunc('second', "timestamp"), device, url_path, k, 200
FROM q_checked WHERE reason IS NULL AND event_type = 'page_view'"""
    q["landing_bucketed"] = with_model("""
SELECT order_id, user_id, created_at, CASE WHEN _pos % 3 <> 0 THEN CAST(total AS DOUBLE) END AS total, status, payment_method FROM m_orders""")
    q["land_tables_stream"] = with_model("""
q_keys AS (SELECT *, CAST(substr(row_key, 2) AS BIGINT) % 2 = 0 AS c FROM (
  SELECT 'users' AS table_name, user_id AS row_key, device AS v FROM m_users
  UNION ALL SELECT 'products', product_id, CAST(inventory AS VARCHAR) FROM m_products
  UNION ALL SELECT 'orders', order_id, payment_method FROM m_orders))
SELECT table_name, row_key, CASE WHEN NOT c THEN v WHEN table_name = 'users' THEN 'tablet' WHEN table_name = 'orders' THEN 'paypal'
       ELSE CAST(CAST(v AS INTEGER) + 1 AS VARCHAR) END AS landed_value FROM q_keys""")
    q["funnel_state_stream"] = with_model(f"""q_counts AS ({FUNNEL_COUNTS_SQL})
{FUNNEL_SELECT}
WHERE searches + product_views + add_to_cart_events + checkout_starts + purchases > 0""")
    q["distinct_users_sketch"] = with_model("""
SELECT CAST(created_at AS DATE) AS report_date, count(DISTINCT user_id) AS purchasing_users, true AS within_bound
FROM m_orders WHERE status = 'completed' AND user_id IS NOT NULL GROUP BY 1""")
    q["scan_jsonl_events"] = with_model(f"""{RAW_EVENTS_SQL}
SELECT 'valid' AS outcome, event_type AS what, count(*) AS n FROM q_checked WHERE reason IS NULL GROUP BY 2
UNION ALL SELECT 'rejected', reason, count(*) FROM q_checked WHERE reason IS NOT NULL GROUP BY 2""")
    q["scan_day_lines"] = """
SELECT strftime(ts, '%Y%m%d') AS day, count(*) AS n_lines FROM events GROUP BY 1 UNION ALL SELECT '19700101', 0"""
    q["incomplete_files"] = """
SELECT count(*) AS n_files, count(*) FILTER (WHERE day % 3 = 0) AS n_incomplete
FROM (SELECT DISTINCT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day FROM events)"""
    q["declared_tables"] = """
SELECT t AS table_name, step, CASE WHEN step IN ('declared', 'reset') THEN 0 ELSE n END AS n
FROM (SELECT 'users' AS t, count(*) AS n FROM customer UNION ALL SELECT 'products', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders),
     (VALUES ('declared'), ('loaded'), ('reset'), ('reloaded')) s(step)"""
    q["ledger_rows"] = with_model(f"""{RAW_EVENTS_SQL}
SELECT count(*) AS records_inserted, 1 AS empty_files
FROM (SELECT DISTINCT event_type, "timestamp", session_id FROM q_checked WHERE reason IS NULL)""")
    q["delivery_results"] = with_model(f"""{RAW_EVENTS_SQL}
SELECT 'read' AS outcome, 2 * count(*) AS n FROM q_checked
UNION ALL SELECT 'valid', 2 * count(*) FROM q_checked WHERE reason IS NULL
UNION ALL SELECT 'rejected', 2 * count(*) FROM q_checked WHERE reason IS NOT NULL
UNION ALL SELECT 'stored', count(*) FROM (SELECT DISTINCT event_type, "timestamp", session_id FROM q_checked WHERE reason IS NULL)""")
    q["stream_dedupe"] = with_model("""
SELECT event_type, count(*) AS n FROM (SELECT DISTINCT event_type, user_id, session_id, "timestamp" FROM m_events) GROUP BY 1""")
    q["load_orders_job"] = with_model(f"""{RAW_ORDERS_SQL},
q_good AS (SELECT *, CAST(substr(order_id, 2) AS BIGINT) AS k FROM q_orders_typed
           WHERE created_at IS NOT NULL AND status IS NOT NULL AND payment_method IS NOT NULL
             AND (user_id IS NULL OR user_id IN (SELECT user_id FROM m_users)))
SELECT order_id, user_id, created_at,
       CASE WHEN k % 12 = 0 THEN 2.50 WHEN k % 4 = 0 THEN 1.25 ELSE total END::DECIMAL(10,2) AS total, status, payment_method
FROM q_good""")
    q["duplicate_key_report"] = with_model("""
SELECT session_id || '#' || CAST(cart_total_items AS VARCHAR) AS line_key, count(*) AS n
FROM m_cart GROUP BY 1 HAVING count(*) > 1""")
    q["message_schema_check"] = """
SELECT 'users' AS table_name, 'u' || CAST(c_custkey AS VARCHAR) AS "row", 'required field is null: email' AS reason
FROM customer WHERE c_acctbal >= 0 AND c_acctbal < 100
UNION ALL
SELECT 'products', 'p' || CAST(p_partkey AS VARCHAR), 'required field is null: name' FROM part WHERE p_size % 9 = 0
UNION ALL
SELECT 'orders', 'o' || CAST(o_orderkey AS VARCHAR), 'required field is null: order_id' FROM orders WHERE o_orderkey % 8 = 0"""
    q["domain_findings"] = with_model(f"""{RAW_USERS_SQL}, {RAW_PRODUCTS_SQL.strip()}, {RAW_ORDERS_SQL.strip()},
q_found AS (
  SELECT 'users' AS table_name, 'email' AS column_name, 'missing' AS finding, count(*) FILTER (email IS NULL) AS n FROM q_users_raw
  UNION ALL SELECT 'users', 'loyalty_tier', 'missing', count(*) FILTER (loyalty_tier IS NULL) FROM q_users_raw
  UNION ALL SELECT 'users', 'loyalty_tier', 'outside domain',
    count(*) FILTER (lower(trim(loyalty_tier)) NOT IN ('bronze', 'silver', 'gold')) FROM q_users_raw
  UNION ALL SELECT 'users', 'device', 'outside domain',
    count(*) FILTER (lower(trim(device)) NOT IN ('desktop', 'mobile', 'tablet')) FROM q_users_raw
  UNION ALL SELECT 'products', 'category', 'outside domain',
    count(*) FILTER (lower(trim(category)) NOT IN ('beauty', 'clothing', 'electronics', 'home', 'other')) FROM q_products_raw
  UNION ALL SELECT 'orders', 'status', 'missing', count(*) FILTER (status IS NULL) FROM q_orders_raw
  UNION ALL SELECT 'orders', 'payment_method', 'missing', count(*) FILTER (payment_method IS NULL) FROM q_orders_raw
  UNION ALL SELECT 'orders', 'status', 'outside domain', count(*) FILTER (lower(trim(status)) <> 'completed') FROM q_orders_raw
  UNION ALL SELECT 'orders', 'payment_method', 'outside domain',
    count(*) FILTER (lower(trim(payment_method)) NOT IN ('credit_card', 'apple_pay', 'google_pay', 'paypal')) FROM q_orders_raw)
SELECT table_name, column_name, finding, n FROM q_found WHERE n > 0
UNION ALL
SELECT * FROM (
  SELECT 'users' AS t, 'user_id' AS c, 'repeated' AS f, count(*) AS n FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)
  UNION ALL SELECT 'products', 'product_id', 'repeated', count(*) FROM (SELECT 1 FROM part GROUP BY p_partkey HAVING count(*) > 1)
  UNION ALL SELECT 'orders', 'order_id', 'repeated', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
WHERE n > 0""")
    q["run_summary"] = with_model(f"""{RAW_EVENTS_SQL}
SELECT 'sessions_' || strftime("timestamp", '%Y%m%d') || '_events.json' AS source_file,
       CASE WHEN reason IS NULL THEN 'stored' ELSE 'rejected' END AS outcome, count(*) AS n
FROM q_checked GROUP BY 1, 2""")
    q["publish_since_cursor"] = with_model("""
q_first AS (SELECT order_id, _pos FROM m_orders WHERE created_at < TIMESTAMP '1998-01-01')
SELECT order_id, CAST(0 AS BIGINT) AS batch_id FROM q_first
UNION ALL
SELECT order_id, CAST(1 AS BIGINT) AS batch_id FROM m_orders WHERE _pos > (SELECT max(_pos) FROM q_first)""")
    q["export_changes"] = """
SELECT product_id, price, CAST(1 AS BIGINT) AS _version FROM (
  SELECT 'p' || CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC,
                            l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1"""
    q["cart_items_clean"] = """
SELECT 's' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS session_id,
       0 AS item_pos, 'p' || CAST(l_partkey AS VARCHAR) AS product_id, l_extendedprice AS price,
       CAST(l_quantity AS INTEGER) AS quantity
FROM lineitem WHERE l_linenumber NOT IN (5, 6, 7)
UNION ALL
SELECT 's' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), 1,
       'p' || CAST(l_suppkey AS VARCHAR), 0.0, l_linenumber
FROM lineitem WHERE l_linenumber NOT IN (5, 6, 7)"""
    return q


ORACLE_SQL = _sql()
