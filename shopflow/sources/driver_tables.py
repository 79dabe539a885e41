"""Adapters from the driver's TPC-H-like tables to shopflow's model tables.

The driver ships ``customer nation part orders lineitem events`` (and others);
the engine works on ``users products orders`` master tables and behavioural
events.  Each adapter is a pure projection (plus the fixed 25-row ``nation``
lookup), so Catalyst prunes columns and pushes filters into the Parquet scan.

Mappings (SURVEY §7.3):

* users    <- customer x nation: ``u<custkey>``, device by custkey mod 3,
              loyalty tier by account-balance band (negative -> NULL),
              location = nation name, signup date = 2020-01-01 + custkey mod 1461 days.
* products <- part: ``p<partkey>``, price as DECIMAL(10,2), category from p_type
              (PROMO -> NULL so the 'Unknown' fallback is exercised).
* orders   <- orders: ``o<orderkey>``, status 'completed' for F else NULL,
              payment method by priority (5-LOW -> NULL).
* cart     <- lineitem: one add_to_cart event per line; session = order,
              user = supplier (stand-in), time = ship date + line number seconds.
* events   <- events: view/signup/click/error/purchase become
              page_view/product_search/add_to_cart/checkout_start/order_complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.functions.columns import lookup

# Fixed adapter mappings (part of this engine's test contract with its oracle).
PTYPE_CATEGORY = {"ECONOMY": "Home", "SMALL": "Beauty", "MEDIUM": "Clothing",
                  "LARGE": "Electronics", "STANDARD": "Other"}
PRIORITY_PAYMENT = {"1-URGENT": "credit_card", "2-HIGH": "apple_pay",
                    "3-MEDIUM": "google_pay", "4-NOT SPECIFIED": "paypal"}
DEVICE_BY_MOD3 = {0: "desktop", 1: "mobile", 2: "tablet"}
EVENT_TYPE_MAP = {"view": "page_view", "signup": "product_search", "click": "add_to_cart",
                  "error": "checkout_start", "purchase": "order_complete"}
GOLD_FROM, SILVER_FROM = 6000.0, 2000.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prefixed(prefix: str, col: str) -> Column:
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def _device(col: Column) -> Column:
    return lookup(DEVICE_BY_MOD3, F.pmod(col, F.lit(3)))


def _ts(col: str) -> Column:
    # Driver parquet holds wall-clock TIMESTAMP_NTZ; the session zone is UTC.
    return F.col(col).cast("timestamp")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = read(spark, sf_dir, "customer")
    bal = F.col("c_acctbal")
    tier = (F.when(bal >= GOLD_FROM, "Gold").when(bal >= SILVER_FROM, "Silver")
            .when(bal >= 0, "Bronze"))
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .select(prefixed("u", "c_custkey").alias("user_id"),
                    F.col("c_name").alias("name"),
                    F.concat(F.lit("user"), F.col("c_custkey").cast("string"),
                             F.lit("@shop.example")).alias("email"),
                    F.date_add(F.lit("2020-01-01").cast("date"),
                               F.pmod("c_custkey", F.lit(1461)).cast("int"))
                    .cast("timestamp").alias("signup_date"),
                    _device(F.col("c_custkey")).alias("device"),
                    tier.alias("loyalty_tier"),
                    F.col("n_name").alias("location")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.select(
        prefixed("p", "p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        lookup(PTYPE_CATEGORY, F.col("p_type")).alias("category"),
        F.col("p_size").cast("int").alias("inventory"),
        (F.col("p_size").cast("double") / 50).alias("popularity_score"),
    )


def orders(spark: SparkSession, sf_dir: str, extra: list[Column] = ()) -> DataFrame:
    """Orders; ``extra`` columns of the source rows are passed through."""
    o = read(spark, sf_dir, "orders")
    return o.select(
        prefixed("o", "o_orderkey").alias("order_id"),
        prefixed("u", "o_custkey").alias("user_id"),
        _ts("o_orderdate").alias("created_at"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total"),
        F.when(F.col("o_orderstatus") == "F", F.lit("completed")).alias("status"),
        lookup(PRIORITY_PAYMENT, F.col("o_orderpriority")).alias("payment_method"),
        *extra,
    )


def cart_events(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """add_to_cart events, one per line item, with an ingest position ``_pos``.

    ``_pos`` is a struct giving a total order over rows (the tuple is unique in
    the driver's data), standing in for the (partition, offset) of delivery.
    ``where`` filters line items before the projection (pushed to the scan).
    """
    li = read(spark, sf_dir, "lineitem")
    if where is not None:
        li = li.filter(where)
    return li.select(
        (_ts("l_shipdate") + F.make_dt_interval(secs=F.col("l_linenumber").cast("int")))
        .alias("timestamp"),
        prefixed("u", "l_suppkey").alias("user_id"),
        prefixed("s", "l_orderkey").alias("session_id"),
        F.lit("add_to_cart").alias("event_type"),
        _device(F.col("l_linenumber")).alias("device"),
        prefixed("p", "l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_linenumber").cast("int").alias("cart_total_items"),
        F.struct(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"),
                 F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"),
                 F.col("l_extendedprice").alias("x")).alias("_pos"),
    )


def behavior_events(spark: SparkSession, sf_dir: str, extra: list[Column] = ()) -> DataFrame:
    """Behavioural events in the flat landing shape of the five funnel types.

    Columns: timestamp, user_id, session_id, event_type, device, url_path
    (page_view only), query (product_search), product_id / quantity
    (add_to_cart), cart_value (checkout_start), order_id (order_complete),
    and ``_pos`` (= event_id) as ingest position.  ``extra`` columns of the
    source rows are passed through (same projection, no join).
    """
    ev = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    et = lookup(EVENT_TYPE_MAP, F.col("event_type"))
    return ev.select(
        _ts("ts").alias("timestamp"),
        prefixed("u", "user_id").alias("user_id"),
        F.concat(F.lit("s"), F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format(_ts("ts"), "yyyyMMdd")).alias("session_id"),
        et.alias("event_type"),
        _device(F.col("user_id")).alias("device"),
        F.when(F.col("event_type") == "view",
               F.concat(F.when(F.pmod(k, F.lit(2)) == 0, F.lit("/Product/")).otherwise(F.lit("/home/")),
                        k.cast("string"))).alias("url_path"),
        F.when(F.col("event_type") == "signup", F.concat(F.lit("q"), k.cast("string"))).alias("query"),
        F.when(F.col("event_type") == "click", F.concat(F.lit("p"), k.cast("string"))).alias("product_id"),
        F.when(F.col("event_type") == "click", 1 + F.pmod(k, F.lit(5))).alias("quantity"),
        F.when(F.col("event_type") == "error", F.col("value")).alias("cart_value"),
        F.when(F.col("event_type") == "purchase", prefixed("o", "event_id")).alias("order_id"),
        F.col("event_id").alias("_pos"),
        *extra,
    )


# -- raw (string) master data, as exported CSV files hold it -------------------
#
# Derived from the same driver rows with the noise real exports carry: mixed
# case and padding in enum values, unknown enum values, unparsable dates and
# numbers, missing e-mails.  Used to exercise the cleaning operators on whole
# tables (their oracle applies the same rules in SQL).

RAW_TIER = [(6000.0, " GOLD "), (2000.0, "silver"), (0.0, "Bronze")]  # below 0 -> "platinum"
RAW_DEVICE = {0: " Desktop ", 1: "mobile", 2: "TABLET", 3: "watch"}
RAW_CATEGORY = {"ECONOMY": " HOME ", "SMALL": "beauty", "MEDIUM": "Clothing", "LARGE": "ELECTRONICS",
                "STANDARD": "other", "PROMO": "promo"}
RAW_STATUS = {"F": " Completed", "O": "cancelled"}
RAW_PAYMENT = {"1-URGENT": "CREDIT_CARD", "2-HIGH": "apple_pay", "3-MEDIUM": " google_pay ",
               "4-NOT SPECIFIED": "PayPal", "5-LOW": "cash"}


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = read(spark, sf_dir, "customer")
    bal = F.col("c_acctbal")
    tier = F.when(bal >= RAW_TIER[0][0], RAW_TIER[0][1])
    for lo, txt in RAW_TIER[1:]:
        tier = tier.when(bal >= lo, txt)
    tier = tier.otherwise("platinum")
    signup = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"),
                                      F.pmod("c_custkey", F.lit(1461)).cast("int")), "yyyy-MM-dd HH:mm:ss")
    return (c.join(nation, c.c_nationkey == nation.n_nationkey, "left")
            .select(prefixed("u", "c_custkey").alias(" User_ID "),
                    F.col("c_name").alias("Name"),
                    F.when((bal >= 0) & (bal < 100), F.lit(None).cast("string"))
                    .otherwise(F.concat(F.lit(" User"), F.col("c_custkey").cast("string"),
                                        F.lit("@Shop.Example "))).alias("EMAIL"),
                    F.when(F.pmod("c_custkey", F.lit(5)) == 0, F.lit("not a date"))
                    .otherwise(signup).alias("signup_date"),
                    lookup(RAW_DEVICE, F.pmod("c_custkey", F.lit(4))).alias("device"),
                    tier.alias("loyalty_tier"),
                    F.col("n_name").alias("location")))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(
        prefixed("p", "p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.when(F.pmod("p_partkey", F.lit(10)) == 0, F.lit("abc"))
        .otherwise(F.col("p_retailprice").cast("string")).alias("price"),
        lookup(RAW_CATEGORY, F.col("p_type")).alias("category"),
        F.col("p_size").cast("string").alias("inventory"),
        F.when(F.pmod("p_partkey", F.lit(7)) == 0, F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".5"))).alias("popularity_score"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    ts = (F.when(F.pmod("o_orderkey", F.lit(2)) == 0, F.date_format(day, "yyyy-MM-dd"))
          .when(F.pmod("o_orderkey", F.lit(3)) == 0, F.lit("bad"))
          .otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:30:00Z"))))
    return o.select(
        prefixed("o", "o_orderkey").alias("order_id"),
        prefixed("u", "o_custkey").alias("user_id"),
        ts.alias("timestamp"),
        F.col("o_totalprice").cast("string").alias("total"),
        lookup(RAW_STATUS, F.col("o_orderstatus")).alias("status"),
        lookup(RAW_PAYMENT, F.col("o_orderpriority")).alias("payment_method"),
    )


# -- raw session events (JSON lines) ------------------------------------------
#
# One JSON object per driver event, in the shape session files carry, with
# the failure modes of real feeds placed by the event's ``props.k`` value:
#   k = 7   user_id " NaN "            (blank common field)
#   k = 3   device missing             (blank common field)
#   k = 42  event_type "Page_View"     (views only; unknown type)
#   k = 13  timestamp "bad"            (unparsable time)
#   page_view:      duration_sec as text " k " when k % 10 = 1; http_status "2xx" when k % 17 = 0
#   product_search: results_count null when k % 4 = 0; clicked_position 3.7 when k % 5 = 0
#   add_to_cart:    quantity missing when k % 11 = 0; cart_total_items true when k % 9 = 0
#   checkout_start: cart_value "abc" when k % 19 = 0; shipping_method "express" for even k
#   order_complete: fulfillment_speed "  fast  "

def _q(x: str) -> str:
    return f"concat('\"', {x}, '\"')"


def _kv(name: str, value_sql: str) -> str:
    return f"concat('\"{name}\": ', {value_sql})"


RAW_EVENT_SQL = {
    "view": ["'\"url_path\": \"' || url_path || '\"'",
             _kv("duration_sec", "CASE WHEN k % 10 = 1 THEN concat('\" ', k, ' \"') ELSE CAST(k AS STRING) END"),
             _kv("http_status", "CASE WHEN k % 17 = 0 THEN '\"2xx\"' ELSE '200' END")],
    "signup": [_kv("query", _q("concat('q', k)")),
               _kv("results_count", "CASE WHEN k % 4 = 0 THEN 'null' ELSE CAST(k AS STRING) END"),
               "CASE WHEN k % 5 = 0 THEN '\"clicked_position\": 3.7' END"],
    "click": [_kv("product_id", _q("concat('p', k)")),
              "CASE WHEN k % 11 != 0 THEN concat('\"quantity\": ', 1 + k % 5) END",
              _kv("cart_total_items", "CASE WHEN k % 9 = 0 THEN 'true' ELSE CAST(k AS STRING) END")],
    "error": [_kv("cart_value", "CASE WHEN k % 19 = 0 THEN '\"abc\"' ELSE CAST(value AS STRING) END"),
              "CASE WHEN k % 2 = 0 THEN '\"shipping_method\": \"express\"' END"],
    "purchase": [_kv("order_id", _q("order_id")),
                 "'\"fulfillment_speed\": \"  fast  \"'"],
}


def raw_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON lines: (value, source_file, _file, _block, _row).

    ``source_file`` names a day file ``sessions_<yyyymmdd>_events.json`` and
    ``_row`` is the event id, so the provenance columns order lines as the
    session files would.
    """
    joined = behavior_events(spark, sf_dir, extra=[
        F.col("event_type").alias("src_type"), F.col("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k")])
    common = ("concat_ws(', ', "
              "concat('\"timestamp\": ', CASE WHEN k = 13 THEN '\"bad\"' "
              "ELSE concat('\"', date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), 'Z\"') END), "
              "concat('\"user_id\": ', CASE WHEN k = 7 THEN '\" NaN \"' ELSE concat('\"', user_id, '\"') END), "
              "concat('\"event_type\": \"', CASE WHEN src_type = 'view' AND k = 42 THEN 'Page_View' "
              "ELSE event_type END, '\"'), "
              "CASE WHEN k != 3 THEN concat('\"device\": \"', device, '\"') END, "
              "concat('\"session_id\": \"', session_id, '\"'))")
    payload = "CASE " + " ".join(
        f"WHEN src_type = '{t}' THEN concat_ws(', ', {', '.join(parts)})" for t, parts in RAW_EVENT_SQL.items()
    ) + " END"
    line = f"concat('{{', concat_ws(', ', {common}, {payload}), '}}')"
    return joined.selectExpr(
        f"{line} AS value",
        "concat('sessions_', date_format(timestamp, 'yyyyMMdd'), '_events.json') AS source_file",
        "concat('events/', date_format(timestamp, 'yyyyMMdd')) AS _file",
        "CAST(0 AS BIGINT) AS _block", "_pos AS _row")


def raw_cart_view_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cart_view JSON lines, one per line item, with a two-item cart:
    ``{product_id: p<partkey>, price: extended price, quantity}`` and
    ``{product_id: " p<suppkey> ", quantity: "<line number>"}`` (text, padded).
    Failure modes by line number: 7 - the second item lacks ``product_id``;
    6 - ``cart_items`` is a string; 5 - no ``cart_items`` at all (empty cart).
    """
    li = read(spark, sf_dir, "lineitem")
    item1 = ("concat('{\"product_id\": \"p', l_partkey, '\", \"price\": ', CAST(l_extendedprice AS STRING), "
             "', \"quantity\": ', CAST(l_quantity AS INT), '}')")
    item2 = ("CASE WHEN l_linenumber = 7 THEN concat('{\"quantity\": \"', l_linenumber, '\"}') "
             "ELSE concat('{\"product_id\": \" p', l_suppkey, ' \", \"quantity\": \"', l_linenumber, '\"}') END")
    items = (f"CASE WHEN l_linenumber = 6 THEN ', \"cart_items\": \"x\"' WHEN l_linenumber = 5 THEN '' "
             f"ELSE concat(', \"cart_items\": [', {item1}, ', ', {item2}, ']') END")
    line = ("concat('{\"timestamp\": \"', date_format(CAST(l_shipdate AS TIMESTAMP), \"yyyy-MM-dd'T'HH:mm:ss\"), "
            "'Z\", \"user_id\": \"u', l_suppkey, '\", \"event_type\": \"cart_view\", \"device\": \"', "
            "CASE pmod(l_linenumber, 3) WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END, "
            "'\", \"session_id\": \"s', l_orderkey, '-', l_linenumber, '\", \"cart_value\": ', "
            f"CAST(l_extendedprice AS STRING), {items}, '}}')")
    return li.selectExpr(f"{line} AS value", "'lineitem_carts.json' AS source_file",
                         "'carts' AS _file", "CAST(0 AS BIGINT) AS _block",
                         "l_orderkey * 100 + l_linenumber AS _row")


def raw_more_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of the four event types that the events table lacks, one per
    order, by order number mod 4: remove_from_cart, wishlist_add,
    payment_attempt, review_submit.  Failure modes by n = order number div 4:
    quantity missing when n % 7 = 0; product_id null when n % 5 = 0; success
    "maybe" when n % 6 = 0, as text "yes" when n % 6 = 1; rating "x" when
    n % 8 = 0, and as text " 4 " when n % 8 = 1.
    """
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("ts"),
                                             F.floor(F.col("o_orderkey") / 4).cast("bigint").alias("n"))
    payload = ("CASE o_orderkey % 4 "
               "WHEN 0 THEN concat('\"event_type\": \"remove_from_cart\", \"product_id\": \"p', n, '\"', "
               "CASE WHEN n % 7 != 0 THEN concat(', \"quantity\": ', 1 + n % 3) ELSE '' END) "
               "WHEN 1 THEN concat('\"event_type\": \"wishlist_add\", \"product_id\": ', CASE WHEN n % 5 = 0 THEN 'null' ELSE concat('\"p', n, '\"') END, "
               "CASE WHEN n % 2 = 0 THEN ', \"wishlist_name\": \"gifts\"' ELSE '' END) "
               "WHEN 2 THEN concat('\"event_type\": \"payment_attempt\", \"payment_type\": \"card\", \"success\": ', "
               "CASE n % 6 WHEN 0 THEN '\"maybe\"' WHEN 1 THEN '\"yes\"' WHEN 2 THEN '0' ELSE 'false' END, "
               "CASE WHEN n % 3 = 0 THEN ', \"error_code\": \"E1\"' ELSE '' END) "
               "ELSE concat('\"event_type\": \"review_submit\", \"product_id\": \"p', n, '\", \"rating\": ', "
               "CASE n % 8 WHEN 0 THEN '\"x\"' WHEN 1 THEN '\" 4 \"' ELSE CAST(1 + n % 5 AS STRING) END, "
               "CASE WHEN n % 2 = 0 THEN concat(', \"text_length\": ', n % 100) ELSE '' END) END")
    line = ("concat('{\"timestamp\": \"', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z\", \"user_id\": \"u', o_custkey, "
            f"'\", \"device\": \"mobile\", \"session_id\": \"s', o_orderkey, '\", ', {payload}, '}}')")
    return o.selectExpr(f"{line} AS value", "'more_events.json' AS source_file", "'more' AS _file",
                        "CAST(0 AS BIGINT) AS _block", "o_orderkey AS _row")
