"""Declared schemas, enum domains, event rules and topic names.

Nothing here is inferred at run time: every stage reads and writes one of the
StructTypes below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the source system's for identical results.
# ---------------------------------------------------------------------------

# Master tables: expected columns, in this order, and their primary key.
EXPECTED_COLUMNS = {
    "users": ["user_id", "name", "email", "signup_date", "device", "loyalty_tier", "location"],
    "products": ["product_id", "name", "price", "category", "inventory", "popularity_score"],
    "orders": ["order_id", "user_id", "created_at", "total", "status", "payment_method"],
}
PRIMARY_KEYS = {"users": "user_id", "products": "product_id", "orders": "order_id"}

# Enum domains: accepted lower-case spelling -> stored spelling.
LOYALTY_TIERS = {"bronze": "Bronze", "silver": "Silver", "gold": "Gold"}
CATEGORIES = {"beauty": "Beauty", "clothing": "Clothing", "electronics": "Electronics",
              "home": "Home", "other": "Other"}
ORDER_STATUSES = {"completed": "completed"}
PAYMENT_METHODS = {"credit_card": "credit_card", "apple_pay": "apple_pay",
                   "google_pay": "google_pay", "paypal": "paypal"}
DEVICES = {"desktop": "desktop", "mobile": "mobile", "tablet": "tablet"}

# Loyalty tier sort rank of the segmentation report; anything else ranks 4.
TIER_RANK = {"Gold": 1, "Silver": 2, "Bronze": 3}

# Tokens that count as blank for event fields (compared trimmed, lower case).
BLANK_TOKENS = ["null", "none", "nan"]
BOOL_TRUE = ["true", "1", "yes", "y"]
BOOL_FALSE = ["false", "0", "no", "n"]

# Common required fields of a raw event, checked in this order.
COMMON_FIELDS = ["timestamp", "user_id", "event_type", "device", "session_id"]

# Per event type: payload fields as (name, kind, required, default), checked in
# this order.  kind is one of str, int, float, bool, or items (the cart array).
EVENT_RULES = {
    "page_view": [("url_path", "str", True, None),
                  ("duration_sec", "int", False, 0),
                  ("http_status", "int", True, None)],
    "product_search": [("query", "str", True, None),
                       ("results_count", "int", False, 0),
                       ("clicked_position", "int", False, None)],
    "cart_view": [("cart_items", "items", False, None),
                  ("cart_value", "float", False, 0.0)],
    "add_to_cart": [("product_id", "str", True, None),
                    ("quantity", "int", True, 1),
                    ("cart_total_items", "int", False, None)],
    "remove_from_cart": [("product_id", "str", True, None),
                         ("quantity", "int", True, 1),
                         ("cart_total_items", "int", False, None)],
    "wishlist_add": [("product_id", "str", True, None),
                     ("wishlist_name", "str", False, "default")],
    "checkout_start": [("shipping_method", "str", False, None),
                       ("cart_value", "float", True, None)],
    "payment_attempt": [("payment_type", "str", True, None),
                        ("success", "bool", True, None),
                        ("error_code", "str", False, None)],
    "order_complete": [("order_id", "str", True, None),
                       ("fulfillment_speed", "str", False, None)],
    "review_submit": [("product_id", "str", True, None),
                      ("rating", "int", True, None),
                      ("text_length", "int", False, 0)],
}
EVENT_TYPES = list(EVENT_RULES)

# Fields of one cart item: (name, kind, required, default).
CART_ITEM_RULES = [("product_id", "str", True, None),
                   ("price", "float", False, 0.0),
                   ("quantity", "int", False, 1)]

# Topic per master table and per event type.
TABLE_TOPICS = {"users": "postgres.users", "products": "postgres.products",
                "orders": "postgres.orders"}
EVENT_TOPICS = {
    "page_view": "events.page_view",
    "product_search": "events.search",
    "add_to_cart": "events.add_to_cart",
    "remove_from_cart": "events.remove_from_cart",
    "cart_view": "events.cart_view",
    "checkout_start": "events.checkout",
    "payment_attempt": "events.payment",
    "order_complete": "events.order",
    "review_submit": "events.review",
    "wishlist_add": "events.wishlist",
}

# Required (non-null) fields of the JSON messages of the three table topics.
MESSAGE_REQUIRED = {"users": ["user_id", "name", "email"],
                    "products": ["product_id", "name"],
                    "orders": ["order_id"]}

# Message envelope: magic byte 0 followed by a 4-byte big-endian schema id.
ENVELOPE_MAGIC = 0
ENVELOPE_HEADER_BYTES = 5

# ---------------------------------------------------------------------------
# Struct types
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(10, 2)

USERS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("email", T.StringType(), True),
    T.StructField("signup_date", T.TimestampType(), True),
    T.StructField("device", T.StringType(), True),
    T.StructField("loyalty_tier", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("price", MONEY, True),
    T.StructField("category", T.StringType(), True),
    T.StructField("inventory", T.IntegerType(), True),
    T.StructField("popularity_score", T.DoubleType(), True),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("total", MONEY, True),
    T.StructField("status", T.StringType(), True),
    T.StructField("payment_method", T.StringType(), True),
])

MASTER_SCHEMAS = {"users": USERS, "products": PRODUCTS, "orders": ORDERS}

# Landing (topic-fed) versions: money as double, as the analytic store keeps it.
LANDING_MASTER = {
    name: T.StructType([
        T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.DecimalType) else f.dataType, True)
        for f in schema.fields])
    for name, schema in MASTER_SCHEMAS.items()
}

_KIND_TYPES = {"str": T.StringType(), "int": T.IntegerType(), "float": T.DoubleType(),
               "bool": T.BooleanType()}

CART_ITEM = T.StructType([T.StructField(n, _KIND_TYPES[k], True) for n, k, _, _ in CART_ITEM_RULES])


def payload_type(event_type: str) -> T.StructType:
    """Struct type of the validated ``event_data`` of one event type."""
    fields = []
    for name, kind, _, _ in EVENT_RULES[event_type]:
        dtype = T.ArrayType(CART_ITEM, True) if kind == "items" else _KIND_TYPES[kind]
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


# Fixed value: name space of the records of the event topics.
AVRO_NAMESPACE = "behavior.events"
_AVRO = {T.StringType: "string", T.IntegerType: "int", T.DoubleType: "double", T.BooleanType: "boolean"}


def avro_schema(event_type: str) -> dict:
    """The Avro record of an event topic's messages.  Payload fields are
    nullable where they are optional and have no default; times are ISO text."""
    name = "".join(w.capitalize() for w in event_type.split("_"))
    plain = lambda dtype: _AVRO[type(dtype)]
    item = {"type": "record", "name": "CartItem", "fields": [{"name": f.name, "type": plain(f.dataType)} for f in CART_ITEM.fields]}
    data = []
    for (field, kind, required, default), f in zip(EVENT_RULES[event_type], payload_type(event_type).fields, strict=True):
        if kind == "items":
            data.append({"name": field, "type": {"type": "array", "items": item}})
        elif required or default is not None:
            data.append({"name": field, "type": plain(f.dataType)})
        else:
            data.append({"name": field, "type": ["null", plain(f.dataType)], "default": None})
    common = [{"name": n, "type": "string"} for n in ("timestamp", "user_id", "session_id", "event_type", "device")]
    return {"type": "record", "name": name, "namespace": AVRO_NAMESPACE,
            "fields": [*common, {"name": "event_data", "type": {"type": "record", "name": f"{name}Data", "fields": data}}]}


def _union_payload() -> T.StructType:
    """Union of all payload fields (a field name has one type across types)."""
    seen: dict[str, T.StructField] = {}
    for t in EVENT_TYPES:
        for f in payload_type(t).fields:
            if f.name in seen and seen[f.name].dataType != f.dataType:
                raise ValueError(f"payload field {f.name} has two types")
            seen.setdefault(f.name, f)
    return T.StructType(list(seen.values()))


# Validated event: common fields, ``event_data`` with the union of all payload
# fields (only the event type's own are set), and ingestion metadata.
EVENT_DATA = _union_payload()

VALID_EVENT = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("session_id", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("device", T.StringType(), True),
    T.StructField("event_data", EVENT_DATA, True),
    T.StructField("ingestion", T.StructType([
        T.StructField("source_file", T.StringType(), True),
        T.StructField("loaded_at", T.TimestampType(), False),
    ]), False),
])

# Columns of the report tables, which must equal the source system's.
FUNNEL_COUNTS = ["searches", "product_views", "add_to_cart_events", "checkout_starts", "purchases"]
FUNNEL_RATES = [  # (name, numerator, denominator)
    ("view_to_cart_rate", "add_to_cart_events", "product_views"),
    ("cart_to_checkout_rate", "checkout_starts", "add_to_cart_events"),
    ("checkout_to_purchase_rate", "purchases", "checkout_starts"),
    ("view_to_purchase_rate", "purchases", "product_views"),
]
DEVICE_COUNTS = ["page_views", "searches", "add_to_carts", "checkout_starts",
                 "payment_attempts", "completed_orders"]
