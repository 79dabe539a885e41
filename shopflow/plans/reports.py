"""The five dashboard reports (R1-R5), exact and additive.

``exact`` reports are computed from the deduplicated tables in one pass each:
single-pass conditional aggregation instead of one scan per event type, map-
side partial aggregation before every shuffle, and the join of the top-
products report done *after* the cart events are aggregated per product (so
the join input is one row per product, however hot a product is).

``additive`` helpers produce the per-branch delta rows of the source system's
summing tables (one branch per event table, zeros elsewhere), to be merged
with ``operators.merge.merge_additive``; see ``streaming.reports``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.schemas import DEVICE_COUNTS, FUNNEL_COUNTS, FUNNEL_RATES, TIER_RANK
from shopflow.functions.columns import lookup

# -- R1 ---------------------------------------------------------------------


def sales_daily(orders: DataFrame) -> DataFrame:
    """Completed orders per day: count, revenue, distinct purchasing users.

    Revenue is summed in DECIMAL and returned as DOUBLE.  ``purchasing_users``
    is an exact distinct count (Catalyst's two-phase distinct: partial
    aggregation on (day, user) before the shuffle, then on day).
    """
    done = orders.filter(F.col("status") == "completed")
    return (done.groupBy(F.to_date("created_at").alias("report_date"))
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum("total").cast("double").alias("total_revenue"),
                 F.count_distinct("user_id").alias("purchasing_users")))


def sales_daily_pairs(orders: DataFrame) -> DataFrame:
    """Incremental form of ``purchasing_users``: distinct (day, user) pairs.

    Distinct counts are never summed across batches (a user buying in two
    batches of one day counts once); the pairs are kept and counted.
    """
    done = orders.filter((F.col("status") == "completed") & F.col("user_id").isNotNull())
    return done.select(F.to_date("created_at").alias("report_date"), "user_id").distinct()


def sales_deltas(orders: DataFrame) -> DataFrame:
    """Additive part of the sales report: completed orders and revenue per day."""
    done = orders.filter(F.col("status") == "completed")
    return done.groupBy(F.to_date("created_at").alias("report_date")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total").alias("total_revenue"))


def sales_from_parts(sums: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sales report from summed deltas and from (day, user) pairs, which
    may repeat."""
    totals = sums.groupBy("report_date").agg(F.sum("order_count").cast("bigint").alias("order_count"),
                                             F.sum("total_revenue").cast("double").alias("total_revenue"))
    return totals.join(count_pairs(pairs.distinct()).withColumnRenamed("report_date", "_day"),
                       F.col("report_date").eqNullSafe(F.col("_day")), "left").select(
        "report_date", "order_count", "total_revenue",
        F.coalesce("purchasing_users", F.lit(0)).cast("bigint").alias("purchasing_users"))


def sales_signed_deltas(changes: DataFrame) -> DataFrame:
    """Additive part of the sales report from signed rows (``merge.signed_changes``)."""
    done = changes.filter(F.col("status") == "completed")
    return done.groupBy(F.to_date("created_at").alias("report_date")).agg(
        F.sum("_sign").alias("order_count"), F.sum(F.col("total") * F.col("_sign")).alias("total_revenue"))


def sales_signed_pairs(changes: DataFrame) -> DataFrame:
    """(day, user) pairs with the number of orders that come or go."""
    done = changes.filter((F.col("status") == "completed") & F.col("user_id").isNotNull())
    return done.groupBy(F.to_date("created_at").alias("report_date"), "user_id").agg(F.sum("_sign").alias("n")).filter("n <> 0")


def sales_from_signed(sums: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sales report from signed deltas: a user counts on days where orders
    of theirs are left, and a day without orders is no day of the report."""
    left = pairs.groupBy("report_date", "user_id").agg(F.sum("n").alias("n")).filter("n > 0").select("report_date", "user_id")
    return sales_from_parts(sums, left).filter("order_count > 0")


#: log2 of the buckets of a distinct sketch, and its relative standard error.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def user_sketches(orders: DataFrame) -> DataFrame:
    """A HyperLogLog sketch of each day's purchasing users."""
    done = orders.filter((F.col("status") == "completed") & F.col("user_id").isNotNull())
    return done.groupBy(F.to_date("created_at").alias("report_date")).agg(F.hll_sketch_agg("user_id", SKETCH_BITS).alias("sketch"))


def users_from_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct users of the united sketches, by day or coarser."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimated_users"))


def count_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("report_date").agg(F.count(F.lit(1)).alias("purchasing_users"))


# -- R2 ---------------------------------------------------------------------


def _cart_totals(cart: DataFrame) -> DataFrame:
    return (cart.groupBy("product_id")
            .agg(F.sum("quantity").cast("bigint").alias("total_quantity"),
                 F.count(F.lit(1)).alias("add_to_cart_count")))


def top_products(cart: DataFrame, products: DataFrame) -> DataFrame:
    """Per product: quantity, number of add-to-cart events, estimated revenue.

    Carts are aggregated per product first (partial aggregation absorbs hot
    products), then inner-joined with the product table (one row per
    product_id after ``latest_by_key``).  Revenue = sum(quantity * price) =
    price * sum(quantity), exact in DECIMAL; a NULL price counts as 0 and a
    NULL category reads 'Unknown'.
    """
    totals = _cart_totals(cart)
    p = products.select("product_id", "name", "category", "price")
    return (totals.join(p, "product_id", "inner")
            .select("product_id",
                    F.col("name").alias("product_name"),
                    F.coalesce("category", F.lit("Unknown")).alias("category"),
                    "total_quantity", "add_to_cart_count",
                    (F.col("total_quantity").cast("decimal(20,0)") * F.coalesce("price", F.lit(0)))
                    .cast("double").alias("estimated_revenue")))


def top_products_top(cart: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The dashboard: top ``n`` products by revenue (ties broken by id).

    The category is shown as stored (NULL allowed) and revenue rounded to 2
    places, as the dashboard query does; Spark plans TakeOrderedAndProject.
    """
    totals = _cart_totals(cart)
    p = products.select("product_id", "name", "category", "price")
    rev = F.round(F.col("total_quantity").cast("decimal(20,0)") * F.col("price"), 2)
    return (totals.join(p, "product_id", "inner")
            .select("product_id", F.col("name").alias("product_name"), "category",
                    "total_quantity", "add_to_cart_count", rev.cast("double").alias("estimated_revenue"))
            .orderBy(F.desc_nulls_last("estimated_revenue"), "product_id")
            .limit(n))


# -- R3 ---------------------------------------------------------------------

FUNNEL_TYPES = ["product_search", "page_view", "add_to_cart", "checkout_start", "order_complete"]


def _is_product_view() -> Column:
    return (F.col("event_type") == "page_view") & F.lower("url_path").contains("product")


def _funnel_flags() -> dict[str, Column]:
    return {
        "searches": F.col("event_type") == "product_search",
        "product_views": _is_product_view(),
        "add_to_cart_events": F.col("event_type") == "add_to_cart",
        "checkout_starts": F.col("event_type") == "checkout_start",
        "purchases": F.col("event_type") == "order_complete",
    }


def rate(num: str, den: str) -> Column:
    """round(100 * num / nullif(den, 0), 2), half-up, as DOUBLE.

    Counts are non-negative integers, so the rounding is done exactly in
    integer arithmetic: floor((20000 n + d) / 2d) / 100.  (Decimal division
    would round the quotient once before the final round; doubles would
    round 1.005 down.)
    """
    return F.expr(f"CAST((20000 * `{num}` + `{den}`) div (2 * NULLIF(`{den}`, 0)) AS DOUBLE) / 100")


def with_funnel_rates(counts: DataFrame) -> DataFrame:
    return counts.select("*", *[rate(a, b).alias(name) for name, a, b in FUNNEL_RATES])


def behavior_funnel_daily(events: DataFrame, ordered: bool = True) -> DataFrame:
    """Daily funnel: five counts in one pass over the event table + 4 rates.

    ``events`` is the flat event table (all types, ``event_type`` column,
    ``url_path`` for page views).  The filter on the five types prunes
    partitions when the table is stored ``partitionBy("event_type")``.
    """
    ev = events.filter(F.col("event_type").isin(*FUNNEL_TYPES))
    flags = _funnel_flags()
    counts = (ev.groupBy(F.to_date("timestamp").alias("report_date"))
              .agg(*[F.count_if(flags[c]).alias(c) for c in FUNNEL_COUNTS]))
    # Sorted by day (one row per day: a bounded final sort)
    out = with_funnel_rates(counts)
    return out.orderBy("report_date") if ordered else out


def funnel_counts(events: DataFrame, *by: Column) -> DataFrame:
    """The five funnel counts by any columns, as of a day or a window."""
    flags = _funnel_flags()
    return events.filter(F.col("event_type").isin(*FUNNEL_TYPES)).groupBy(*by).agg(*[F.count_if(flags[c]).alias(c) for c in FUNNEL_COUNTS])


def funnel_deltas(events: DataFrame) -> DataFrame:
    """The additive form: the delta rows of the five event tables (each with
    its own measure, zeros elsewhere), from one pass over the events."""
    flags = _funnel_flags()
    counts = events.groupBy(F.to_date("timestamp").alias("report_date")).agg(
        *[F.count_if(flags[c]).alias(c) for c in FUNNEL_COUNTS])
    branch = F.explode(F.array(*[F.struct(*[(F.col(c) if c == m else F.lit(0).cast("bigint")).alias(c) for c in FUNNEL_COUNTS])
                                 for m in FUNNEL_COUNTS]))
    return counts.select("report_date", branch.alias("d")).select("report_date", "d.*") \
        .filter(F.greatest(*FUNNEL_COUNTS) > 0)


def funnel_from_deltas(deltas: DataFrame) -> DataFrame:
    """The dashboard query over the summing table: sum per day, then rates."""
    counts = deltas.groupBy("report_date").agg(*[F.sum(c).cast("bigint").alias(c) for c in FUNNEL_COUNTS])
    return with_funnel_rates(counts).orderBy("report_date")


# -- R4 ---------------------------------------------------------------------


def tier_rank(c: Column) -> Column:
    return lookup(TIER_RANK, c, F.lit(4))


def loyalty_segments(users: DataFrame, ordered: bool = True) -> DataFrame:
    """Users per (location, loyalty tier), sorted by location then tier rank.

    The sort runs on the aggregated rows only (locations x tiers: bounded).
    """
    seg = users.groupBy("location", "loyalty_tier").agg(F.count(F.lit(1)).alias("user_count"))
    if ordered:
        seg = seg.orderBy(F.col("location").asc_nulls_first(), tier_rank(F.col("loyalty_tier")))
    return seg


def loyalty_signed_deltas(changes: DataFrame) -> DataFrame:
    """Users that come into or leave a segment, from signed rows."""
    return changes.groupBy("location", "loyalty_tier").agg(F.sum("_sign").alias("user_count")).filter("user_count <> 0")


def loyalty_from_signed(deltas: DataFrame) -> DataFrame:
    seg = deltas.groupBy("location", "loyalty_tier").agg(F.sum("user_count").cast("bigint").alias("user_count"))
    return seg.filter("user_count > 0")


# -- R5 ---------------------------------------------------------------------

_DEVICE_TYPES = {"page_views": "page_view", "searches": "product_search", "add_to_carts": "add_to_cart",
                 "checkout_starts": "checkout_start", "payment_attempts": "payment_attempt",
                 "completed_orders": "order_complete"}


def device_usage_table(events: DataFrame, full: bool = False) -> DataFrame:
    """The report table: six counts per device in one pass.

    The source system never fills ``checkout_starts`` / ``payment_attempts``
    (constant 0); ``full=True`` counts them from their events.
    """
    measures = []
    for c in DEVICE_COUNTS:
        if c in ("checkout_starts", "payment_attempts") and not full:
            measures.append(F.lit(0).cast("bigint").alias(c))
        else:
            measures.append(F.count_if(F.col("event_type") == _DEVICE_TYPES[c]).alias(c))
    wanted = [t for c, t in _DEVICE_TYPES.items()
              if full or c not in ("checkout_starts", "payment_attempts")]
    return events.filter(F.col("event_type").isin(*wanted)).groupBy("device").agg(*measures)


def device_usage(events: DataFrame) -> DataFrame:
    """The dashboard query: four counts per device, most orders first."""
    t = device_usage_table(events)
    return (t.select("device", "page_views", "searches", "add_to_carts", "completed_orders")
            .orderBy(F.desc("completed_orders"), F.col("device").asc_nulls_first()))
