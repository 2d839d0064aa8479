"""C2 ``sunset_table``: first and second non-subscription order per customer.

The first order is found per email, the second per customer_id (as in the
report definition), so an email shared by two customers only sees the second
order of the customer picked for its first order.  ``first_order_subscription``
carries the second order's flag (always false after the filter).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.functions.timefn import floor_days_between
from skuflow.operators import orders as ops

SUNSET_COLUMNS = (
    "brand", "email", "customer_id", "first_order_date", "second_order_date",
    "days_between_first_and_second_order", "first_order_id", "second_order_id", "order_count",
    "first_product_name", "first_product_variant", "first_product_quantity",
    "first_order_total_item_count", "first_order_subscription", "second_order_first_product_name",
    "bought_upsell_more_of_the_same",
)


def non_subscription(orders_x: DataFrame) -> Column:
    """Not a subscription and not created from another order."""
    return (~F.coalesce(F.col("is_subscription"), F.lit(False))) & F.col("created_from_order_id").isNull()


def order_pairs(orders_x: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """First order per email joined to the second order of its customer (J15,
    J16) with the whole days between them (F6).  The second order needs no
    email: taken from ``orders`` (the same orders before the customer join), the
    limit per customer applies before any shuffle, so a guest customer's orders
    never meet in one task.

    brand, email, customer_id, first_order_id, first_order_date, order_count,
    second_order_id, second_order_date, second_is_subscription,
    days_between_first_and_second_order
    """
    firsts = ops.email_first_orders(orders_x, non_subscription(orders_x)).drop("first_is_subscription")
    seconds = ops.second_order_by_customer((orders_x if orders is None else orders).where(non_subscription(orders_x)))
    return firsts.join(seconds, ["brand", "customer_id"]).withColumn(
        "days_between_first_and_second_order",
        floor_days_between("first_order_date", "second_order_date"))


def sunset_table(orders_x: DataFrame, items_x: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """15 report columns plus ``brand``; pairs whose first or second order
    has no items are dropped (J18).  Item facts are per-order partial
    aggregates over the whole item table, attached to both orders of a pair
    in one join (:func:`skuflow.operators.orders.attach_order_facts`)."""
    pairs = order_pairs(orders_x, orders)
    facts = ops.item_facts(items_x).select("brand", "order_id", "total_items_count", "nonnull")
    keep = ["customer_id", "first_order_date", "second_order_date", "days_between_first_and_second_order",
            "first_order_id", "second_order_id", "order_count", "second_is_subscription"]
    x = ops.attach_order_facts(pairs, ["brand", "email"], {1: "first_order_id", 2: "second_order_id"},
                               facts, keep, how="inner")
    f, s = F.col("role_1"), F.col("role_2")
    return x.where(f.isNotNull() & s.isNotNull()).select(
        "brand", "email", "customer_id", "first_order_date", "second_order_date",
        "days_between_first_and_second_order", "first_order_id", "second_order_id", "order_count",
        f["nonnull"]["product_name"].alias("first_product_name"),
        f["nonnull"]["product_variant"].alias("first_product_variant"),
        f["nonnull"]["product_quantity"].alias("first_product_quantity"),
        f["total_items_count"].alias("first_order_total_item_count"),
        F.col("second_is_subscription").alias("first_order_subscription"),
        s["nonnull"]["product_name"].alias("second_order_first_product_name"),
        (f["nonnull"]["same_product"] & (f["total_items_count"] > 1)).alias("bought_upsell_more_of_the_same"))
