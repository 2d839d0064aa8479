"""C1 ``retention_table``: one row per (brand, email) that has an order with items.

Plan shape: the items become one row of facts per order (an aggregate per name, one
per order, and the second item's name from a top-2 window); the orders take their
facts in one join by order id; then one partial aggregate per email finds the first
order with items, its facts and the order count, and a top-2 window the second
order with its facts.  No order is looked up again by id.  No Python, no pairs, no
unbounded group collection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.operators import orders as ops

RETENTION_COLUMNS = (
    "brand", "email", "customer_id", "first_order_date", "order_count", "first_order_id",
    "first_product_name", "first_product_variant", "first_product_quantity",
    "first_order_total_item_count", "first_order_subscription", "bought_upsell_more_of_the_same",
    "bought_any_upsell", "second_item_product_name",
)


def retention_base(orders_x: DataFrame, items_x: DataFrame) -> DataFrame:
    """Retention rows before missing values are filled.

    Columns of :data:`RETENTION_COLUMNS`, with NULL where the reference has
    NaN, plus ``second_order_id``.
    """
    facts = ops.item_facts(items_x).select("brand", F.col("order_id").alias("id"), "total_items_count", "first")
    names = ops.second_item_names(items_x).withColumnRenamed("order_id", "id")
    second = ops.second_order_by_email(orders_x).select("brand", F.col("second_order_id").alias("id"), F.lit(True).alias("is_second"))
    key = ["brand", "id"]
    told = orders_x.join(facts.join(names, key, "left"), key, "left").join(second, key, "left")
    x = ops.email_first_orders(
        told, F.col("total_items_count").isNotNull(), F.struct("total_items_count", "first", "second_product_name"),
        (F.max(F.when(F.col("is_second"), F.struct(F.col("id").alias("id"), F.col("first.product_name").alias("name")))).alias("second"),))
    f, total = F.col("carried.first"), F.col("carried.total_items_count")
    in_first = F.coalesce(F.col("carried.second_product_name"), F.lit(""))
    return x.select(
        "brand", "email", "customer_id", "first_order_date", "order_count", "first_order_id",
        f["product_name"].alias("first_product_name"), f["product_variant"].alias("first_product_variant"),
        f["product_quantity"].alias("first_product_quantity"), total.alias("first_order_total_item_count"),
        F.col("first_is_subscription").alias("first_order_subscription"),
        ((total > 1) & f["same_product"]).alias("bought_upsell_more_of_the_same"),
        (total > 1).alias("bought_any_upsell"),
        F.when(in_first != "", in_first).otherwise(F.coalesce(F.col("second.name"), F.lit(""))).alias("second_item_product_name"),
        F.col("second.id").alias("second_order_id"))


def fill_retention(base: DataFrame) -> DataFrame:
    """Missing-value fill by type (P9) and final column order."""
    return base.select(
        "brand", "email", "customer_id", "first_order_date",
        F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count"),
        "first_order_id",
        F.coalesce("first_product_name", F.lit("")).alias("first_product_name"),
        F.coalesce("first_product_variant", F.lit("")).alias("first_product_variant"),
        F.coalesce("first_product_quantity", F.lit(0)).cast("int").alias("first_product_quantity"),
        F.coalesce("first_order_total_item_count", F.lit(0)).cast("bigint").alias("first_order_total_item_count"),
        F.coalesce("first_order_subscription", F.lit(False)).alias("first_order_subscription"),
        F.coalesce("bought_upsell_more_of_the_same", F.lit(False)).alias("bought_upsell_more_of_the_same"),
        F.coalesce("bought_any_upsell", F.lit(False)).alias("bought_any_upsell"),
        F.coalesce("second_item_product_name", F.lit("")).alias("second_item_product_name"),
    )


def retention_table(orders_x: DataFrame, items_x: DataFrame) -> DataFrame:
    """13 report columns plus ``brand``."""
    return fill_retention(retention_base(orders_x, items_x))


def missing_first_items(base: DataFrame) -> DataFrame:
    """P14 quality report: customers whose first order has no (or a blank)
    first product name.  brand, customer_id, first_order_id"""
    name = F.col("first_product_name")
    return base.where(name.isNull() | (name == "")).select("brand", "customer_id", "first_order_id")


def null_audit(df: DataFrame, columns=None) -> DataFrame:
    """P15 quality check: NULL count per column per brand, in one pass.

    brand, column_name, null_count
    """
    cols = [c for c in (columns or df.columns) if c != "brand"]
    counts = df.groupBy("brand").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.selectExpr("brand", f"stack({len(cols)}, {stacked}) as (column_name, null_count)")
