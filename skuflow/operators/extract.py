"""Extracts (S8, J1-J4, P1-P5, P7, A10): the three row sets the reports start from.

While the catalogue (variant, product, translation, pricing, tiers) is small, the items meet
it one table at a time and the optimiser broadcasts each.  The optimiser knows a table by the
size of its compressed files, which says little about the rows in memory, so a table of more
than :data:`skuflow.sources.tables.SMALL` is joined by sort-merge whatever it believes: the
catalogue is joined by itself first, and the items meet it once, by variant.  No job is run to
find out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.functions.sku import effective_name
from skuflow.operators import salting as S
from skuflow.sources.tables import Sources, is_small, joinable

# Order states and payment states the reports keep.
VALID_STATES = ("fulfilled", "new")
RETENTION_PAYMENT_STATES = ("paid", "partially_refunded", "refunded")
STOCK_PAYMENT_STATES = ("paid", "partially_paid", "partially_refunded", "refunded")


def valid_orders(src: Sources) -> DataFrame:
    """Valid paid orders, without their customers.

    brand, id, customer_id, created_at, state, is_subscription, created_from_order_id
    """
    return (src.sylius_order
            .where(F.col("state").isin(*VALID_STATES)
                   & F.col("payment_state").isin(*RETENTION_PAYMENT_STATES)
                   & (F.col("total") > 0))
            .select("brand", "id", "customer_id", "created_at", "state", "is_subscription",
                    "created_from_order_id"))


def extract_orders(src: Sources) -> DataFrame:
    """:func:`valid_orders` with the customer's email (``orders_x``).

    brand, id, customer_id, created_at, state, is_subscription,
    created_from_order_id, email
    """
    o = valid_orders(src)
    c = src.sylius_customer.select("brand", F.col("id").alias("customer_id"), "email")
    return o.join(joinable(c), ["brand", "customer_id"], "left").select(
        "brand", "id", "customer_id", "created_at", "state", "is_subscription",
        "created_from_order_id", "email")


def with_products(items: DataFrame, src: Sources) -> DataFrame:
    """``items`` (brand, variant_id, ...) with their product_id and each of its translations'
    names (translation_name); a product with several yields several rows (kept)."""
    v = src.sylius_product_variant.select("brand", F.col("id").alias("variant_id"), "product_id")
    p = src.sylius_product.select("brand", F.col("id").alias("product_id"))
    t = src.sylius_product_translation.select(
        "brand", F.col("translatable_id").alias("product_id"), F.col("name").alias("translation_name"))
    if not is_small(v, p, t):
        catalogue = v.join(p.hint("merge"), ["brand", "product_id"]).join(t.hint("merge"), ["brand", "product_id"], "left")
        return items.join(catalogue.hint("merge"), ["brand", "variant_id"])
    return items.join(v, ["brand", "variant_id"]).join(p, ["brand", "product_id"]).join(t, ["brand", "product_id"], "left")


def extract_items(src: Sources) -> DataFrame:
    """Order items with their product (``items_x``).

    brand, order_id, id, product_name, variant_name, quantity, product_id
    """
    items = src.sylius_order_item.select("brand", "order_id", "id", "variant_id", "product_name",
                                         "variant_name", "quantity")
    return with_products(items, src).select(
        "brand", "order_id", "id",
        effective_name("product_name", "translation_name").alias("product_name"),
        "variant_name", "quantity", "product_id")


def _pricings(src: Sources) -> tuple[DataFrame, DataFrame]:
    cp = src.sylius_channel_pricing.select(
        "brand", F.col("product_variant_id").alias("variant_id"), F.col("id").alias("channel_pricing_id"),
        F.col("promotion_warehouse_sku").alias("scp_promotion_warehouse_sku"))
    cpi = src.sylius_channel_pricing_item.select(
        "brand", "channel_pricing_id",
        F.col("promotion_warehouse_sku").alias("scpi_promotion_warehouse_sku"), "count")
    return cp, cpi


def with_pricings(items: DataFrame, src: Sources) -> DataFrame:
    """``items`` (brand, variant_id, ...), one row per pricing of the variant and price tier of
    the pricing, one at least."""
    cp, cpi = _pricings(src)
    if not is_small(cp, cpi):
        prices = cp.join(cpi.hint("merge"), ["brand", "channel_pricing_id"], "left")
        return items.join(prices.hint("merge"), ["brand", "variant_id"], "left").drop("channel_pricing_id")
    return items.join(cp, ["brand", "variant_id"], "left").join(cpi, ["brand", "channel_pricing_id"], "left").drop("channel_pricing_id")


def with_prices(items: DataFrame, src: Sources) -> DataFrame:
    """:func:`with_pricings` of the items of products with a mint SKU: product_id, mint_soft_sku."""
    v, p = _minted(src)
    if not small_prices(src):
        catalogue = with_pricings(v.join(p.hint("merge"), ["brand", "product_id"]), src)
        return items.join(catalogue.hint("merge"), ["brand", "variant_id"])
    return with_pricings(items.join(v, ["brand", "variant_id"]).join(p, ["brand", "product_id"]), src)


def _minted(src: Sources) -> tuple[DataFrame, DataFrame]:
    v = src.sylius_product_variant.select("brand", F.col("id").alias("variant_id"), "product_id")
    p = (src.sylius_product.where(F.col("mint_soft_sku").isNotNull())
         .select("brand", F.col("id").alias("product_id"), "mint_soft_sku"))
    return v, p


def small_prices(src: Sources) -> bool:
    """Whether :func:`with_prices` may leave its joins to the optimiser."""
    return is_small(*_minted(src), *_pricings(src))


STOCK_COLUMNS = ("brand", "order_id", "created_at", "updated_at", "payment_state", "quantity",
                 "unit_price", "units_total", "product_id", "variant_id", "product_name", "variant_name",
                 "scp_promotion_warehouse_sku", "scpi_promotion_warehouse_sku", "count", "mint_soft_sku")


def hot_orders(src: Sources) -> DataFrame:
    """Orders with more stock lines than one task should hold (brand, order_id, n_salts); a line
    counts once per price tier of its variant.  Lazy: part of the report's plan."""
    items = src.sylius_order_item.select("brand", "order_id", "variant_id")
    return S.hot_table(with_pricings(items, src))


def extract_stock_lines(src: Sources) -> S.Routed:
    """Distinct stock lines (``ex``): one row per (item x pricing tier), paid
    orders, products with a mint SKU; the item id is not kept, so identical
    lines collapse.  Columns :data:`STOCK_COLUMNS` (the hot part has ``salt``
    and ``n_salts`` besides).

    Every item takes one of two ways, by its order (:mod:`skuflow.operators.salting`).
    Ordinary ones move once, hash-partitioned by (brand, order_id) -- the narrow
    rows, before a small catalogue fans them out per tier; a large one they meet by variant
    before -- and every per-order step reuses that.  Those of hot orders meet their orders by broadcast, are collapsed
    (on the map side, then over all tasks) and dealt by (brand, order_id, salt).
    """
    spark = src.sylius_order_item.sparkSession
    items = src.sylius_order_item.select("brand", "order_id", "variant_id", "product_name", "variant_name",
                                         "quantity", "unit_price", "units_total")
    o = (src.sylius_order.where(F.col("payment_state").isin(*STOCK_PAYMENT_STATES))
         .select("brand", F.col("id").alias("order_id"), "created_at", "updated_at", "payment_state"))
    hot = hot_orders(src)
    key = ["brand", "order_id"]
    ordinary = items.join(hot, key, "left").where(F.col("n_salts").isNull()).drop("n_salts")
    if small_prices(src):
        ordinary = with_prices(ordinary.repartition(*key), src)
    else:                                                    # a large catalogue deals them by variant first
        ordinary = with_prices(ordinary, src).repartition(*key)
    ordinary = ordinary.join(joinable(o), key).select(*STOCK_COLUMNS).distinct()
    # a hot order may be one line many times over: DISTINCT before the salts
    hot_o = F.broadcast(o.join(hot, key))                    # at most as many rows as hot orders
    salted = S.assign_salts(items.join(hot_o, key).distinct()).repartition(S.partitions(spark), *S.SALT_KEY)
    salted = with_prices(salted, src).select(*STOCK_COLUMNS, "salt", "n_salts").distinct()
    return S.Routed(ordinary, salted)
