"""Source tables derived from the driver's TPC-H-like test tables.

The shop tables are mapped onto ``customer``, ``orders``, ``lineitem`` and
``part`` by fixed rules (FIXTURES.md section 2), so every report's work grows
with the test tables.  The brand of a customer/order is ``custkey % 5``; the
catalog tables exist once per brand (an ``explode`` of the brand list, no join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuflow.brands import BRANDS
from skuflow.sources.tables import SMALL, Sources, joinable

# Fixed values of the fixture mapping (FIXTURES.md section 2).
EMAIL_NULL_MOD = 97          # c_custkey % 97 = 0 -> no email
EMAIL_SHARED_MOD = 50        # c_custkey % 50 = 35 -> email of c_custkey - 5
EMAIL_SHARED_REM = 35
SECONDS_MULT = 7919          # created_at = orderdate + (orderkey * 7919 % 86400) s
AWAITING_MOD = 11            # orderkey % 11 = 0 -> awaiting_payment
ZERO_TOTAL_MOD = 23          # orderkey % 23 = 0 -> total 0
SUBSCRIPTION_MOD = 4         # orderkey % 4 = 0 -> subscription
CREATED_FROM_MOD = 6         # orderkey % 6 = 5 -> created from orderkey - 1
ITEM_ID_MULT = 100           # item id = orderkey * 100 + line rank
NAME_NULL_MOD = 11           # partkey % 11 = 0 -> item product_name NULL
NAME_EMPTY_MOD = 7           # partkey % 7 = 0 -> item product_name ''
MINT_NULL_MOD = 26           # partkey % 26 = 0 -> mint_soft_sku NULL
MINT_QTY_MOD = 34            # partkey % 34 = 0 -> 'MS-<id>#2'
TRANSLATION_NULL_MOD = 22    # partkey % 22 = 0 -> translation name NULL
TRANSLATION_DE_MOD = 38      # partkey % 38 = 0 -> second translation 'de <name>'
TRANSLATION_FR_MOD = 46      # p_partkey % 46 = 0 -> a 'fr' row with the English name
PRICING_MOD, PRICING_REM = 5, 1          # channel pricing for partkey % 5 = 1
PRICING_ITEM_MOD, PRICING_ITEM_REM = 10, 1  # pricing items for partkey % 10 = 1
TIER_COUNTS = {1: 2, 2: 10, 3: 25}       # tier t -> count


def brand_of(key: Column) -> Column:
    expr = F.when(key % 5 == 0, F.lit(BRANDS[0]))
    for i, b in enumerate(BRANDS[1:], start=1):
        expr = expr.when(key % 5 == i, F.lit(b))
    return expr


def _s(c: Column) -> Column:
    return c.cast("string")


def _per_brand(df: DataFrame) -> DataFrame:
    """One copy of a catalog row per brand (a generator, not a join)."""
    return df.withColumn("brand", F.explode(F.array(*[F.lit(b) for b in BRANDS])))


def customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    email_key = F.when(k % EMAIL_SHARED_MOD == EMAIL_SHARED_REM, k - 5).otherwise(k)
    email = F.when(k % EMAIL_NULL_MOD == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("u"), _s(email_key), F.lit("@example.com")))
    return customer.select(brand_of(k).alias("brand"), k.alias("id"), email.alias("email"))


def orders(orders_t: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    secs = (k * SECONDS_MULT) % 86400
    prio = F.col("o_orderpriority")
    state = (F.when(F.col("o_orderstatus") == "F", "fulfilled")
             .when(F.col("o_orderstatus") == "O", "new").otherwise("cancelled"))
    payment = (F.when(k % AWAITING_MOD == 0, "awaiting_payment")
               .when(prio.like("2%"), "partially_refunded")
               .when(prio.like("3%"), "refunded")
               .when(prio.like("4%"), "partially_paid")
               .otherwise("paid"))
    total = F.when(k % ZERO_TOTAL_MOD == 0, F.lit(0).cast("bigint")).otherwise(
        F.round(F.col("o_totalprice") * 100).cast("bigint"))
    return orders_t.select(
        brand_of(F.col("o_custkey")).alias("brand"),
        k.alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.timestamp_add("SECOND", secs, F.col("o_orderdate")).alias("created_at"),
        F.timestamp_add("DAY", F.lit(1), F.col("o_orderdate")).alias("updated_at"),
        state.alias("state"),
        payment.alias("payment_state"),
        total.alias("total"),
        (k % SUBSCRIPTION_MOD == 0).alias("is_subscription"),
        F.when(k % CREATED_FROM_MOD == 5, k - 1).otherwise(F.lit(None).cast("bigint")).alias("created_from_order_id"),
    )


def order_items(lineitem: DataFrame, part: DataFrame, orders_t: DataFrame) -> DataFrame:
    line_rank = Window.partitionBy("l_orderkey").orderBy(
        *[F.col(c).asc_nulls_first() for c in
          ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
           "l_shipdate", "l_discount", "l_tax")])
    pk = F.col("l_partkey")
    unit_price = F.round(F.col("p_retailprice") * 100).cast("bigint")
    qty = F.col("l_quantity").cast("int")
    name = (F.when(pk % NAME_NULL_MOD == 0, F.lit(None).cast("string"))
            .when(pk % NAME_EMPTY_MOD == 0, F.lit("")).otherwise(F.col("p_name")))
    brands = orders_t.select(F.col("o_orderkey").alias("l_orderkey"), brand_of(F.col("o_custkey")).alias("brand"))
    lines = (lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                             "l_extendedprice", "l_shipdate", "l_discount", "l_tax")
             .join(joinable(part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_retailprice"), SMALL), "l_partkey")
             .join(joinable(brands), "l_orderkey"))
    return lines.select(
        "brand",
        (F.col("l_orderkey") * ITEM_ID_MULT + F.row_number().over(line_rank)).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        pk.alias("variant_id"),
        name.alias("product_name"),
        F.col("p_type").alias("variant_name"),
        qty.alias("quantity"),
        unit_price.alias("unit_price"),
        (unit_price * qty).alias("units_total"),
    )


def product_variants(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    return _per_brand(part.select(pk.alias("id"), (pk - pk % 2).alias("product_id"))).select("brand", "id", "product_id")


def products(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    mint = (F.when(pk % MINT_NULL_MOD == 0, F.lit(None).cast("string"))
            .when(pk % MINT_QTY_MOD == 0, F.concat(F.lit("MS-"), _s(pk), F.lit("#2")))
            .otherwise(F.concat(F.lit("MS-"), _s(pk))))
    return _per_brand(part.where(pk % 2 == 0).select(pk.alias("id"), mint.alias("mint_soft_sku"))) \
        .select("brand", "id", "mint_soft_sku")


def product_translations(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    first = part.where(pk % 2 == 0).select(
        (pk * 10).alias("id"), pk.alias("translatable_id"), F.lit("en").alias("locale"),
        F.when(pk % TRANSLATION_NULL_MOD == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("name"))
    second = part.where(pk % TRANSLATION_DE_MOD == 0).select(
        (pk * 10 + 1).alias("id"), pk.alias("translatable_id"), F.lit("de").alias("locale"),
        F.concat(F.lit("de "), F.col("p_name")).alias("name"))
    same = part.where(pk % TRANSLATION_FR_MOD == 0).select(       # a second locale of one name
        (pk * 10 + 2).alias("id"), pk.alias("translatable_id"), F.lit("fr").alias("locale"), F.col("p_name").alias("name"))
    return _per_brand(first.unionByName(second).unionByName(same)).select("brand", "id", "translatable_id", "locale", "name")


def channel_pricings(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    ids = _s(pk)
    sku = (F.when(pk % 6 == 0, F.concat(F.lit("SC-"), ids))
           .when(pk % 6 == 1, F.concat(F.lit("SC-"), ids, F.lit("#3")))
           .when(pk % 6 == 2, F.concat(F.lit("BA-"), ids, F.lit("#4|BB#0")))
           .otherwise(F.lit(None).cast("string")))
    return _per_brand(part.where(pk % PRICING_MOD == PRICING_REM).select(
        pk.alias("id"), pk.alias("product_variant_id"), sku.alias("promotion_warehouse_sku"))) \
        .select("brand", "id", "product_variant_id", "promotion_warehouse_sku")


def channel_pricing_items(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    tiers = part.where(pk % PRICING_ITEM_MOD == PRICING_ITEM_REM).select(
        pk, F.explode(F.array(*[F.lit(t) for t in sorted(TIER_COUNTS)])).alias("t"))
    t = F.col("t")
    item_id = pk * 10 + t
    ids = _s(item_id)
    sel = (pk + t) % 6
    sku = (F.when(sel == 0, F.lit(None).cast("string"))
           .when(sel == 1, F.concat(F.lit("PI-"), ids, F.lit("#5")))
           .when(sel == 2, F.concat(F.lit("PA-"), ids, F.lit("#2|PB#0|PC")))
           .when(sel == 3, F.concat(F.lit("PX-"), ids, F.lit("#x")))
           .otherwise(F.concat(F.lit("PI-"), ids, F.lit("-"), _s(t))))
    count = F.when(t == 1, TIER_COUNTS[1]).when(t == 2, TIER_COUNTS[2]).otherwise(TIER_COUNTS[3]).cast("int")
    return _per_brand(tiers.select(item_id.alias("id"), pk.alias("channel_pricing_id"),
                                   sku.alias("promotion_warehouse_sku"), count.alias("count"))) \
        .select("brand", "id", "channel_pricing_id", "promotion_warehouse_sku", "count")


# ------------------------------------------------- listed tables no report reads
def item_costs(part: DataFrame, divisor: int, factor: int) -> DataFrame:
    """Handling cost of a product's first or second item."""
    pk = F.col("p_partkey")
    cost = F.round(F.col("p_retailprice") * factor).cast("bigint")
    return _per_brand(part.where(pk % divisor == 0).select(pk.alias("id"), (pk - pk % 2).alias("product_id"), cost.alias("cost"))) \
        .select("brand", "id", "product_id", "cost")


def product_costs(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    return _per_brand(part.where(pk % 2 == 0).select(pk.alias("id"), pk.alias("product_id"), F.col("p_brand").alias("supplier"),
                                                     F.round(F.col("p_retailprice") * 60).cast("bigint").alias("cost"))) \
        .select("brand", "id", "product_id", "supplier", "cost")


def order_tasks(orders_t: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders_t.where(k % 13 == 0).select(brand_of(F.col("o_custkey")).alias("brand"), k.alias("id"), k.alias("order_id"),
                                              F.col("o_orderpriority").alias("task"), (k % 2 == 0).alias("done"))


def order_action_history(orders_t: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    actions = F.when(k % 3 == 0, F.array(F.lit("placed"), F.lit("shipped"))).otherwise(F.array(F.lit("placed")))
    out = orders_t.select(brand_of(F.col("o_custkey")).alias("brand"), k.alias("order_id"), F.col("o_orderdate").alias("performed_at"),
                          F.posexplode(actions).alias("at", "action"))
    return out.select("brand", (F.col("order_id") * 10 + F.col("at")).alias("id"), "order_id", "action", "performed_at")


def admin_users(supplier: DataFrame) -> DataFrame:
    return _per_brand(supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("username"), F.col("s_nationkey").cast("bigint").alias("role_id"))) \
        .select("brand", "id", "username", "role_id")


def promotion_coupons(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.where(k % 4 != 0).select(brand_of(k).alias("brand"), k.alias("id"), F.concat(F.lit("C-"), F.col("c_mktsegment"), F.lit("-"), _s(k)).alias("code"),
                                             F.when(k % 7 == 0, F.lit(None).cast("int")).otherwise((k % 5).cast("int")).alias("used"))


def payments(orders_t: DataFrame) -> DataFrame:
    """With a nested column: a snapshot lands it as text."""
    k = F.col("o_orderkey")
    return orders_t.select(brand_of(F.col("o_custkey")).alias("brand"), k.alias("id"), k.alias("order_id"),
                           F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount"),
                           F.struct(k.alias("order"), F.col("o_orderstatus").alias("status")).alias("details"))


def administration_roles(nation: DataFrame) -> DataFrame:
    return _per_brand(nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("code"), F.col("n_regionkey").alias("level"))) \
        .select("brand", "id", "code", "level")


# The columns read of each test table (stated, so that no file is opened to build a plan).
TEST_SCHEMAS = {
    "customer": "c_custkey bigint, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TEST_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def from_testdata(spark: SparkSession, sf_dir: str) -> Sources:
    """The eight shop tables over ``sf_dir``'s parquet files (lazy)."""
    customer = read_table(spark, sf_dir, "customer")
    orders_t = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    return Sources(
        sylius_order=orders(orders_t),
        sylius_customer=customers(customer),
        sylius_order_item=order_items(lineitem, part, orders_t),
        sylius_product_variant=product_variants(part),
        sylius_product=products(part),
        sylius_product_translation=product_translations(part),
        sylius_channel_pricing=channel_pricings(part),
        sylius_channel_pricing_item=channel_pricing_items(part),
    )


def shop_from_testdata(spark: SparkSession, sf_dir: str) -> Sources:
    """:func:`from_testdata` and the listed tables that no report reads: everything a refresh copies."""
    part, orders_t = read_table(spark, sf_dir, "part"), read_table(spark, sf_dir, "orders")
    return Sources.of({
        **from_testdata(spark, sf_dir).as_dict(),
        "processing_first_item_cost": item_costs(part, 1, 10),
        "processing_second_item_cost": item_costs(part, 3, 5),
        "product_cost": product_costs(part),
        "sylius_order_tasks": order_tasks(orders_t),
        "sylius_order_action_history": order_action_history(orders_t),
        "sylius_admin_user": admin_users(read_table(spark, sf_dir, "supplier")),
        "sylius_promotion_coupon": promotion_coupons(read_table(spark, sf_dir, "customer")),
        "sylius_payment": payments(orders_t),
        "sylius_rbac_administration_role": administration_roles(read_table(spark, sf_dir, "nation")),
    })


def with_repeats(src: Sources) -> Sources:
    """The sources as a shop database may hold them: every fifth row twice, and
    a nested column on the translations (what a snapshot must normalise)."""
    def spoil(name: str, t: DataFrame) -> DataFrame:
        if name == "sylius_product_translation":
            t = t.withColumn("origin", F.struct(F.col("id").alias("id"), F.col("locale").alias("locale")))
        return t.unionByName(t.where(F.col("id") % 5 == 0))

    return src.map(spoil)
