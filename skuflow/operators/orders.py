"""Order- and item-level building blocks shared by the retention and sunset
reports (A1-A7, W1-W3, J5, J10, A8).

Skew notes.  Per-email and per-customer work is either a partial (map-side)
aggregate or a ``row_number() <= k`` filter, which Catalyst plans as a
``WindowGroupLimit`` on both sides of the shuffle: a hot email (a shared guest
address holding a large share of all orders) ships at most ``k`` rows per map
task, never its whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _min_where(cond: Column, value: Column) -> Column:
    return F.min(F.when(cond, value))


def item_order_counts(items_x: DataFrame) -> DataFrame:
    """Item rows per order (A3; translation fan-out rows count).

    brand, order_id, total_items_count
    """
    return items_x.groupBy("brand", "order_id").agg(F.count(F.lit(1)).alias("total_items_count"))


def orders_with_items(orders_x: DataFrame, items_x: DataFrame) -> DataFrame:
    """Orders having at least one extracted item."""
    keys = items_x.select("brand", F.col("order_id").alias("id")).distinct()
    return orders_x.join(keys, ["brand", "id"], "left_semi")


def orders_per_email(orders_x: DataFrame) -> DataFrame:
    """Orders per (brand, email); NULL emails are not a group (A2).

    brand, email, order_count
    """
    return (orders_x.where(F.col("email").isNotNull())
            .groupBy("brand", "email").agg(F.count(F.lit(1)).alias("order_count")))


def email_first_orders(orders: DataFrame, eligible: Column, carry: Column | None = None, also: tuple[Column, ...] = ()) -> DataFrame:
    """First eligible order per email, plus the email's total order count.

    One partial aggregate over all of the email's orders (A1 + A2 + J7):
    ``first_order_id`` = min id and ``first_order_date`` = min created_at, taken
    independently, over rows where ``eligible`` holds; ``customer_id`` and
    ``first_is_subscription`` come from the min-id eligible order;
    ``order_count`` counts all rows; ``carry`` is taken from the min-id eligible
    order as well, ``also`` are further aggregates over all rows.  Emails without an eligible order are dropped.

    brand, email, first_order_id, first_order_date, customer_id,
    first_is_subscription, order_count, carried (with ``carry``), ``also``
    """
    ok = F.coalesce(eligible, F.lit(False))
    eligible_id = F.when(ok, F.col("id"))
    agg = (orders.where(F.col("email").isNotNull())
           .groupBy("brand", "email")
           .agg(F.min(eligible_id).alias("first_order_id"),
                _min_where(ok, F.col("created_at")).alias("first_order_date"),
                F.min_by("customer_id", eligible_id).alias("customer_id"),
                F.min_by("is_subscription", eligible_id).alias("first_is_subscription"),
                F.count(F.lit(1)).alias("order_count"),
                *([] if carry is None else [F.min_by(carry, eligible_id).alias("carried")]), *also))
    return agg.where(F.col("first_order_id").isNotNull())


def nth_order(orders: DataFrame, key: str, order_by: list[Column], n: int) -> DataFrame:
    """The ``n``-th order per (brand, ``key``) (W2, W3, O8); groups with fewer
    orders give no row.  ``row_number() = n`` plans as a two-sided
    WindowGroupLimit, so each map task forwards at most ``n`` rows per key."""
    w = Window.partitionBy("brand", key).orderBy(*order_by)
    return (orders.where(F.col(key).isNotNull())
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == n).drop("_rn"))


def second_order_by_email(orders_x: DataFrame) -> DataFrame:
    """Second order per email by (created_at, id), item-less orders included.

    brand, email, second_order_id
    """
    return nth_order(orders_x, "email", [F.col("created_at").asc_nulls_last(), F.col("id").asc()], 2) \
        .select("brand", "email", F.col("id").alias("second_order_id"))


def second_order_by_customer(orders: DataFrame) -> DataFrame:
    """Second order per customer_id by id.

    brand, customer_id, second_order_id, second_order_date, second_is_subscription
    """
    return nth_order(orders, "customer_id", [F.col("id").asc()], 2).select(
        "brand", "customer_id", F.col("id").alias("second_order_id"),
        F.col("created_at").alias("second_order_date"),
        F.col("is_subscription").alias("second_is_subscription"))


def item_rank_order() -> list[Column]:
    """Item order inside an order: id, then name (NULLs last) for the
    translation fan-out rows that share an id (pinned tie-break)."""
    return [F.col("id").asc(), F.col("product_name").asc_nulls_last()]


def ranked_items(items_x: DataFrame, max_rank: int = 2) -> DataFrame:
    """Items numbered 1.. per order, keeping ranks <= ``max_rank``.

    brand, order_id, id, product_name, variant_name, quantity, rn
    """
    w = Window.partitionBy("brand", "order_id").orderBy(*item_rank_order())
    return (items_x.select("brand", "order_id", "id", "product_name", "variant_name", "quantity")
            .withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= max_rank))


def first_two_items(items_x: DataFrame) -> DataFrame:
    """First and second item of every order, one row per order.

    brand, order_id, first_id, first_product_name, first_product_variant,
    first_product_quantity, second_product_name
    """
    r = ranked_items(items_x, 2)
    first = F.when(F.col("rn") == 1, F.struct(
        F.col("id").alias("id"), F.col("product_name").alias("name"),
        F.col("variant_name").alias("variant"), F.col("quantity").alias("quantity")))
    agg = r.groupBy("brand", "order_id").agg(
        F.max(first).alias("_f"),
        F.max(F.when(F.col("rn") == 2, F.col("product_name"))).alias("second_product_name"))
    return agg.select("brand", "order_id",
                      F.col("_f.id").alias("first_id"), F.col("_f.name").alias("first_product_name"),
                      F.col("_f.variant").alias("first_product_variant"),
                      F.col("_f.quantity").alias("first_product_quantity"), "second_product_name")


def second_item_names(items_x: DataFrame) -> DataFrame:
    """Name of every order's second item (W1); at most two rows of an order leave a task.

    Rows equal in item order are told apart by the columns :func:`item_facts` reads, which changes
    no name: with the same columns of the items both read the same shuffles.

    brand, order_id, second_product_name
    """
    w = Window.partitionBy("brand", "order_id").orderBy(*item_rank_order(), "variant_name", "quantity")
    return (items_x.select("brand", "order_id", "id", "product_name", "variant_name", "quantity")
            .withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= 2)
            .where(F.col("rn") == 2).select("brand", "order_id", F.col("product_name").alias("second_product_name")))


def item_facts(items_x: DataFrame) -> DataFrame:
    """All per-order item facts of the two customer reports (A3, A6-A8, J10-J13, W1), from one pass
    over the items: an aggregate per (order, name), then one per order, both with partial
    aggregation, so that an order of any size moves as a row per name.

    brand, order_id, total_items_count, and as structs:
    ``first``: product_name, product_variant, product_quantity of the first item in item order,
    ``same_product`` (another item id has its name; NULL equals NULL);
    ``nonnull``: the first non-NULL product_name, product_variant, product_quantity, column by
    column, ``same_product`` (more than one row has that name).
    """
    idc, name = F.col("id"), F.col("product_name")
    names = items_x.groupBy("brand", "order_id", "product_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"),
        F.min(F.struct(idc, "variant_name", "quantity")).alias("row"),
        F.min(F.when(F.col("variant_name").isNotNull(), F.struct(idc, F.col("variant_name").alias("value")))).alias("v"),
        F.min(F.when(F.col("quantity").isNotNull(), F.struct(idc, F.col("quantity").alias("value")))).alias("q"))

    def first(at: Column, value: Column, there: Column) -> Column:
        """``value`` of the name whose row ``at`` comes first in item order, of those that have one."""
        return F.min(F.when(there, F.struct(at.alias("at"), name.isNull().alias("none"), name.alias("name"), value.alias("value"))))["value"]

    lo, row = F.col("lo"), F.col("row")
    own = F.struct(name.alias("product_name"), row["variant_name"].alias("product_variant"), row["quantity"].alias("product_quantity"),
                   (lo != F.col("hi")).alias("same_product"))
    out = names.groupBy("brand", "order_id").agg(
        F.sum("n").alias("total_items_count"), first(lo, own, F.lit(True)).alias("first"),
        first(lo, F.struct(name.alias("name"), F.col("n").alias("n")), name.isNotNull()).alias("named"),
        first(F.col("v.id"), F.col("v.value"), F.col("v").isNotNull()).alias("variant"),
        first(F.col("q.id"), F.col("q.value"), F.col("q").isNotNull()).alias("quantity"))
    return out.select("brand", "order_id", "total_items_count", "first",
                      F.struct(F.col("named.name").alias("product_name"), F.col("variant").alias("product_variant"),
                               F.col("quantity").alias("product_quantity"),
                               F.coalesce(F.col("named.n") > 1, F.lit(False)).alias("same_product")).alias("nonnull"))


def same_product_by_id(items_x: DataFrame, firsts: DataFrame, keep=()) -> DataFrame:
    """Retention's same-product test (J10, J11, W7): does the order hold another
    item id whose name equals the first item's name?  NULL equals NULL here.

    Aggregated per (order, name) as min(id) != max(id): the first item's own
    group contains it, so the group has another id exactly when the flag holds.
    No pairs are formed.  ``firsts``: brand, order_id, first_product_name and
    the ``keep`` columns, which are passed through.

    brand, order_id, first_product_name, *keep, same_product
    """
    # Names are keyed as (value or '', is NULL): the same groups as grouping by
    # the nullable name, and the join below uses exactly these keys, so it
    # reuses the aggregate's partitioning.
    def name_key(c):
        return [F.coalesce(F.col(c), F.lit("")).alias("_nk"), F.col(c).isNull().alias("_nn")]

    groups = items_x.groupBy("brand", "order_id", *name_key("product_name")).agg(
        (F.min("id") != F.max("id")).alias("same_product"))
    f = firsts.select("brand", "order_id", "first_product_name", *keep, *name_key("first_product_name"))
    return f.join(groups, ["brand", "order_id", "_nk", "_nn"], "left").select(
        "brand", "order_id", "first_product_name", *keep,
        F.coalesce(F.col("same_product"), F.lit(False)).alias("same_product"))


def first_nonnull_item(items_x: DataFrame) -> DataFrame:
    """Per order, the first non-NULL value of each item column in item order,
    taken column by column (A6), and the item-row count (A7).

    brand, order_id, first_product_name, first_product_variant,
    first_product_quantity, first_order_total_item_count
    """
    idc, pn = F.col("id"), F.col("product_name")

    def first_of(c: Column) -> Column:
        return F.min_by(c, F.when(c.isNotNull(), F.struct(idc, pn.isNull(), pn)))

    return items_x.groupBy("brand", "order_id").agg(
        first_of(pn).alias("first_product_name"),
        first_of(F.col("variant_name")).alias("first_product_variant"),
        first_of(F.col("quantity")).alias("first_product_quantity"),
        F.count(F.lit(1)).alias("first_order_total_item_count"))


def same_product_by_rows(items_x: DataFrame, firsts: DataFrame, keep=()) -> DataFrame:
    """Sunset's same-product test (A8): more than one item row of the order has
    the first product name (NULL never matches), and the order has more than
    one row.  ``firsts``: brand, order_id, first_product_name,
    first_order_total_item_count and the ``keep`` columns (passed through).

    brand, order_id, first_product_name, first_order_total_item_count, *keep,
    same_product
    """
    counts = items_x.where(F.col("product_name").isNotNull()) \
        .groupBy("brand", "order_id", "product_name").agg(F.count(F.lit(1)).alias("_n"))
    f = firsts.select("brand", "order_id", "first_product_name", "first_order_total_item_count", *keep)
    joined = f.join(counts.withColumnRenamed("product_name", "first_product_name"),
                    ["brand", "order_id", "first_product_name"], "left")
    flag = (F.col("first_order_total_item_count") > 1) & (F.coalesce(F.col("_n"), F.lit(0)) > 1)
    return joined.select("brand", "order_id", "first_product_name", "first_order_total_item_count", *keep,
                         flag.alias("same_product"))


def attach_order_facts(rows: DataFrame, key: list[str], roles: dict[int, str], facts: DataFrame,
                       keep: list[str], how: str = "left") -> DataFrame:
    """Join per-order ``facts`` (keyed brand, order_id) to ``rows`` for several
    order-id columns at once.

    Each row becomes one row per role (``roles``: role number -> order-id
    column), the facts are joined once on (brand, order_id), and the roles are
    folded back per ``key`` -- one pass over the facts instead of one join
    (and one copy of the facts plan) per role.  ``keep`` are the row columns
    to carry (equal across a row's roles).  ``how="inner"`` drops a role row
    whose order has no facts.

    Returns ``key``, ``keep`` and, per role r, a struct column ``role_<r>``
    holding the fact columns (NULL when the role found no facts).
    """
    fact_cols = [c for c in facts.columns if c not in ("brand", "order_id")]
    long = rows.select(*key, *keep, F.inline(F.array(*[
        F.struct(F.lit(r).alias("_role"), F.col(c).alias("order_id")) for r, c in roles.items()])))
    j = long.join(facts.withColumn("_hit", F.lit(True)), ["brand", "order_id"], how)
    per_role = [F.max(F.when((F.col("_role") == r) & F.col("_hit"),
                             F.struct(*[F.col(c) for c in fact_cols]))).alias(f"role_{r}") for r in roles]
    return j.groupBy(*key).agg(*[F.max(c).alias(c) for c in keep], *per_role)
