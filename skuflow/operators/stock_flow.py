"""Stock-flow reports (C3-C8): SKU resolution, line dedup, bundle explode,
bundle flag, the per-brand non-bundle / only-bundle reports and the merge.

Steps take lines of one kind, or both as a :class:`skuflow.operators.salting.Routed`
pair.  Lines of ordinary orders arrive hash-partitioned by (brand, order_id), those of
hot orders by (brand, order_id, salt), and stay there (see
:func:`skuflow.operators.extract.extract_stock_lines`): order-level facts (the tier
ladder, the summary) of a hot order are partial aggregates combined per order and
replicated back to its salts; only the line before a line is looked up by variant.
Per-order work is aggregates, a ``max_by`` dedup, one running-max window over
(value, tier) entries and one ``lag`` in line order; nothing collects an order's rows
into an array, and building a plan runs no job.

Pinned orders (the source job leaves these to unstable sorts):

* tier pick: the largest ``(count, sku)`` with ``count <= quantity``;
* dedup survivor: ``tier sku DESC NULLS LAST, tier count DESC NULLS LAST,
  original quantity DESC, pricing sku DESC NULLS LAST``;
* line order inside an order (:func:`line_order`, :func:`line_key`): tier SKU
  DESC NULLS LAST, then variant_id, product_id, unit_price, units_total,
  product_name, variant_name, final_sku, all ascending NULLS LAST.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.operators import salting as S
from skuflow.operators.salting import per_route
from skuflow.functions.sku import (clean_bundle_sku, has_pipe, nonzero_qty, override_quantity, sku_code,
                                   sku_priority, split_bundle)

SCP = "scp_promotion_warehouse_sku"
SCPI = "scpi_promotion_warehouse_sku"
KEY = ["brand", "order_id"]
DEDUP_KEYS = ["brand", "order_id", "unit_price", "units_total", "product_id", "variant_id",
              "product_name", "variant_name", "final_sku"]

RESOLVED_COLUMNS = ["brand", "order_id", "created_at", "updated_at", "payment_state", "quantity",
                    "original_quantity", "unit_price", "units_total", SCP, SCPI, "final_sku",
                    "applied_count", "tier_count", "mint_soft_sku", "product_id", "variant_id",
                    "product_name", "variant_name"]


# ------------------------------------------------------------------ tiers
@per_route
def order_tiers(ex: DataFrame) -> DataFrame:
    """The order's price tiers as rows (W9): every (count, tier SKU) of any line
    of the order, not only of the line's own variant.

    brand, order_id, tier_count, tier_sku
    """
    return (ex.where(F.col(SCPI).isNotNull() & F.col("count").isNotNull())
            .select(*KEY, F.col("count").alias("tier_count"), F.col(SCPI).alias("tier_sku"))
            .distinct())


@per_route
def tier_picks(ex: DataFrame) -> DataFrame:
    """For every line, the order's largest tier with ``count <= quantity``
    (J19, P17, O2): an as-of match inside the order.

    Lines and the order's tiers become entries ordered by value (tiers before
    lines on equal values); a running ``max(struct(count, sku))`` holds at
    each line the best reachable tier.  Linear, no pairs.  Co-located orders
    get their tier entries from the lines themselves (one ``inline`` pass).
    Salted orders get a ladder: the largest SKU of each distinct count -- all
    that can ever become the maximum -- built once by a partial aggregate and
    replicated to each salt, so the line rows stay in place.
    ``any_tier_sku`` (A14): the order has a line with a tier SKU.

    Returns ``ex`` with ``pick`` (struct count, sku; NULL when none) and
    ``any_tier_sku``.
    """
    tier = F.struct(F.col("count").alias("count"), F.col(SCPI).alias("sku"))
    no_tier = F.when(F.lit(False), tier)
    if S.is_salted(ex):
        key = S.SALT_KEY
        entries = S.replicate(tier_ladder(ex)).select(
            *key, F.col("count").alias("_v"), F.lit(0).alias("_kind"),
            F.when(F.col("count").isNotNull(), tier).alias("_tier"))
        lines = ex.withColumn("_v", F.col("quantity")).withColumn("_kind", F.lit(1)).withColumn("_tier", no_tier)
        x = lines.unionByName(entries, allowMissingColumns=True)
        any_tier = F.coalesce(F.max(F.col("_kind") == 0).over(Window.partitionBy(*key)), F.lit(False))
    else:
        key = KEY
        has_tier = F.col(SCPI).isNotNull() & F.col("count").isNotNull()
        entry_query = F.struct(F.lit(1).alias("_kind"), F.col("quantity").alias("_v"), no_tier.alias("_tier"))
        entry_tier = F.struct(F.lit(0).alias("_kind"), F.col("count").alias("_v"), tier.alias("_tier"))
        entries = F.filter(F.array(entry_query, F.when(has_tier, entry_tier)), lambda e: e.isNotNull())
        x = ex.select("*", F.inline(entries))
        any_tier = F.max(F.col(SCPI).isNotNull()).over(Window.partitionBy(*key))
    running = Window.partitionBy(*key).orderBy(F.col("_v").asc_nulls_first(), F.col("_kind")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (x.withColumn("pick", F.max("_tier").over(running))
            .withColumn("any_tier_sku", any_tier)
            .where(F.col("_kind") == 1).drop("_v", "_kind", "_tier"))


def tier_ladder(ex: DataFrame) -> DataFrame:
    """The tiers of salted orders that can be picked: per distinct count (a missing one
    included, for ``any_tier_sku``) the largest SKU; a row per order and count."""
    return (ex.where(F.col(SCPI).isNotNull()).groupBy(*KEY, "count")
            .agg(F.max(SCPI).alias(SCPI), F.max("n_salts").alias("n_salts")))


def _salt_cols(df: DataFrame) -> list[str]:
    return ["salt", "n_salts"] if S.is_salted(df) else []


@per_route
def tier_pick(ex: DataFrame) -> DataFrame:
    """Distinct (order, quantity) -> picked tier; brand, order_id, quantity,
    pick_count, pick_sku."""
    return (tier_picks(ex).select(*KEY, "quantity", F.col("pick.count").alias("pick_count"),
                                  F.col("pick.sku").alias("pick_sku")).distinct())


# -------------------------------------------------------------- resolution
@per_route
def resolve_skus(ex: DataFrame) -> DataFrame:
    """C3 per line (F1, F2, F12, A14):

    1. no pricing SKU and no tier SKU anywhere in the order -> the mint SKU,
       unsplit, quantity kept;
    2. else the picked tier's SKU (applied count = its count);
    3. else the pricing SKU, else the mint SKU;
    then the code before ``#`` and, when the line has its own non-empty tier
    SKU, a non-zero ``#QTY`` replaces the quantity.

    Columns :data:`RESOLVED_COLUMNS`.
    """
    x = tier_picks(ex)
    rule1 = F.col(SCP).isNull() & ~F.col("any_tier_sku")
    pick = F.col("pick")
    raw = F.when(pick.isNotNull(), pick["sku"]).otherwise(F.coalesce(F.col(SCP), F.col("mint_soft_sku")))
    return x.select(
        *KEY, "created_at", "updated_at", "payment_state",
        F.when(rule1, F.col("quantity")).otherwise(override_quantity(raw, F.col(SCPI), F.col("quantity")))
        .alias("quantity"),
        F.col("quantity").alias("original_quantity"),
        "unit_price", "units_total", SCP, SCPI,
        F.when(rule1, F.col("mint_soft_sku")).otherwise(sku_code(raw)).alias("final_sku"),
        F.when(~rule1 & pick.isNotNull(), pick["count"]).otherwise(F.lit(0)).alias("applied_count"),
        F.col("count").alias("tier_count"),
        "mint_soft_sku", "product_id", "variant_id", "product_name", "variant_name", *_salt_cols(x))


@per_route
def dedup_lines(resolved: DataFrame) -> DataFrame:
    """One line per (order, unit_price, units_total, product, variant,
    names, final_sku); NULL keys are equal.  The survivor has the greatest tier
    SKU (then the pinned order); it also decides the quantity.  A ``max_by``
    aggregate, partial on the map side (sort-based, since the kept row is a
    struct); no window over the order."""
    keys = DEDUP_KEYS + _salt_cols(resolved)      # salt is a function of the dedup keys
    rest = [c for c in RESOLVED_COLUMNS if c not in DEDUP_KEYS]
    rank = _ordered(F.col(SCPI).isNotNull(), F.col(SCPI), F.col("tier_count").isNotNull(), F.col("tier_count"),
                    F.col("original_quantity").isNotNull(), F.col("original_quantity"),
                    F.col(SCP).isNotNull(), F.col(SCP))
    agg = resolved.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_s"))
    return agg.select(*[F.col(c) if c in DEDUP_KEYS else F.col(f"_s.{c}").alias(c) for c in RESOLVED_COLUMNS],
                      *_salt_cols(resolved))


def _nl(c: str, default) -> list[Column]:
    col = F.col(c)
    return [col.isNull(), F.coalesce(col, F.lit(default))]


def _ordered(*cols: Column) -> Column:
    """An ascending sort key as a struct with positional field names."""
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])


LINE_TIES = {"variant_id": 0, "product_id": 0, "unit_price": 0, "units_total": 0, "product_name": "",
             "variant_name": "", "final_sku": ""}


def line_order() -> list[Column]:
    """Pinned line order inside an order, as sort columns (see module doc)."""
    return [F.col(SCPI).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in LINE_TIES]]


def _descending(text: Column) -> Column:
    """A string that sorts ascending as ``text`` sorts descending: its complemented
    hex digits, closed by a character above them (a prefix then comes later)."""
    return F.concat(F.translate(F.hex(text), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("Z"))


def line_key() -> Column:
    """:func:`line_order` as an ascending struct without NULL fields, for aggregates."""
    return _ordered(F.col(SCPI).isNull(), F.coalesce(_descending(F.col(SCPI)), F.lit("")),
                    *[k for c, default in LINE_TIES.items() for k in _nl(c, default)])


def bundle_source() -> Column:
    """The bundle string a line explodes: its tier SKU if it holds ``|``, else
    its pricing SKU if that does, else NULL."""
    return F.when(has_pipe(SCPI), F.col(SCPI)).when(has_pipe(SCP), F.col(SCP))


def _header() -> Column:
    return F.struct(F.col("created_at").alias("created_at"),
                    F.col("product_id").alias("bundle_product_id"),
                    F.col("product_name").alias("bundle_product_name"),
                    F.col("variant_id").alias("bundle_variant_id"),
                    F.col("variant_name").alias("bundle_variant_name"),
                    F.col("original_quantity").alias("bundle_quantity"),
                    clean_bundle_sku(bundle_source()).alias("bundle_sku"))


@per_route
def order_summary(lines: DataFrame) -> DataFrame:
    """Per-order facts over deduped lines, one row per order:

    * ``is_bundle``: some line's SKU holds ``|`` (A9, W8);
    * ``header``: the bundle header line, lowest SKU priority then line order
      (F10, W6, A12).

    Co-located orders: the first line of a window in header order.  Salted
    lines: a partial aggregate per (order, salt) in place, then one per
    order over those partials (a few rows per order).
    """
    if not S.is_salted(lines):
        x = lines.withColumn("_rn", F.row_number().over(header_order())).withColumn("is_bundle", F.bool_or(_piped()).over(Window.partitionBy(*KEY)))
        return x.where(F.col("_rn") == 1).select(*KEY, "is_bundle", _header().alias("header"))
    partial = lines.groupBy(*S.SALT_KEY).agg(F.bool_or(_piped()).alias("is_bundle"), _first_header().alias("kh"))
    return partial.groupBy(*KEY).agg(F.bool_or("is_bundle").alias("is_bundle"), F.min("kh").getField("h").alias("header"))


def _piped() -> Column:
    return has_pipe(SCPI) | has_pipe(SCP)


def _first_header() -> Column:
    """Aggregate: the header line (``h``) with its sort key (``k``)."""
    return F.min(F.struct(_ordered(sku_priority(SCP, SCPI), line_key()).alias("k"), _header().alias("h")))


def _bare() -> Column:
    return F.col(SCPI).isNull() & F.col(SCP).isNull()


def _flag_salted(lines: DataFrame) -> DataFrame:
    """``header``, ``is_bundle`` and ``after_sku`` (whether the line before a bare line has a SKU)
    for lines of hot orders.  Lines with a tier SKU come first in line order, the others by
    variant, so the line before is found among the variant's lines, else it is the last line of
    the variant before, else the last line with a tier SKU.  An order's variants are one row each
    before they meet; a task holds the distinct lines of one variant in one order."""
    variant, order = [*KEY, "variant_id"], Window.partitionBy(*KEY)
    no_tier = F.col(SCPI).isNull()
    facts = lines.groupBy(*variant).agg(F.bool_or(_piped()).alias("_piped"), _first_header().alias("_kh"), F.bool_or(~no_tier).alias("_tier"),
                                        F.max_by(~_bare(), F.when(no_tier, line_key())).alias("_sku"))
    before = F.last("_sku", ignorenulls=True).over(order.orderBy("variant_id").rowsBetween(Window.unboundedPreceding, -1))
    facts = facts.select(*variant, F.bool_or("_piped").over(order).alias("is_bundle"), F.min("_kh").over(order).getField("h").alias("header"),
                         F.coalesce(before, F.bool_or("_tier").over(order)).alias("_before"))
    own = F.lag(~_bare()).over(Window.partitionBy(*variant, no_tier).orderBy(*line_order()))
    return lines.withColumn("_own", own).join(facts, variant).withColumn("after_sku", F.coalesce("_own", "_before")).drop("_own", "_before")


@per_route
def flag_lines(lines: DataFrame) -> DataFrame:
    """Deduped lines with the :func:`order_summary` facts attached and the
    adjacency reset decided (W4): a line with neither SKU whose predecessor in
    the pinned line order has one takes the mint SKU.  An order may hold several.

    Co-located orders: facts and predecessor are windows over the existing
    (brand, order_id) partitioning.  Salted orders: :func:`_flag_salted`."""
    if S.is_salted(lines):
        x = _flag_salted(lines)
    else:
        w = Window.partitionBy(*KEY)
        x = lines.select("*", F.coalesce(F.lag(~_bare()).over(w.orderBy(*line_order())), F.lit(False)).alias("after_sku"),
                         F.first(_header()).over(header_order()).alias("header"),
                         F.bool_or(_piped()).over(w).alias("is_bundle"))
    return x.withColumn("reset", _bare() & F.col("after_sku")).drop("after_sku")


@per_route
def explode_bundles(flagged: DataFrame) -> DataFrame:
    """E1 + C4 + C5: one row per bundle part for lines whose SKU holds ``|``
    (code before ``#``; non-zero ``#QTY`` replaces the quantity; ``bundle_sku``
    = the whole string), the mint SKU for reset lines, the resolved SKU
    otherwise.  ``final_sku`` becomes ``warehouse_sku``."""
    src = bundle_source()
    x = flagged.withColumn("bundle_sku", src) \
        .withColumn("_part", F.explode_outer(split_bundle(src)))
    is_part = F.col("bundle_sku").isNotNull()
    return x.select(
        *KEY, "created_at",
        F.when(is_part, F.coalesce(nonzero_qty(F.col("_part")), F.col("quantity")))
        .otherwise(F.col("quantity")).alias("quantity"),
        F.when(is_part, sku_code(F.col("_part")))
        .when(F.col("reset"), F.col("mint_soft_sku"))
        .otherwise(F.col("final_sku")).alias("warehouse_sku"),
        "bundle_sku", "is_bundle", "original_quantity", "product_id", "variant_id", "product_name",
        "variant_name", SCP, SCPI)


# ---------------------------------------------------------------- reports
@per_route
def stock_lines(ex: DataFrame) -> DataFrame:
    """Resolved and deduped lines."""
    return dedup_lines(resolve_skus(ex))


@per_route
def report_non_bundle(lines: DataFrame) -> DataFrame:
    """C6 (U1): every exploded line -- bundle orders included.

    brand, order_id, created_at, quantity, warehouse_sku
    """
    return non_bundle_rows(flag_lines(lines))


@per_route
def non_bundle_rows(flagged: DataFrame) -> DataFrame:
    """C6 from lines that already carry their order facts (:func:`flag_lines`)."""
    return explode_bundles(flagged).select(
        *KEY, "created_at", F.col("quantity").cast("int").alias("quantity"), "warehouse_sku")


def header_order():
    """Window over an order's lines in the order that picks its bundle header."""
    return Window.partitionBy(*KEY).orderBy(sku_priority(SCP, SCPI), *line_order())


def bundle_headers(flagged: DataFrame) -> DataFrame:
    """C7 from lines that already carry their order facts: every line of a
    bundle order holds the same header, so one partial aggregate per order
    over the bundle orders' lines suffices."""
    return header_rows(flagged.where(F.col("is_bundle")).groupBy(*KEY).agg(F.any_value("header").alias("header")))


def header_rows(orders: DataFrame) -> DataFrame:
    """C7 from one row per bundle order with its ``header``."""
    h = F.col("header")
    return orders.select(*KEY, h["created_at"].alias("created_at"), h["bundle_product_id"].alias("bundle_product_id"),
                         h["bundle_product_name"].alias("bundle_product_name"),
                         h["bundle_variant_id"].alias("bundle_variant_id"),
                         h["bundle_variant_name"].alias("bundle_variant_name"),
                         h["bundle_quantity"].cast("int").alias("bundle_quantity"), h["bundle_sku"].alias("bundle_sku"))


@per_route
def report_only_bundle(summary: DataFrame) -> DataFrame:
    """One header row per bundle order, straight from the per-order
    summary.  ``bundle_sku`` is NULL when the header line is not itself a
    bundle line.

    brand, order_id, created_at, bundle_product_id, bundle_product_name,
    bundle_variant_id, bundle_variant_name, bundle_quantity, bundle_sku
    """
    return header_rows(summary.where(F.col("is_bundle")))


def report_merged(non_bundle: DataFrame) -> DataFrame:
    """C8 (U2): all brands' non-bundle rows in one table, without ``brand``."""
    return non_bundle.select("order_id", "created_at", "quantity", "warehouse_sku")
