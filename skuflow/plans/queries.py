"""Named queries over the test tables: one per operator of the inventory.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.operators import extract as X
from skuflow.operators import orders as ops
from skuflow.operators import retention as R
from skuflow.operators import stock_flow as SF
from skuflow.operators import sunset as SU
from skuflow.sources.fixtures import from_testdata, shop_from_testdata

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _src(spark, sf_dir):
    return from_testdata(spark, sf_dir)


def _ox(spark, sf_dir):
    return X.extract_orders(_src(spark, sf_dir))


def _ix(spark, sf_dir):
    return X.extract_items(_src(spark, sf_dir))


# ------------------------------------------------------------------ extracts
@query
def extract_orders(spark, sf_dir):
    return _ox(spark, sf_dir)


@query
def extract_items(spark, sf_dir):
    return _ix(spark, sf_dir)


@query
def extract_stock_lines(spark, sf_dir):
    return X.extract_stock_lines(_src(spark, sf_dir)).rows(*X.STOCK_COLUMNS)


# ------------------------------------------------------------ order blocks
@query
def orders_with_items(spark, sf_dir):
    return ops.orders_with_items(_ox(spark, sf_dir), _ix(spark, sf_dir))


@query
def orders_per_email(spark, sf_dir):
    return ops.orders_per_email(_ox(spark, sf_dir))


@query
def first_order_per_email(spark, sf_dir):
    """A1 + A2 + J7 as retention uses them (first order with items)."""
    ox, ix = _ox(spark, sf_dir), _ix(spark, sf_dir)
    counts = ops.item_order_counts(ix).withColumnRenamed("order_id", "id")
    firsts = ops.email_first_orders(ox.join(counts, ["brand", "id"], "left"),
                                    F.col("total_items_count").isNotNull())
    return firsts.select("brand", "email", "first_order_id", "first_order_date", "customer_id", "order_count")


@query
def item_rank(spark, sf_dir):
    return ops.ranked_items(_ix(spark, sf_dir), 2).select("brand", "order_id", "id", "product_name",
                                                          F.col("rn").cast("bigint").alias("rn"))


@query
def item_count_window(spark, sf_dir):
    return ops.item_order_counts(_ix(spark, sf_dir))


@query
def same_product_flag_retention(spark, sf_dir):
    ix = _ix(spark, sf_dir)
    return ops.same_product_by_id(ix, ops.first_two_items(ix)).select(
        "brand", "order_id", F.col("same_product").alias("bought_upsell_more_of_the_same"))


@query
def same_product_flag_sunset(spark, sf_dir):
    ix = _ix(spark, sf_dir)
    return ops.same_product_by_rows(ix, ops.first_nonnull_item(ix)).select(
        "brand", "order_id", F.col("same_product").alias("bought_upsell_more_of_the_same"))


@query
def second_order_by_email(spark, sf_dir):
    return ops.second_order_by_email(_ox(spark, sf_dir))


@query
def second_order_by_customer(spark, sf_dir):
    ox = _ox(spark, sf_dir)
    return ops.second_order_by_customer(ox.where(SU.non_subscription(ox)))


@query
def first_nonnull_item(spark, sf_dir):
    return ops.first_nonnull_item(_ix(spark, sf_dir))


@query
def days_between_orders(spark, sf_dir):
    return SU.order_pairs(_ox(spark, sf_dir)).select(
        "brand", "email", "first_order_id", "second_order_id", "days_between_first_and_second_order")


# ------------------------------------------------------------------ reports
@query
def retention_table(spark, sf_dir):
    return R.retention_table(_ox(spark, sf_dir), _ix(spark, sf_dir))


@query
def retention_missing_first_items(spark, sf_dir):
    return R.missing_first_items(R.retention_base(_ox(spark, sf_dir), _ix(spark, sf_dir)))


@query
def retention_null_audit(spark, sf_dir):
    return R.null_audit(R.retention_table(_ox(spark, sf_dir), _ix(spark, sf_dir)))


@query
def sunset_table(spark, sf_dir):
    return SU.sunset_table(_ox(spark, sf_dir), _ix(spark, sf_dir), X.valid_orders(_src(spark, sf_dir)))


# --------------------------------------------------------------- stock flow
def _ex(spark, sf_dir):
    return X.extract_stock_lines(_src(spark, sf_dir))


def _lines(spark, sf_dir):
    return SF.stock_lines(_ex(spark, sf_dir))


@query
def order_tiers(spark, sf_dir):
    return SF.order_tiers(_ex(spark, sf_dir)).rows()


@query
def tier_pick(spark, sf_dir):
    return SF.tier_pick(_ex(spark, sf_dir)).rows()


@query
def sku_resolve(spark, sf_dir):
    return SF.resolve_skus(_ex(spark, sf_dir)).rows(*SF.RESOLVED_COLUMNS)


@query
def line_dedup(spark, sf_dir):
    return _lines(spark, sf_dir).rows(*SF.RESOLVED_COLUMNS)


@query
def adjacency_reset(spark, sf_dir):
    return SF.flag_lines(_lines(spark, sf_dir)).rows(
        "brand", "order_id", "variant_id", "product_id", "unit_price", "units_total", "product_name",
        "variant_name", "final_sku", "reset")


@query
def bundle_explode(spark, sf_dir):
    return SF.explode_bundles(SF.flag_lines(_lines(spark, sf_dir))).rows(
        "brand", "order_id", "created_at", F.col("quantity").cast("int").alias("quantity"), "warehouse_sku",
        "bundle_sku")


@query
def bundle_flag(spark, sf_dir):
    return SF.order_summary(_lines(spark, sf_dir)).rows("brand", "order_id", "is_bundle")


@query
def bundle_sku_clean(spark, sf_dir):
    from skuflow.functions.sku import clean_bundle_sku
    b = SF.explode_bundles(SF.flag_lines(_lines(spark, sf_dir))).rows("brand", "order_id", "bundle_sku").where(F.col("bundle_sku").isNotNull())
    return b.select("brand", "order_id", "bundle_sku",
                    clean_bundle_sku("bundle_sku").alias("clean_bundle_sku")).distinct()


@query
def bundle_header_pick(spark, sf_dir):
    s = SF.order_summary(_lines(spark, sf_dir)).rows("brand", "order_id", "is_bundle", "header").where(F.col("is_bundle"))
    return s.select("brand", "order_id", F.col("header.bundle_variant_id").alias("bundle_variant_id"),
                    F.col("header.bundle_product_id").alias("bundle_product_id"),
                    F.col("header.bundle_quantity").cast("int").alias("bundle_quantity"))


def _non_bundle(spark, sf_dir):
    return SF.report_non_bundle(_lines(spark, sf_dir)).rows()


@query
def report_non_bundle(spark, sf_dir):
    return _non_bundle(spark, sf_dir)


@query
def report_only_bundle(spark, sf_dir):
    return SF.report_only_bundle(SF.order_summary(_lines(spark, sf_dir))).rows()


@query
def report_merged(spark, sf_dir):
    return SF.report_merged(_non_bundle(spark, sf_dir))


# ------------------------------------------------------- snapshot / publish
def _shop(spark, sf_dir):
    return shop_from_testdata(spark, sf_dir)


def _repeats(spark, sf_dir):
    from skuflow.sources.fixtures import with_repeats
    return with_repeats(_shop(spark, sf_dir))


@query
def snapshot_distinct(spark, sf_dir):
    """Rows per (brand, table) of a snapshot over sources with repeated rows."""
    from skuflow.sources.snapshot import snapshot_counts
    return snapshot_counts(_repeats(spark, sf_dir))


@query
def snapshot_rows(spark, sf_dir):
    """A staged table's rows: all columns as found, a nested one as text, repeats gone."""
    from skuflow.session import scratch_path
    from skuflow.sources.snapshot import new_run_id, stage
    src = _repeats(spark, sf_dir)
    path = stage(spark, src, scratch_path(spark, "snapshot-rows"), new_run_id())["sylius_product_translation"]
    return spark.read.parquet(path).select("brand", "id", "translatable_id", "locale", "name", "origin")


@query
def snapshot_listed(spark, sf_dir):
    """A whole run: the rows, as text, of the listed tables that no report reads, as staged."""
    from skuflow.session import scratch_path
    from skuflow.sources.snapshot import snapshot_and_promote
    from skuflow.sources.tables import LISTED_TABLES, SOURCE_TABLES
    root = scratch_path(spark, "snapshot-listed")
    run_id, _ = snapshot_and_promote(spark, _repeats(spark, sf_dir), root)
    out = None
    for n in LISTED_TABLES:
        if n not in SOURCE_TABLES:
            t = spark.read.parquet(f"{root}/{run_id}/{n}")
            text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in t.columns if c != "brand"])
            own = t.select("brand", F.lit(n).alias("table_name"), text.alias("row_text"))
            out = own if out is None else out.unionByName(own)
    return out


@query
def snapshot_gate(spark, sf_dir):
    from skuflow.sources.snapshot import expected_tables, gate, snapshot_counts
    return gate(snapshot_counts(_shop(spark, sf_dir)), expected_tables(spark))


def _without_pricing(spark, sf_dir, brand, src=None):
    """The sources after ``brand`` has lost its prices and price tiers."""
    gone = ("sylius_channel_pricing", "sylius_channel_pricing_item")
    return (src or _src(spark, sf_dir)).map(lambda n, t: t.where(F.col("brand") != brand) if n in gone else t)


@query
def snapshot_gate_failing(spark, sf_dir):
    """The gate when one brand's price tables are empty, and its and another's payments: those two do not pass."""
    from skuflow.sources.snapshot import expected_tables, gate, snapshot_counts
    src = _without_pricing(spark, sf_dir, "DEF", _shop(spark, sf_dir))
    src = src.map(lambda n, t: t.where(~F.col("brand").isin("DEF", "GHI")) if n == "sylius_payment" else t)
    return gate(snapshot_counts(src), expected_tables(spark))


@query
def snapshot_audit(spark, sf_dir):
    """A run that is given the report tables only, held against the ledger of all copied ones:
    the audit of what landed."""
    from skuflow.session import scratch_path
    from skuflow.sources import snapshot
    root, run_id = scratch_path(spark, "snapshot-audit"), "run-part"
    snapshot.open_run(spark, root, run_id)
    snapshot.stage(spark, _src(spark, sf_dir), root, run_id)
    return snapshot.audit(spark, root, run_id)


@query
def publish_roundtrip(spark, sf_dir):
    """Publish the non-bundle report to the shared folder and read it back."""
    from skuflow.session import scratch_path
    from skuflow.sources.sinks import publish_version, read_report
    path = scratch_path(spark, "publish-roundtrip")
    report = _non_bundle(spark, sf_dir)
    publish_version(report, path, "run-1", sort_within=["order_id"])
    return read_report(spark, path, report.schema)


@query
def publish_twice(spark, sf_dir):
    """The only-bundle report after a second run in which one brand lost its prices: that
    brand's rows are gone, the others' are those of the second run."""
    from skuflow.session import scratch_path
    from skuflow.sources.sinks import publish_version, read_report
    path = scratch_path(spark, "publish-twice")
    for run_id, src in (("run-1", _src(spark, sf_dir)), ("run-2", _without_pricing(spark, sf_dir, "ABC"))):
        report = SF.report_only_bundle(SF.order_summary(SF.stock_lines(X.extract_stock_lines(src)))).rows()
        publish_version(report, path, run_id)
    return read_report(spark, path, report.schema)


@query
def per_brand_exports(spark, sf_dir):
    """The per-brand export tables of the non-bundle report, under their names."""
    from skuflow.sources.sinks import per_brand_exports as exports
    out = None
    for name, df in exports(_non_bundle(spark, sf_dir), "non_bundle").items():
        own = df.select(F.lit(name).alias("table_name"), "order_id", "created_at", "quantity", "warehouse_sku")
        out = own if out is None else out.unionByName(own)
    return out


@query
def export_views(spark, sf_dir):
    """The rows behind the catalogue views of a published run: each brand's exports and the merged target."""
    import uuid

    from skuflow.brands import BRANDS, export_table_name
    from skuflow.session import scratch_path
    from skuflow.sources.sinks import publish_merged_view, publish_version, publish_views
    path, database = scratch_path(spark, "export-views"), f"views_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{path}/db'")
    report = _non_bundle(spark, sf_dir)
    publish_version(report, f"{path}/report_non_bundle", "run-1", sort_within=["order_id"])
    publish_views(spark, f"{path}/report_non_bundle", "non_bundle", report.schema, database=database)
    views = [export_table_name(b, "non_bundle") for b in BRANDS]
    views.append(publish_merged_view(spark, ["order_id", "created_at", "quantity", "warehouse_sku"], database=database).split(".")[1])
    out = None
    for v in views:
        own = spark.table(f"`{database}`.`{v}`").withColumn("view_name", F.lit(v))
        out = own if out is None else out.unionByName(own)
    return out


@query
def stage_counts(spark, sf_dir):
    """Rows per brand after each stage of the refresh."""
    from skuflow.plans.pipeline import build_reports
    return build_reports(_src(spark, sf_dir)).quality["stage_counts"]
