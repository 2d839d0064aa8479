"""Hot orders in the per-order stock-flow chain.

An order whose lines exceed ``spark.skuflow.orderRowsPerTask`` (default
1,000,000) is spread over ``n_salts = ceil(lines / limit)`` tasks; all others stay
whole.  Which orders are hot is part of each plan: one partial aggregate over
(brand, order_id) of the items' keys, broadcast -- there are at most
``total_lines / limit`` hot orders.  Rows are routed by it one by one into a pair of
plans (:class:`Routed`): ordinary orders take the co-located one (one shuffle by order,
window-attached facts), hot ones the salted one, and a report unites them at its end.
Without a hot order adaptive execution finds the broadcast empty and drops the salted
plan whole.

A hot line's salt hashes the columns that identify it for DISTINCT and for the
dedup (variant, prices, names), so identical lines and dedup groups never
straddle salts.  Order-level facts are partial aggregates per (order, salt),
combined per order, replicated to the order's salts and joined back on
(brand, order_id, salt).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


ROWS_CONF = "spark.skuflow.orderRowsPerTask"
DEFAULT_ROWS = 1_000_000
SALT_KEY = ["brand", "order_id", "salt"]
SALT_COLUMNS = ("variant_id", "unit_price", "units_total", "product_name", "variant_name")


@dataclass(frozen=True)
class Routed:
    """Rows of ordinary and of hot orders, each in its own plan; no order is in both."""

    ordinary: DataFrame
    hot: DataFrame

    def map(self, f: Callable[[DataFrame], DataFrame]) -> "Routed":
        return Routed(f(self.ordinary), f(self.hot))

    def rows(self, *columns) -> DataFrame:
        """All rows, with ``columns`` (default: those of the ordinary part)."""
        columns = columns or tuple(self.ordinary.columns)
        return self.ordinary.select(*columns).unionByName(self.hot.select(*columns))


def per_route(f: Callable[..., DataFrame]) -> Callable:
    """A step on per-order rows that takes a :class:`Routed` as well, part by part."""

    @wraps(f)
    def step(rows):
        return rows.map(f) if isinstance(rows, Routed) else f(rows)

    return step


def rows_per_task(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_CONF, str(DEFAULT_ROWS)))


def partitions(spark: SparkSession) -> int:
    """Explicit partition count of the salted line shuffle (explicit, so AQE
    keeps the line side and the replicated fact side aligned)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_orders(lines: DataFrame, limit: int) -> DataFrame:
    """Orders with more than ``limit`` rows: brand, order_id, n_salts.  At most
    ``rows / limit`` rows by construction."""
    known = lines.where(F.col("brand").isNotNull() & F.col("order_id").isNotNull())     # null keys never join
    counts = known.groupBy("brand", "order_id").agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > limit).select(
        "brand", "order_id", F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias("n_salts"))


def hot_table(lines: DataFrame) -> DataFrame:
    """:func:`hot_orders` at the session's limit, broadcast: at most ``rows / limit`` rows."""
    return F.broadcast(hot_orders(lines, rows_per_task(lines.sparkSession)))


def line_salt(n_salts: Column) -> Column:
    h = F.xxhash64(*[F.col(c) for c in SALT_COLUMNS])
    return F.pmod(h, n_salts.cast("long")).cast("int")


def assign_salts(lines: DataFrame) -> DataFrame:
    """Add the ``salt`` of each line of a hot order (``n_salts`` column required)."""
    return lines.withColumn("salt", line_salt(F.col("n_salts")))


def replicate(per_order: DataFrame) -> DataFrame:
    """One copy of each per-order row per salt of its order (``n_salts``
    column required), partitioned like the salted lines."""
    spark = per_order.sparkSession
    return (per_order.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("n_salts") - 1)))
            .repartition(partitions(spark), *SALT_KEY))


def is_salted(df: DataFrame) -> bool:
    """Whether ``df`` holds lines of hot orders, dealt by salt."""
    return "salt" in df.columns
