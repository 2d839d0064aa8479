"""The brand-keyed source tables the reports read.

``Sources`` is the unit every operator takes: the eight tables the reports
query, each with a ``brand`` column, and whatever else a snapshot copies.  They come either from a promoted snapshot
(:func:`skuflow.sources.snapshot.read_live`) or from the driver's test tables
(:func:`skuflow.sources.fixtures.from_testdata`).
"""

from __future__ import annotations

import contextlib
import io
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Tables the report jobs query (the snapshot also copies them).
SOURCE_TABLES = (
    "sylius_order",
    "sylius_customer",
    "sylius_order_item",
    "sylius_product_variant",
    "sylius_product",
    "sylius_product_translation",
    "sylius_channel_pricing",
    "sylius_channel_pricing_item",
)

# The tables a brand's refresh copies besides its orders.
LISTED_TABLES = (
    "processing_first_item_cost",
    "processing_second_item_cost",
    "product_cost",
    "sylius_product_variant",
    "sylius_product",
    "sylius_order_tasks",
    "sylius_order_item",
    "sylius_order_action_history",
    "sylius_admin_user",
    "sylius_customer",
    "sylius_promotion_coupon",
    "sylius_payment",
    "sylius_rbac_administration_role",
    "sylius_product_translation",
    "sylius_channel_pricing",
    "sylius_channel_pricing_item",
)

# Everything a refresh copies.
COPIED_TABLES = (*LISTED_TABLES, "sylius_order")

S, L, I, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampNTZType()


def _schema(*cols):
    return T.StructType([T.StructField("brand", S, False)] + [T.StructField(n, t, True) for n, t in cols])


# Columns read by the report jobs, with their types.
EXPECTED_SCHEMAS = {
    "sylius_order": _schema(("id", L), ("customer_id", L), ("created_at", TS), ("updated_at", TS),
                            ("state", S), ("payment_state", S), ("total", L), ("is_subscription", B),
                            ("created_from_order_id", L)),
    "sylius_customer": _schema(("id", L), ("email", S)),
    "sylius_order_item": _schema(("id", L), ("order_id", L), ("variant_id", L), ("product_name", S),
                                 ("variant_name", S), ("quantity", I), ("unit_price", L), ("units_total", L)),
    "sylius_product_variant": _schema(("id", L), ("product_id", L)),
    "sylius_product": _schema(("id", L), ("mint_soft_sku", S)),
    "sylius_product_translation": _schema(("translatable_id", L), ("name", S)),
    "sylius_channel_pricing": _schema(("id", L), ("product_variant_id", L), ("promotion_warehouse_sku", S)),
    "sylius_channel_pricing_item": _schema(("id", L), ("channel_pricing_id", L),
                                           ("promotion_warehouse_sku", S), ("count", I)),
}


@dataclass(frozen=True)
class Sources:
    sylius_order: DataFrame
    sylius_customer: DataFrame
    sylius_order_item: DataFrame
    sylius_product_variant: DataFrame
    sylius_product: DataFrame
    sylius_product_translation: DataFrame
    sylius_channel_pricing: DataFrame
    sylius_channel_pricing_item: DataFrame
    others: dict[str, DataFrame] = field(default_factory=dict)    # listed tables no report reads

    @classmethod
    def of(cls, tables: dict[str, DataFrame]) -> "Sources":
        """From name -> table; names beyond the eight must be listed ones."""
        others = {n: t for n, t in tables.items() if n not in SOURCE_TABLES}
        if unknown := set(others) - set(LISTED_TABLES):
            raise ValueError(f"not a listed table: {', '.join(sorted(unknown))}")
        return cls(**{n: tables[n] for n in SOURCE_TABLES}, others=others)

    def as_dict(self) -> dict[str, DataFrame]:
        return {**{n: getattr(self, n) for n in SOURCE_TABLES}, **self.others}

    def table(self, name: str) -> DataFrame:
        return self.as_dict()[name]

    def map(self, f) -> "Sources":
        return Sources.of({n: f(n, t) for n, t in self.as_dict().items()})

    def for_brands(self, brands) -> "Sources":
        """Restrict every table to ``brands`` (partition pruning on staged data)."""
        from skuflow.brands import brand_filter

        pred = brand_filter(brands)
        return self.map(lambda _, t: t.where(pred))


def check_schema(name: str, df: DataFrame) -> None:
    """Raise if ``df`` lacks a column the reports read, or has another type."""
    expected = EXPECTED_SCHEMAS[name]
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in actual:
            problems.append(f"missing {f.name}")
        elif actual[f.name] != f.dataType:
            problems.append(f"{f.name}: {actual[f.name].simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise ValueError(f"{name}: " + "; ".join(problems))


def conform(name: str, df: DataFrame) -> DataFrame:
    """Project ``df`` onto the expected columns of ``name`` in their order."""
    from pyspark.sql import functions as F

    cols = []
    have = set(df.columns)
    for f in EXPECTED_SCHEMAS[name].fields:
        if f.name not in have:
            raise ValueError(f"{name}: missing column {f.name}")
        cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*cols)


#: Bytes, as the optimiser estimates them from compressed files, up to which a table may be broadcast.
#: In memory its rows take a hundred times that and more (keys that compress well, a row per brand).
SMALL = 512 << 10
#: The same for tables of a row per file row.
SMALL_PLAIN = 4 << 20
UNITS = {u: 1 << 10 * k for k, u in enumerate(("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"))}


def estimated_bytes(df: DataFrame) -> float:
    """The optimiser's estimate of ``df``, as ``explain`` prints it; no job runs."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="cost")
    found = re.search(r"Statistics\(sizeInBytes=([0-9.E+]+) (\w+)", out.getvalue())     # of the whole plan: the first
    return float(found[1]) * UNITS[found[2]] if found else float("inf")


def is_small(*tables: DataFrame, most: int = SMALL) -> bool:
    """Whether a join with each of ``tables`` may be left to the optimiser, broadcast included."""
    return all(estimated_bytes(t) <= most for t in tables)


def joinable(table: DataFrame, most: int = SMALL_PLAIN) -> DataFrame:
    """``table`` as the right side of a join: by sort-merge unless it is small."""
    return table if is_small(table, most=most) else table.hint("merge")
