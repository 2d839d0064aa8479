"""The warehouse-SKU mini-language as Column expressions (JVM side, codegen).

A SKU string is ``CODE`` or ``CODE#QTY``; a bundle is ``CODE#QTY|CODE#QTY|...``.
``QTY`` counts only when it parses as an integer and is not zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators of the SKU strings.
QTY_SEP = "#"
BUNDLE_SEP = "|"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sku_code(sku) -> Column:
    """Part before the first ``#`` (the whole string without one)."""
    return F.split_part(_c(sku), F.lit(QTY_SEP), F.lit(1))


def sku_qty(sku) -> Column:
    """Integer after the first ``#``; NULL when absent or not an integer.

    ``'A#2|B'`` -> NULL (the text after ``#`` is ``'2|B'``), ``'A#x'`` -> NULL.
    """
    return F.split_part(_c(sku), F.lit(QTY_SEP), F.lit(2)).try_cast("int")


def nonzero_qty(sku) -> Column:
    q = sku_qty(sku)
    return F.when(q.isNotNull() & (q != 0), q)


def has_pipe(sku) -> Column:
    """Whether the string holds a bundle separator; NULL counts as false."""
    return F.coalesce(F.contains(_c(sku), F.lit(BUNDLE_SEP)), F.lit(False))


def split_bundle(sku) -> Column:
    """Bundle string -> array of part strings (empty parts kept)."""
    return F.split(_c(sku), r"\|")


def clean_bundle_sku(sku) -> Column:
    """Drop the ``#...`` suffix of every part: ``'A#4|B#0|C'`` -> ``'A|B|C'``."""
    return F.regexp_replace(_c(sku), r"#[^|]*", "")


def sku_priority(scp, scpi) -> Column:
    """0 both SKUs, 1 tier SKU only, 2 pricing SKU only, 3 none."""
    scp, scpi = _c(scp), _c(scpi)
    return (F.when(scp.isNotNull() & scpi.isNotNull(), 0)
            .when(scpi.isNotNull(), 1)
            .when(scp.isNotNull(), 2)
            .otherwise(3))


def override_quantity(raw_sku, own_tier_sku, quantity) -> Column:
    """Quantity after resolving ``raw_sku``: its ``#QTY`` replaces the line
    quantity only when non-zero and the line's own tier SKU is non-empty."""
    own = _c(own_tier_sku)
    q = nonzero_qty(raw_sku)
    return F.when(q.isNotNull() & own.isNotNull() & (own != ""), q).otherwise(_c(quantity))


def effective_name(item_name, translation_name) -> Column:
    """Item name unless NULL/empty, else the translation name."""
    return F.coalesce(F.nullif(_c(item_name), F.lit("")), _c(translation_name))
