"""Brand (tenant) constants, validation and routing names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The brand codes the reports are produced for.
BRANDS = ("ABC", "DEF", "GHI", "JKL", "MNO")


def validate_brand(brand: str) -> str:
    """Return ``brand`` if it is a known brand code, else raise ``ValueError``."""
    if brand not in BRANDS:
        raise ValueError(f"unknown brand code {brand!r}; the reports cover {', '.join(BRANDS)}")
    return brand


def validate_brands(brands) -> tuple[str, ...]:
    return tuple(validate_brand(b) for b in brands)


def brand_filter(brands=None) -> Column:
    """Predicate keeping the given brands (all brands when ``None``).

    On brand-partitioned parquet this becomes a partition filter.
    """
    chosen = validate_brands(brands) if brands is not None else BRANDS
    return F.col("brand").isin(*chosen)


def export_table_name(brand: str, kind: str) -> str:
    """``report_<brand>_<kind>`` for one brand."""
    if kind not in ("non_bundle", "only_bundle"):
        raise ValueError(f"unknown report kind {kind!r}")
    return f"report_{validate_brand(brand).lower()}_{kind}"
