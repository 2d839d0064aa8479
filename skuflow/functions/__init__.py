"""Column-expression helpers (no Python UDFs)."""

from skuflow.functions.sku import (clean_bundle_sku, effective_name, has_pipe, nonzero_qty,
                                   override_quantity, sku_code, sku_priority, sku_qty, split_bundle)
from skuflow.functions.timefn import floor_days_between

__all__ = ["clean_bundle_sku", "effective_name", "has_pipe", "nonzero_qty", "override_quantity",
           "sku_code", "sku_priority", "sku_qty", "split_bundle", "floor_days_between"]
