"""skuflow: multi-brand order analytics as Spark DataFrame plans.

Every table carries a ``brand`` column and every key starts with it, so all
brands run in one distributed job.  Operators are pure ``DataFrame -> DataFrame``
functions; only :mod:`skuflow.sources.snapshot`, :mod:`skuflow.sources.sinks`
and :mod:`skuflow.plans.pipeline` trigger actions.
"""

from skuflow.brands import BRANDS, validate_brand

__all__ = ["BRANDS", "validate_brand"]
