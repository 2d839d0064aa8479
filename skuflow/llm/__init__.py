"""Training-data operators (PII, dedup, tokenising, classifiers, search, packing).

Self-contained: nothing outside this folder imports it.  ``queries.py`` holds
the registered queries; the other modules hold one operator each.
"""
