"""Row-set operators: de-duplication, keyed upserts, surrogate keys,
data-quality rules and dimension lookups."""
