"""Operators for large-scale training-data pipelines (packing, sharding, filtering,
deduplication, tokenisation, extraction). Nothing outside this subpackage imports it."""
