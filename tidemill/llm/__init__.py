"""Training-data operators: scoring, deduplication, sharding, packing, tokenising.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
