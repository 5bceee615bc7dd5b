"""Training-data operators: sharding, filtering, deduplication, search and packing on Spark.

Nothing outside this subpackage imports it.
"""
