"""General operators: lookups, snapshots, incremental loads, data checks.

They take column names as arguments and know nothing of the registry.
"""
