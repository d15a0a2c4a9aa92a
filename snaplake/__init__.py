"""snaplake: a Spark-native lakehouse for monthly registry snapshots.

Layers: landing zips -> bronze Parquet -> silver staging -> gold marts,
plus incremental upserts on plain Parquet and declarative data checks.
Every transform is a ``DataFrame -> DataFrame`` function that Catalyst plans.
"""

__version__ = "0.1.0"
