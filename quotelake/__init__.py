"""quotelake: a Spark-native lakehouse for bid/ask market ticks.

Everything is expressed with DataFrames, Spark SQL and Structured
Streaming; functions take and return DataFrames so Catalyst sees whole
plans.  Sub-packages:

* ``functions``  – column-level helpers (time zones, window keys, spread, paths)
* ``operators``  – tick selection, windows, merge, aggregates, table history
* ``sources``    – config / CSV / Parquet scans, sinks, CSV→Parquet conversion
* ``streaming``  – Structured Streaming versions of the tick pipeline
* ``plans``      – fixtures derived from the test tables and the query registry
"""

__version__ = "0.1.0"
