"""eventweave: integrate event records from several sources into one star schema on Spark.

Layout
------
sources/    typed readers and writers (parquet, CSV) with explicit schemas
functions/  Column-level helpers (blank tests, guarded padding, ordered regex folds)
operators/  DataFrame -> DataFrame operators: cleaning, text, geo, spans, keys,
            marts, analytics, survey statistics, skew-safe ordered scans
plans/      query plans over the driver tables plus their SQL oracles
streaming/  incremental ingest of arriving source files with Structured Streaming
"""

__version__ = "0.1.0"
