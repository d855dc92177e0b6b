"""livetables: bulk-loaded fact tables kept current from feeds, on Spark.

Every operator is a function over DataFrames (or table names) that returns a
DataFrame. The work runs as Spark SQL / DataFrame plans; no custom engine code.

Layout:
  sources/    readers and generators (parquet/CSV/any format, tick generator,
              change-log reader)
  sinks/      DDL and writes (create, append by name or position, CTAS, drop,
              save to directory, CSV export, bulk copy)
  functions/  column expressions (seeded hashes, time-of-day text, exact sums)
  operators/  rollups and transforms (ticks, flights, contracts, changes, feeds)
  plans/      staged loads, the named query catalog and plan checks
  streaming/  Structured Streaming jobs (change-log sync, JSON feed)
"""

__version__ = "0.1.0"
