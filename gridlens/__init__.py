"""gridlens: hourly electricity-grid analytics on Spark DataFrames.

Layout:
  functions/  scalar Column helpers (rounding, time text, bit tests)
  sources/    landed pages, normalizers, keyed upsert, scans, sinks, fixture adapters
  operators/  duck curve, dashboard aggregates, windows, scenarios, dispatch, forecast
  plans/      compositions (ingest, dashboard) and the query catalogue with SQL twins
  streaming/  file-stream ingest of landed pages through the same upsert
"""

__all__ = ["session"]
