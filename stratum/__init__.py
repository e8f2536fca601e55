"""stratum — layered (Bronze → Silver → Gold) analytics on Spark DataFrames.

Sub-packages:
  sources    landing/Bronze files, keyed tables, rule files
  functions  Column -> Column helpers (no Python UDFs)
  operators  DataFrame -> DataFrame building blocks (clean, match, merge, SCD-2, quality)
  plans      gold models, dashboard reports, query registry
"""

__version__ = "0.1.0"
