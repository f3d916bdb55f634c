"""Search-behaviour analytics on Spark.

Every function takes and returns DataFrames (or Columns); no module keeps a
session of its own.
"""
