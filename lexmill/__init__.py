"""Supervised text classification as Spark DataFrame jobs.

Every function takes and returns DataFrames or Columns; nothing here holds the
data on the driver. See README.md for the layout.
"""
