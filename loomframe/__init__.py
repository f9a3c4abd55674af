"""Reusable data jobs over Spark DataFrames.

Every function takes DataFrames or Columns and returns DataFrames or Columns; none of them
creates a session. See the README for the map from task to module.
"""
