"""Layered credit-data warehouse and data-quality operators for PySpark.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns. The few that start a Spark job while being called (bounds probes,
value lists, range boundaries, table writes) say so in their docstring.
"""
