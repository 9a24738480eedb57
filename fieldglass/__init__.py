"""Spark-native analytics over league-style event and statistics data.

Operators are functions from DataFrames and a mapping of roles to columns to a
DataFrame; nothing runs until the result is used.
"""
