"""Spark-native analytics for marker-gene amplicon reads.

Every operator is a pure function from DataFrames to a DataFrame; see README.md.
"""
