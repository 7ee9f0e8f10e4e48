"""Operators for preparing training text and vectors at scale.

Nothing outside this folder imports it.  Every operator takes and returns
DataFrames; Python runs only inside tasks, on Arrow batches that Spark
partitions and shuffles.
"""
