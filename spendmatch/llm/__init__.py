"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage.  Every operator takes and
returns Spark DataFrames; :mod:`spendmatch.llm.queries` registers one query per
operator.
"""
