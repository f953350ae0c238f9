"""Spark analyses of shop tables and web access logs.

Every analysis is a lazy function from DataFrames and thresholds to a
DataFrame; see ``shoplens.operators``.
"""

__version__ = "0.1.0"
