"""Readers, and the projections that derive shop tables and log lines."""

from shoplens.sources.inference import column_types, infer_schema
from shoplens.sources.readers import load_table, read_lines, read_table, table_quality
from shoplens.sources.records import read_records, read_table_of_records

__all__ = [
    "column_types",
    "infer_schema",
    "load_table",
    "read_lines",
    "read_records",
    "read_table",
    "read_table_of_records",
    "table_quality",
]
