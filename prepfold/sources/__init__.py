"""Sources and sinks: Parquet scans, SQL views, model files."""

from .parquet import list_columns, load_table, read_parquet, register_view

__all__ = ["list_columns", "load_table", "read_parquet", "register_view"]
