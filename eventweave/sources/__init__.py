"""Typed sources and sinks: parquet and CSV with explicit schemas, never inferred."""

from .readers import read_csv, read_csv_checked, read_parquet, read_table, write_csv, write_parquet
from .schemas import DRIVER_SCHEMAS, RAW_SCHEMAS

__all__ = ["read_csv", "read_csv_checked", "read_parquet", "read_table", "write_csv", "write_parquet", "DRIVER_SCHEMAS", "RAW_SCHEMAS"]
