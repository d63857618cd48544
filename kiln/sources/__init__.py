"""Readers: day files, clean CSVs, warehouse tables, driver-table adapters."""

from kiln.sources.adapters import applicants, readings
from kiln.sources.files import read_clean_csv, scan_raw_json
from kiln.sources.tables import scan_jdbc, scan_sql, scan_table

__all__ = ["applicants", "readings", "read_clean_csv", "scan_raw_json", "scan_jdbc", "scan_sql", "scan_table"]
