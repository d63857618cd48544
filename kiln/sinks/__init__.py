"""Writers: raw landing, clean CSV, and the two warehouse tables."""

from kiln.sinks.files import land_raw, write_clean_csv
from kiln.sinks.warehouse import LoadAudit, Warehouse

__all__ = ["land_raw", "write_clean_csv", "LoadAudit", "Warehouse"]
