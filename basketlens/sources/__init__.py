from .readers import (
    csv_listing, read_csv, read_csv_text, read_json_report, read_optional_csv, read_parquet,
    read_csv_tables, register_views,
)
from .session import get_session
from .sinks import stable, write_json_report, write_parquet

__all__ = [
    "csv_listing", "get_session", "read_csv", "read_csv_tables", "read_csv_text",
    "read_json_report", "read_optional_csv", "read_parquet", "register_views", "stable",
    "write_json_report", "write_parquet",
]
