"""Sources: CSV landing folders, layer tables, benchmark-derived feeds."""

from strata.sources.files import header_report, read_csv, stream_csv, with_extract_time
from strata.sources.tables import stream_table

__all__ = [
    "header_report",
    "read_csv",
    "stream_csv",
    "stream_table",
    "with_extract_time",
]
