"""Scans: dated landing files and catalog / path tables."""

from daylake.sources.landing import list_files, read_csv, scan_by_header, scan_dated, scan_files
from daylake.sources.tables import (is_nonempty, partition_columns,
                                    path_exists, read_snapshot, table_exists)

__all__ = ["list_files", "read_csv", "scan_by_header", "scan_dated", "scan_files", "is_nonempty",
           "partition_columns", "path_exists", "read_snapshot", "table_exists"]
