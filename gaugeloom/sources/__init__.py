"""Landed snapshots, system tables, JSON documents and point lines."""

from gaugeloom.sources.landing import (
    SNAPSHOT, TABLES, jdbc_table, read_snapshots, read_table, table_or_empty, write_points,
)
from gaugeloom.sources.documents import parse_json_docs, read_json_files, read_json_lines
from gaugeloom.sources.lines import from_lines, read_lines

__all__ = [
    "SNAPSHOT", "TABLES", "from_lines", "jdbc_table", "parse_json_docs", "read_json_files",
    "read_json_lines", "read_lines", "read_snapshots", "read_table", "table_or_empty", "write_points",
]
