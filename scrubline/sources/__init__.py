"""Reading and writing tables."""

from scrubline.sources.csv import malformed_rows, read_csv, write_csv
from scrubline.sources.jdbc import JdbcTarget, LoadMismatch, jdbc_ready, load_table
from scrubline.sources.ledger import (
    JdbcLanding,
    each_once,
    landed_files,
    ledger,
    load_manifest,
    load_once,
    once_view,
    stage_files,
)
from scrubline.sources.names import NameCollision, normal_name, normalize_columns
from scrubline.sources.parquet import (
    persisted,
    publish_snapshot,
    read_published,
    read_snapshot,
    write_snapshot,
)
from scrubline.sources.split import read_csv_split
from scrubline.sources.tables import APP_HEADERS, REVIEW_HEADERS, text_schema

__all__ = [
    "APP_HEADERS",
    "REVIEW_HEADERS",
    "JdbcLanding",
    "JdbcTarget",
    "LoadMismatch",
    "NameCollision",
    "each_once",
    "jdbc_ready",
    "landed_files",
    "ledger",
    "load_manifest",
    "load_once",
    "load_table",
    "malformed_rows",
    "normal_name",
    "normalize_columns",
    "persisted",
    "once_view",
    "publish_snapshot",
    "read_csv",
    "read_csv_split",
    "read_published",
    "read_snapshot",
    "stage_files",
    "text_schema",
    "write_csv",
    "write_snapshot",
]
