"""Readers: tables, files, databases, landed payloads and message streams."""

from marketlake.sources.payloads import (
    is_complete,
    landed_payloads,
    parse_payload,
    payload_entries,
    payload_records,
    staged,
)
from marketlake.sources.messages import message_stream, parse_messages
from marketlake.sources.tables import (
    conform_records,
    read_csv,
    read_database,
    read_json_records,
    read_parquet,
    scan,
    table_columns,
)

__all__ = [name for name in dir() if not name.startswith("_")]
