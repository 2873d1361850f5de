"""Sources and sinks: the raw file lake, warehouse tables, test-table adapter."""

from chanmart.sources.lake import (
    landed_keys,
    read_images,
    read_landed_messages,
    read_message_files,
    write_message_files,
    write_partitioned_lake,
)
from chanmart.sources.tables import read_input, read_table, register_views, write_table

__all__ = [
    "landed_keys",
    "read_images",
    "read_input",
    "read_landed_messages",
    "read_message_files",
    "read_table",
    "register_views",
    "write_message_files",
    "write_partitioned_lake",
    "write_table",
]
