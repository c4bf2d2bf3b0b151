"""Reading snapshot feeds and files, and writing tables, snapshots and exports."""

from tallybook.sources.days import list_days, snapshot_spine
from tallybook.sources.keyed import merge_keyed, read_keyed, write_keyed_table
from tallybook.sources.readers import read_csv, read_snapshots
from tallybook.sources.writers import (
    copy_tables,
    export_csv,
    replace_table,
    write_snapshot,
    write_table,
)

__all__ = [
    "copy_tables",
    "export_csv",
    "list_days",
    "merge_keyed",
    "read_csv",
    "read_keyed",
    "read_snapshots",
    "replace_table",
    "snapshot_spine",
    "write_keyed_table",
    "write_snapshot",
    "write_table",
]
