from rollcall.sources.catalog import list_snapshot_files, snapshot_catalog
from rollcall.sources.csv_io import (
    check_latin1, read_export_csv, with_row_index, write_export_csv, write_inventory_csv, write_raw,
)
from rollcall.sources.flatten import (
    flatten_comments, flatten_likes, flatten_posts, flatten_users, read_landed,
)
from rollcall.sources.inventory import (
    FileTreeSource, file_inventory, inventory_count, inventory_errors,
)

__all__ = [
    "list_snapshot_files", "snapshot_catalog", "check_latin1", "read_export_csv",
    "with_row_index", "write_export_csv", "write_inventory_csv", "write_raw",
    "flatten_comments", "flatten_likes", "flatten_posts", "flatten_users", "read_landed",
    "FileTreeSource", "file_inventory", "inventory_count", "inventory_errors",
]
