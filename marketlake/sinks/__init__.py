from .publish import Load, compact, expire, is_published, last_commit, published, read_published
from .writers import (append_rows, current_version, export_tables, read_snapshot, write_json, write_json_arrays,
                      versions, write_run_date, write_snapshot, write_snapshots)

__all__ = ["Load", "compact", "expire", "is_published", "last_commit", "published", "read_published",
           "append_rows", "current_version", "export_tables", "read_snapshot", "write_json", "write_json_arrays",
           "versions", "write_run_date", "write_snapshot", "write_snapshots"]
