from .clean import allowlist, drop_incomplete_distinct, rename_fields
from .hot import heavy_keys, split_join
from .keys import (ID_MAP, assign_dense_ids, assign_hash_ids, latest_id_per_key, latest_per_key, mapped_ids,
                   max_id, resolve_fk, resolve_fks, settle_ids)
from .merge import (duplicate_count, insert_ignore, insert_new, merge_report, null_key_rows,
                    total_order, upsert)
from .quality import check_fk, check_length, check_not_null, check_unique, profile, quarantine
from .sets import assemble_capped, capped_quarantine, capped_report, union_sources

__all__ = [
    "allowlist", "drop_incomplete_distinct", "rename_fields", "assign_dense_ids",
    "assign_hash_ids", "latest_id_per_key", "latest_per_key", "max_id", "resolve_fk",
    "resolve_fks", "total_order", "duplicate_count", "capped_quarantine", "capped_report",
    "insert_ignore", "insert_new", "merge_report", "null_key_rows", "upsert", "check_fk",
    "check_length", "check_not_null", "check_unique", "profile", "quarantine",
    "assemble_capped", "union_sources", "mapped_ids", "settle_ids", "ID_MAP",
    "heavy_keys", "split_join",
]
