from .numeric import exact_mean, round_half_up
from .hashing import day_hash_id, distinct_from, hash_id, key_text, row_hash, row_hash_concat, row_hash_json
from .temporal import (calendar_columns, epoch_ms_to_ts, format_compact_ts, parse_compact_ts,
                       published_day, time_id, ts_to_epoch_ms)
from .text import is_blank, last_token, split_explode, trim_ws, word_tokens

__all__ = [
    "day_hash_id", "distinct_from", "hash_id", "key_text", "row_hash", "row_hash_concat", "row_hash_json",
    "calendar_columns", "epoch_ms_to_ts", "format_compact_ts", "parse_compact_ts",
    "time_id", "ts_to_epoch_ms", "is_blank", "last_token", "split_explode", "trim_ws",
    "word_tokens", "round_half_up", "published_day", "exact_mean",
]
