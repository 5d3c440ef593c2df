from .landing import (MissingRunDate, day_range, empty_frame, read_bars, read_bars_range,
                      read_lake, read_landing, read_landing_range, rename_bars, run_date_filter,
                      run_date_token, run_dates_between, unwrap_envelope)
from .tables import DRIVER_TABLES, Tables, driver_table, filter_time_id, read_table

__all__ = [
    "MissingRunDate", "day_range", "read_bars", "read_bars_range", "read_landing_range",
    "run_dates_between", "rename_bars", "empty_frame", "read_lake", "read_landing",
    "run_date_filter", "run_date_token", "unwrap_envelope", "DRIVER_TABLES", "Tables",
    "driver_table", "filter_time_id", "read_table",
]
