from scenecast.functions.calendar import (
    add_calendar, add_cyclical, epoch_micros, epoch_millis, parse_time_text,
    prepare_times, short_label, time_text,
)
from scenecast.functions.metrics import frac_above, pearson, r2, rmse
from scenecast.functions.names import (
    basename, day_prefix, file_timestamp, minute_of_day, timestamp_style_doy,
    timestamp_style_s, url_day,
)

__all__ = [
    "add_calendar", "add_cyclical", "epoch_micros", "epoch_millis", "parse_time_text",
    "prepare_times", "short_label", "time_text", "frac_above", "pearson", "r2", "rmse",
    "basename", "day_prefix", "file_timestamp", "minute_of_day", "timestamp_style_doy",
    "timestamp_style_s", "url_day",
]
