from tidewatch.functions.edits import (
    byte_delta,
    byte_magnitude,
    editor_label,
    is_revert,
    namespace_label,
    percent,
)
from tidewatch.functions.time import (
    floor_minutes,
    lit_date,
    lit_moment,
    lookback_start,
    slice_start,
    utc_date,
    window_epoch,
)

__all__ = [
    "byte_delta",
    "byte_magnitude",
    "editor_label",
    "floor_minutes",
    "is_revert",
    "lit_date",
    "lit_moment",
    "lookback_start",
    "namespace_label",
    "percent",
    "slice_start",
    "utc_date",
    "window_epoch",
]
