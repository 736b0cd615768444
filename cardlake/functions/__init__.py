from cardlake.functions.columns import (  # noqa: F401
    any_true, event_time, micros, reason_list, utc_day,
)
