from .readers import (
    accepted_sales,
    daily_upload,
    holiday_dates,
    parsed_sales,
    read_holidays,
    read_layer,
    read_metrics,
    read_raw_sales,
    read_rejected,
    read_upload,
    rejected_dates,
    rejected_sales,
)
from .writers import (
    append_check_log,
    export_csv,
    write_by_store,
    write_metrics,
    write_plain,
)

__all__ = [
    "accepted_sales",
    "append_check_log",
    "daily_upload",
    "export_csv",
    "holiday_dates",
    "parsed_sales",
    "read_holidays",
    "read_layer",
    "read_metrics",
    "read_raw_sales",
    "read_rejected",
    "read_upload",
    "rejected_dates",
    "rejected_sales",
    "write_by_store",
    "write_metrics",
    "write_plain",
]
