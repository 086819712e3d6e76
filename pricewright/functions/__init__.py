from .calendar import calendar_columns, month_name, parse_date
from .scalars import log_plus_one, micros_per_row, type_code

__all__ = [
    "calendar_columns",
    "log_plus_one",
    "micros_per_row",
    "month_name",
    "parse_date",
    "type_code",
]
