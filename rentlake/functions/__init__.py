from rentlake.functions.dates import calendar, days_between, month_before, on_day
from rentlake.functions.text import capitalise, full_name, ordered_concat, ordered_parts

__all__ = [
    "calendar",
    "capitalise",
    "days_between",
    "full_name",
    "month_before",
    "on_day",
    "ordered_concat",
    "ordered_parts",
]
