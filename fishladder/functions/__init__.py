from fishladder.functions.dates import (adult_calendar, days_from, epoch_seconds,
                                        july_first, mdy, mdy_hms, month_day_label,
                                        ocean_age, parse_mixed_date, remap_year,
                                        to_fahrenheit, travel_days, window_calendar)
from fishladder.functions.text import comma, str_c, word

__all__ = ["adult_calendar", "days_from", "epoch_seconds", "july_first", "mdy",
           "mdy_hms", "month_day_label", "ocean_age", "parse_mixed_date",
           "remap_year", "to_fahrenheit", "travel_days", "window_calendar",
           "comma", "str_c", "word"]
