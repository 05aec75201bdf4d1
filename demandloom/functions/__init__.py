from .calendar import absolute_week, approximate_week_start, iso_monday, season_month
from .ordered import exact_percentiles, known_values, percentiles_of, places, running_shares, stored_counts

__all__ = [
    "absolute_week",
    "approximate_week_start",
    "exact_percentiles",
    "iso_monday",
    "known_values",
    "percentiles_of",
    "places",
    "running_shares",
    "season_month",
    "stored_counts",
]
