"""Models written down by hand, so that scoring can be checked apart from fitting."""

# A forest of three small trees, as node rows in the order of ``trees.NODE_DDL``.
FOREST = [
    (0, 0, "lag_1_week", None, 60.0, 1, 2, 55.0, 0.5, 210.0, 1000.0),
    (0, 1, "week_of_year", None, 26.5, 3, 4, 41.0, 0.5, 30.0, 600.0),
    (0, 2, "store", "2", 0.5, 5, 6, 76.0, 0.5, 18.0, 400.0),
    (0, 3, None, None, None, None, None, 38.25, 0.5, None, 320.0),
    (0, 4, None, None, None, None, None, 44.125, 0.5, None, 280.0),
    (0, 5, None, None, None, None, None, 79.5, 0.5, None, 310.0),
    (0, 6, None, None, None, None, None, 64.0, 0.5, None, 90.0),
    (1, 0, "item", "7", 0.5, 1, 2, 52.0, 0.3, 12.0, 900.0),
    (1, 1, "rolling_4_week_avg", None, 48.75, 3, 4, 51.5, 0.3, 95.0, 860.0),
    (1, 2, None, None, None, None, None, 66.0, 0.3, None, 40.0),
    (1, 3, None, None, None, None, None, 40.5, 0.3, None, 500.0),
    (1, 4, "week_has_holiday", None, 0.5, 5, 6, 63.0, 0.3, 4.0, 360.0),
    (1, 5, None, None, None, None, None, 61.75, 0.3, None, 250.0),
    (1, 6, None, None, None, None, None, 65.5, 0.3, None, 110.0),
    (2, 0, None, None, None, None, None, 50.0, 0.2, None, 800.0),
]

# One seasonal model: level and slope, sines and cosines of one to ten cycles a
# year, three bends of the trend and their places in years since 2000.
SEASONAL_BENDS = [-3.75, -2.5, -1.25]
SEASONAL_COEFFICIENTS = [
    52.0, 0.75,
    6.5, -2.25, 1.125, -0.5, 0.25, 0.75, -0.125, 0.0625, -0.375, 0.03125,
    -3.0, 1.75, -0.875, 0.4375, 0.3125, -0.25, 0.1875, -0.15625, 0.09375, -0.0625,
    1.5, -2.75, 0.625,
]
