"""Column names, schemas and other fixed values shared by the whole package."""

from pyspark.sql import types as T

# Names and order of the columns of each layer.
SERIES = ("store", "item")
WEEK_KEY = ("store", "item", "year", "week_of_year")
TARGET = "weekly_sales"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("store", T.IntegerType()),
        T.StructField("item", T.IntegerType()),
        T.StructField("sales", T.IntegerType()),
    ]
)

# The daily retail data set that the default arguments describe.
EXPECTED_ROWS = 913_000
STORES = (1, 10)
ITEMS = (1, 50)
DATES = ("2013-01-01", "2017-12-31")
BASE_YEAR = 2013
TRAIN_UNTIL = 2016
TEST_YEAR = 2017

# The history features and their names.
LAGS = (1, 4, 52)
TRAILING = (4, 12)
HISTORY_COLUMNS = (
    "lag_1_week",
    "lag_4_week",
    "lag_52_week",
    "rolling_4_week_avg",
    "rolling_12_week_avg",
)

# Scalar model inputs, in vector slot order.
SCALAR_FEATURES = (
    "week_of_year",
    "week_has_holiday",
    "month",
    "quarter",
    "is_year_end",
    "lag_1_week",
    "lag_4_week",
    "lag_52_week",
    "rolling_4_week_avg",
    "rolling_12_week_avg",
)

# The gold layer, in column order.
GOLD_SCALARS = (
    "store",
    "item",
    "year",
    "week_of_year",
    "abs_week",
    "weekly_sales",
    "week_has_holiday",
    "month",
    "quarter",
    "is_year_end",
    "lag_1_week",
    "lag_4_week",
    "lag_52_week",
    "rolling_4_week_avg",
    "rolling_12_week_avg",
)
GOLD_COLUMNS = GOLD_SCALARS + ("store_idx", "item_idx", "store_ohe", "item_ohe")

# The daily and weekly layers, in column order.
DAILY_COLUMNS = ("date", "store", "item", "sales", "is_holiday")
WEEKLY_COLUMNS = WEEK_KEY + ("weekly_sales", "week_has_holiday")
