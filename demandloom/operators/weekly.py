"""Daily to weekly rollup and the summaries of both layers."""

from pyspark.sql import functions as F

from ..columns import SERIES, WEEK_KEY, WEEKLY_COLUMNS


def to_weekly(daily):
    """Sum of sales and holiday flag per series and week. Sums combine on the map
    side, so a hot series sends one row per task and week into the shuffle."""
    return (
        daily.groupBy(
            *SERIES, F.year("date").alias("year"), F.weekofyear("date").alias("week_of_year")
        )
        .agg(F.sum("sales").alias("weekly_sales"), F.max("is_holiday").alias("week_has_holiday"))
        .select(*WEEKLY_COLUMNS)
    )


def flag_distribution(df, flag):
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("rows")).orderBy(flag)


def describe_columns(df, columns):
    """Count, mean, sample deviation, minimum and maximum, one row per column."""
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def rows_per_year(df):
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("rows")).orderBy("year")


def series_catalogue(df):
    """Distinct series with their row counts."""
    return df.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("rows"))


def week_keys(df):
    return df.select(*WEEK_KEY).dropDuplicates()


def head_sample(df, order, n):
    return df.orderBy(*order).limit(n)
