"""Raw daily rows to clean daily rows with a holiday flag."""

from pyspark.sql import functions as F

from ..columns import DAILY_COLUMNS


def ensure_date(df, column="date"):
    if dict(df.dtypes)[column] == "date":
        return df
    return df.withColumn(column, F.col(column).try_cast("date"))


def drop_repeats(df, keys=None):
    return df.dropDuplicates(list(keys) if keys else None)


def keep_nonnegative(df, column="sales"):
    """Keep rows at or above zero; a missing value is not kept either."""
    return df.where(F.col(column) >= 0)


def flag_holidays(daily, holidays):
    """Left join on the date. The holiday side has one row per calendar date, so it
    cannot outgrow about 3.7 million 8-byte rows and is safe to broadcast."""
    return (
        daily.join(F.broadcast(holidays), F.col("date") == F.col("holiday_date"), "left")
        .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
        .select(*DAILY_COLUMNS)
    )


def clean_daily(raw, holidays):
    return flag_holidays(keep_nonnegative(drop_repeats(ensure_date(raw))), holidays)


def cleaning_report(raw, holidays):
    """Row counts through the cleaning steps, from one pass over the raw rows."""
    raw = ensure_date(raw)
    distinct = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("copies"))
    kept = F.coalesce(F.col("sales") >= 0, F.lit(False))
    return (
        distinct.join(F.broadcast(holidays), F.col("date") == F.col("holiday_date"), "left")
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("original_rows"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_dropped"),
            F.count_if(~kept).alias("negatives_removed"),
            F.count_if(kept & F.col("is_holiday").isNotNull()).alias("holiday_rows"),
            F.count_if(kept).alias("final_rows"),
        )
    )
