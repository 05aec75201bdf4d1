"""Row filters, splits and the totals built on filtered predictions."""

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..columns import SERIES, TEST_YEAR, TRAIN_UNTIL


def split_by_year(df, train_until=TRAIN_UNTIL, test_year=TEST_YEAR):
    return df.where(F.col("year") <= train_until), df.where(F.col("year") == test_year)


def split_report(df, train_until=TRAIN_UNTIL, test_year=TEST_YEAR):
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("year") <= train_until).alias("train_rows"),
        F.count_if(F.col("year") == test_year).alias("test_rows"),
    )
    return counts.withColumns(
        {
            f"{part}_pct": F.round(F.try_divide(F.col(f"{part}_rows") * 100.0, F.col("total_rows")), 1)
            for part in ("train", "test")
        }
    )


def filter_predictions(df, year=None, stores=None, items=None, weeks=None):
    """Rows inside all bounds given. What is not given, is empty, or names a column that
    the data lacks, bounds nothing. ``weeks`` is a first and a last week."""
    one_year = [year] if year is not None else None
    first, last = weeks if weeks is not None else (None, None)
    bounds = {
        "year": one_year and F.col("year").isin(one_year),
        "store": stores and F.col("store").isin([*stores]),
        "item": items and F.col("item").isin([*items]),
        "week": None if weeks is None else F.col("week").between(first, last),
    }
    met = [bound for column, bound in bounds.items() if isinstance(bound, Column) and column in df.columns]
    return df.where(reduce(and_, met, F.lit(True)))


def single_series(df, store, item, n=10):
    return df.where((F.col("store") == store) & (F.col("item") == item)).orderBy("abs_week").limit(n)


def predicted_by_week(predictions, by):
    """Summed predictions per week and ``by``."""
    week = F.col("week").try_cast("int").alias("week")
    return predictions.groupBy(week, by).agg(F.sum("sales_prediction").alias("sales_prediction"))


def predicted_totals(predictions, by):
    return (
        predictions.groupBy(by)
        .agg(F.sum("sales_prediction").alias("sales_prediction"))
        .orderBy(F.desc("sales_prediction"), by)
    )


def filter_options(predictions):
    """Selectable values in long form: every year, store and item once, and the
    first and last week. Long form keeps a large catalogue spread over tasks."""
    columns = ("year", *SERIES)
    # Collapse to distinct combinations first; they are far fewer than the rows.
    combos = predictions.groupBy(*columns).agg(
        F.min("week").alias("week_min"), F.max("week").alias("week_max")
    )
    lists = combos.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("option"), F.col(c).cast("int").alias("value")) for c in columns])
        ).alias("o")
    ).select("o.option", "o.value").dropDuplicates()
    edges = combos.agg(F.min("week_min").alias("lo"), F.max("week_max").alias("hi")).select(
        F.inline(
            F.array(
                F.struct(F.lit("week_min").alias("option"), F.col("lo").cast("int").alias("value")),
                F.struct(F.lit("week_max").alias("option"), F.col("hi").cast("int").alias("value")),
            )
        )
    )
    return lists.unionByName(edges).orderBy("option", "value")
