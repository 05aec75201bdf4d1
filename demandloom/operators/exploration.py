"""Exploratory queries over the daily, weekly and gold layers."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..columns import SERIES, TARGET
from ..functions import known_values, percentiles_of, season_month, stored_counts

WEEKS = list(range(1, 54))
BINS = 80
# Columns of the correlation matrix.
CORRELATED = (
    "weekly_sales",
    "lag_1_week",
    "lag_4_week",
    "lag_52_week",
    "rolling_4_week_avg",
    "rolling_12_week_avg",
    "week_of_year",
    "month",
    "quarter",
    "week_has_holiday",
)
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def weekly_summary(weekly):
    """Count, mean, deviation, extremes and quartiles to two digits, and null cells.

    One pass counts the values and the null cells beside them; all else follows from the counts.
    """
    counts = stored_counts(weekly, TARGET, null_cells=F.sum(sum(F.col(c).isNull().cast("long") for c in weekly.columns)))
    known, n = known_values(counts), F.col("n")
    mean = known.agg(F.try_divide(F.sum(F.col("_v") * n), F.sum("n")).cast("double")).scalar()
    stats = known.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.round(mean, 2).alias("mean"),
        F.round(F.sqrt(F.try_divide(F.sum(F.pow(F.col("_v") - mean, 2) * n), F.sum("n") - 1)), 2).alias("std"),
        F.min("_v").cast("double").alias("min"),
        F.max("_v").cast("double").alias("max"),
        counts.agg(F.coalesce(F.sum("null_cells"), F.lit(0))).scalar().alias("null_cells"),
    )
    quartiles = percentiles_of(counts, QUARTILES)
    packed = quartiles.select(F.struct(*[F.round(q, 2).alias(q) for q in QUARTILES]).alias("q"))
    return (
        stats.withColumn("q", packed.scalar())
        .select("count", "mean", "std", "min", "q.q1", "q.median", "q.q3", "max", "null_cells")
    )


def histogram(weekly, bins=BINS, value=TARGET):
    """Rows per equal-width bin; the last bin includes the maximum. Empty bins are
    listed too, and each row repeats the overall mean and median. One pass over ``weekly``."""
    counts = stored_counts(weekly, value)
    known = known_values(counts)
    stats = known.agg(
        F.struct(
            F.min("_v").cast("double").alias("lo"),
            F.max("_v").cast("double").alias("hi"),
            F.try_divide(F.sum(F.col("_v") * F.col("n")), F.sum("n")).cast("double").alias("mean"),
        ).alias("s")
    )
    median = percentiles_of(counts, {"median": 0.5})
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    place = F.floor(F.try_divide(F.col("_v") - F.col("s.lo"), width))
    counted = (
        known.select("_v", "n", stats.scalar().alias("s"))
        .groupBy(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.sum("n").alias("rows"))
    )
    edges = (
        stats.withColumn("median", median.scalar())
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select(
            "bin",
            (F.col("s.lo") + F.col("bin") * width).alias("bin_start"),
            (F.col("s.lo") + (F.col("bin") + 1) * width).alias("bin_end"),
            F.col("s.mean").alias("mean"),
            "median",
        )
    )
    return edges.join(F.broadcast(counted), "bin", "left").select(  # at most one row per bin
        "bin", "bin_start", "bin_end", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"), "mean", "median"
    )


def weekly_totals(weekly):
    """Total per calendar week with its place in time. One row per calendar week
    reaches the window, so it needs no partitioning."""
    place = F.row_number().over(Window.orderBy("year", "week_of_year")) - 1
    return (
        weekly.groupBy("year", "week_of_year")
        .agg(F.sum(TARGET).alias(TARGET))
        .withColumn("seq", place)
        .orderBy("seq")
    )


def first_week_places(weekly):
    return weekly_totals(weekly).groupBy("year").agg(F.min("seq").alias("first_seq")).orderBy("year")


def monthly_boxes(weekly):
    """Quartiles and whiskers per season month, outliers left out of the whiskers. One pass over ``weekly``."""
    counts = stored_counts(weekly.withColumn("month", season_month(F.col("week_of_year"))), TARGET, by=["month"])
    boxes = percentiles_of(counts, QUARTILES, by=["month"])
    spread = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("_v").between(F.col("q1") - spread, F.col("q3") + spread)
    return (
        known_values(counts)
        .join(F.broadcast(boxes), "month")  # twelve rows at most
        .groupBy("month", *QUARTILES)
        .agg(
            F.min(F.when(inside, F.col("_v"))).cast("double").alias("lo"),
            F.max(F.when(inside, F.col("_v"))).cast("double").alias("hi"),
        )
        .select(
            "month",
            *QUARTILES,
            F.least("lo", "q1").alias("whisker_low"),
            F.greatest("hi", "q3").alias("whisker_high"),
        )
        .orderBy("month")
    )


def year_week_heat(weekly):
    """Mean over items of the sales summed over stores, per year and week."""
    return (
        weekly.groupBy("item", "year", "week_of_year")
        .agg(F.sum(TARGET).alias("total"))
        .groupBy("year", "week_of_year")
        .agg(F.avg("total").alias("avg_sales"))
    )


def weekday_week_heat(daily):
    """Mean over items and dates of the sales summed over stores, per weekday
    (Monday = 0) and ISO week."""
    return (
        daily.groupBy("item", "date")
        .agg(F.sum("sales").alias("total"))
        .groupBy(F.weekday("date").alias("day_of_week"), F.weekofyear("date").alias("week_iso"))
        .agg(F.avg("total").alias("avg_sales"))
    )


def pivot_weeks(heat, index, week, value="avg_sales", digits=None):
    """Heat map as a table with one column per week, w1 to w53."""
    cell = F.first(value) if digits is None else F.round(F.first(value), digits)
    wide = heat.groupBy(index).pivot(week, WEEKS).agg(cell)
    return wide.select(index, *[F.col(f"`{w}`").alias(f"w{w}") for w in WEEKS]).orderBy(index)


def store_totals(weekly):
    return (
        weekly.groupBy("store")
        .agg(F.sum(TARGET).alias("total_sales"))
        .orderBy(F.desc("total_sales"), "store")
    )


def store_season(weekly):
    """Per store and week of year, the mean over years of the mean over items."""
    return (
        weekly.groupBy("store", "year", "week_of_year")
        .agg(F.avg(TARGET).alias("mean_sales"))
        .groupBy("store", "week_of_year")
        .agg(F.avg("mean_sales").alias("avg_sales"))
    )


def item_totals(weekly):
    return weekly.groupBy("item").agg(F.sum(TARGET).alias("total_sales"))


def top_items(weekly, n=10):
    return item_totals(weekly).orderBy(F.desc("total_sales"), "item").limit(n)


def bottom_items(weekly, n=10):
    last = item_totals(weekly).orderBy("total_sales", F.desc("item")).limit(n)
    return last.orderBy(F.desc("total_sales"), "item")


def item_volatility(weekly):
    """Range and sample variance of weekly sales per item."""
    return (
        weekly.groupBy("item")
        .agg(
            F.min(TARGET).alias("min_sales"),
            F.max(TARGET).alias("max_sales"),
            (F.max(TARGET) - F.min(TARGET)).alias("diff"),
            F.var_samp(TARGET).alias("variance"),
        )
        .orderBy("item")
    )


def correlations(gold, columns=CORRELATED):
    """Lower triangle of the Pearson matrix in long form, diagonal included.

    One aggregation gives every cell, combined on the map side. Its covariances are kept as
    centred sums that merge without cancelling, so a large mean costs no digits. Rows that
    miss one of the columns are left out; a constant column has null cells.
    """
    pairs = [(i, k) for i in range(len(columns)) for k in range(i + 1)]
    x = [F.col(c).cast("double") for c in columns]
    spreads = gold.dropna(subset=list(columns)).agg(*[F.covar_pop(x[i], x[k]).alias(f"c{i}_{k}") for i, k in pairs])
    cells = F.array(
        *[
            F.struct(
                F.lit(columns[i]).alias("row"),
                F.lit(columns[k]).alias("column"),
                F.try_divide(F.col(f"c{i}_{k}"), F.sqrt(f"c{i}_{i}") * F.sqrt(f"c{k}_{k}")).alias("r"),
            )
            for i, k in pairs
        ]
    )
    return spreads.select(F.inline(cells))


def lag_pairs(gold, lag="lag_1_week"):
    return gold.select(*SERIES, "year", "week_of_year", lag, TARGET)


def dataset_summary(daily, weekly, gold):
    """Extent of the three layers in one row.

    Weekly rows collapse to one row per series before the distinct counts.
    """
    series = weekly.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(TARGET).alias("s"),
        F.max(TARGET).alias("m"),
        F.sum("week_has_holiday").alias("h"),
    )
    weekly_stats = series.agg(
        F.count_distinct("store").alias("stores"),
        F.count_distinct("item").alias("items"),
        F.sum("n").alias("weekly_rows"),
        F.try_divide(F.sum("s"), F.sum("n")).alias("avg_weekly_sales"),
        F.max("m").alias("max_weekly_sales"),
        F.sum("h").alias("holiday_weeks"),
    ).withColumn("holiday_pct", F.col("holiday_weeks") * 100 / F.col("weekly_rows"))
    daily_stats = daily.agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("daily_rows"),
    )
    gold_stats = gold.agg(F.count(F.lit(1)).alias("gold_rows"))
    packed = [
        frame.select(F.struct("*").alias("s")).scalar() for frame in (weekly_stats, gold_stats)
    ]
    return (
        daily_stats.withColumns({"w": packed[0], "g": packed[1]})
        .select(
            "first_date", "last_date", "w.stores", "w.items", "daily_rows", "w.weekly_rows",
            "g.gold_rows", "w.avg_weekly_sales", "w.max_weekly_sales", "w.holiday_weeks", "w.holiday_pct",
        )
    )


def layer_shapes(**layers):
    """Rows and columns of each named layer."""
    shapes = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("layer"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in layers.items()
    ]
    first, *rest = shapes
    for shape in rest:
        first = first.unionByName(shape)
    return first
