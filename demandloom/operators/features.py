"""Weekly rows to model features."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..columns import (
    BASE_YEAR,
    GOLD_COLUMNS,
    GOLD_SCALARS,
    HISTORY_COLUMNS,
    LAGS,
    SERIES,
    TARGET,
    TRAILING,
)
from ..functions import absolute_week, approximate_week_start, places


def calendar_features(weekly, base_year=BASE_YEAR):
    year, week = F.col("year"), F.col("week_of_year")
    start = approximate_week_start(year, week)
    return weekly.withColumns(
        {
            "abs_week": absolute_week(year, week, base_year),
            "month": F.month(start),
            "quarter": F.quarter(start),
            "is_year_end": (week >= 51).cast("int"),
        }
    )


def history_features(weekly):
    """Lags by row and averages of the rows before the current one.

    All of them share one exchange and sort. A series has one row per calendar week,
    so no window partition grows with the number of sales.
    """
    past = Window.partitionBy(*SERIES).orderBy("abs_week")
    lags = {f"lag_{n}_week": F.lag(TARGET, n).over(past) for n in LAGS}
    trailing = {
        f"rolling_{n}_week_avg": F.avg(TARGET).over(past.rowsBetween(-n, -1)) for n in TRAILING
    }
    return weekly.withColumns(lags | trailing)


def drop_warmup(features):
    return features.dropna(subset=list(HISTORY_COLUMNS))


def warmup_report(features):
    complete = F.lit(True)
    for c in HISTORY_COLUMNS:
        complete = complete & F.col(c).isNotNull()
    return features.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(complete).alias("rows_after"),
        F.count_if(~complete).alias("rows_dropped"),
    )


def feature_rows(weekly, base_year=BASE_YEAR):
    """The scalar part of the gold layer."""
    with_history = history_features(calendar_features(weekly, base_year))
    return drop_warmup(with_history).select(*GOLD_SCALARS)


def encoder_stages():
    """Store and item one-hot encoder; a category not seen in fitting gets a bucket of
    its own at the index step and an all-zero vector at the encoding step."""
    return [
        StringIndexer(inputCols=list(SERIES), outputCols=["store_idx", "item_idx"], handleInvalid="keep"),
        OneHotEncoder(
            inputCols=["store_idx", "item_idx"], outputCols=["store_ohe", "item_ohe"], dropLast=True
        ),
    ]


def fit_encoder(rows):
    return Pipeline(stages=encoder_stages()).fit(rows.select(*SERIES))


def encode(features, encoder):
    return encoder.transform(features).select(*GOLD_COLUMNS)


def category_index(df, column):
    """Index of each category by descending frequency, ties in text order."""
    counts = df.groupBy(F.col(column).cast("string").alias("category")).agg(F.count(F.lit(1)).alias("rows"))
    placed = places(counts, F.desc("rows"), F.col("category"))
    return placed.select("category", "rows", F.col("place").cast("double").alias("index"))


def target_means(rows, column, target=TARGET, weight=20):
    """Mean target per category, drawn towards the overall mean by ``weight`` rows.

    One number stands for a category, so a model's width does not grow with the
    catalogue as one-hot slots do. Fit it on training rows only.
    """
    sums = rows.groupBy(column).agg(F.sum(target).alias("_sum"), F.count(target).alias("_rows"))
    overall = rows.agg(F.avg(target)).scalar()
    return sums.withColumn("_mean", overall).select(
        column,
        (F.try_divide(F.col("_sum") + weight * F.col("_mean"), F.col("_rows") + weight)).alias(f"{column}_mean"),
    )


def encode_by_mean(features, means, column, default):
    """Add ``<column>_mean`` by join; a category without one gets ``default``."""
    return features.join(means, column, "left").withColumn(
        f"{column}_mean", F.coalesce(f"{column}_mean", F.lit(default).cast("double"))
    )


def fold_means(rows, column, fold, target=TARGET, weight=20):
    """Add ``<column>_mean``: the mean target of the row's category over all folds but its own.

    A model that trains on means of its own rows learns how often they were seen; with folds
    no row's target is in its own encoding. ``fold`` is an expression of few values. Means
    are drawn towards the other folds' overall mean by ``weight`` rows, which is also what a
    category of one fold gets. Sums are partial before the shuffle; only one row per fold
    is broadcast.
    """
    rows = rows.withColumn("_fold", F.coalesce(fold, F.lit(0)))
    own = rows.groupBy(column, "_fold").agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    category = Window.partitionBy(column)  # at most one row per fold
    own = own.withColumns({"_cs": F.sum("_s").over(category) - F.coalesce("_s", F.lit(0)), "_cn": F.sum("_n").over(category) - F.col("_n")})
    overall = rows.agg(F.sum(target)).scalar(), rows.agg(F.count(target)).scalar()
    folds = (
        rows.groupBy("_fold")
        .agg(F.coalesce(F.sum(target), F.lit(0)).alias("_fs"), F.count(target).alias("_fn"))
        .select("_fold", F.try_divide(overall[0] - F.col("_fs"), overall[1] - F.col("_fn")).alias("_rest"))
    )
    mean = F.try_divide(F.coalesce("_cs", F.lit(0)) + weight * F.col("_rest"), F.col("_cn") + weight)
    joined = rows.join(own.select(F.col(column).alias("_category"), F.col("_fold").alias("_own_fold"), "_cs", "_cn"),
                       F.col(column).eqNullSafe(F.col("_category")) & (F.col("_fold") == F.col("_own_fold")))
    return joined.join(F.broadcast(folds), "_fold").select(*[c for c in rows.columns if c != "_fold"], mean.alias(f"{column}_mean"))
