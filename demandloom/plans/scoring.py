"""Score uploaded daily rows with stored models."""

from pyspark.sql import functions as F

from ..columns import BASE_YEAR, SERIES, TARGET, WEEK_KEY, WEEKLY_COLUMNS
from ..operators import trees
from ..operators.cleaning import clean_daily
from ..operators.features import calendar_features, history_features
from ..operators.seasonal import score_weeks
from ..operators.selection import filter_predictions
from ..operators.weekly import to_weekly, week_keys
from ..sources.readers import daily_upload
from ..sources.writers import export_csv


def export_filtered(predictions, path, **bounds):
    """Write the predictions inside ``bounds`` (see ``filter_predictions``) as sorted CSV."""
    export_csv(filter_predictions(predictions, **bounds), path, sort=(*SERIES, "year", "week"))


def score_upload(upload, holidays, models):
    """sales_prediction per series and week of the upload. Series without a stored
    model and rows without a readable date are left out."""
    dated = daily_upload(upload).where(F.col("date").isNotNull())
    weekly = to_weekly(clean_daily(dated, holidays))
    weeks = week_keys(weekly).select(*SERIES, "year", F.col("week_of_year").alias("week"))
    return score_weeks(weeks, models)


def score_by_nodes(upload, holidays, history, nodes, base_year=BASE_YEAR):
    """sales_prediction per series and week of the upload from a stored node table of trees.

    ``history`` is the weekly layer: lags and averages of an uploaded week come from its stored
    rows, and are null where it has none, which a tree answers like a value above every limit.
    Only series of the upload are read on. No trained session, encoder or MLlib model is asked.
    """
    dated = daily_upload(upload).where(F.col("date").isNotNull())
    asked = to_weekly(clean_daily(dated, holidays)).drop(TARGET)
    stored = history.select(*WEEKLY_COLUMNS).join(week_keys(asked).select(*SERIES).distinct(), list(SERIES), "left_semi")
    known = stored.join(asked.select(*WEEK_KEY), list(WEEK_KEY), "left_anti").withColumn("_asked", F.lit(False))
    weeks = asked.join(stored.select(*WEEK_KEY, TARGET), list(WEEK_KEY), "left").withColumn("_asked", F.lit(True))
    rows = history_features(calendar_features(known.unionByName(weeks), base_year)).where("_asked")
    return trees.score(rows, nodes).select(
        *SERIES, "year", F.col("week_of_year").alias("week"), F.col("prediction").alias("sales_prediction")
    )
