"""One monitoring round: ground truth errors, drift, missing data, log entry."""

from pyspark.sql import functions as F

from ..operators.monitoring import ground_truth_errors, judge_drift, missing_data_alert
from ..session import shared_folder
from ..sources.writers import append_check_log


def check_forecaster(model, predictions, weekly, stored_metrics, upload, log_path=None):
    """One row with the current errors of ``model``, its drift against the stored
    metrics and whether the uploaded rows miss too much. Without matching actuals the
    errors are null, no drift is reported and nothing is logged. More than one stored
    row for the model is an error. A logged check is worked out once: the row is stored,
    and the log and the result read it."""
    several = F.raise_error(F.lit(f"several stored metric rows for {model}"))
    stored = stored_metrics.where(F.col("model") == model)
    baseline = stored.agg(F.when(F.count(F.lit(1)) > 1, several).otherwise(F.max("rmse"))).scalar()
    missing = missing_data_alert(upload).agg(F.max("alert")).scalar()
    current = ground_truth_errors(predictions, weekly).withColumns(
        {"model": F.lit(model), "baseline_rmse": baseline}
    )
    check = judge_drift(current).withColumn("missing_data", missing)
    if log_path:
        spark = check.sparkSession
        path = shared_folder(spark, "check")
        check.write.parquet(path)
        check = spark.read.parquet(path)
        append_check_log(check.where(F.col("matched_rows") > 0), log_path)
    return check
