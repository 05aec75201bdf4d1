"""Layer, report and export sinks. Each layer writer returns the row count read back."""

from pyspark.sql import functions as F


def _confirmed(spark, path):
    return spark.read.parquet(path).count()


def write_plain(df, path):
    df.write.mode("overwrite").parquet(path)
    return _confirmed(df.sparkSession, path)


def _by_store(df, sort):
    """Writer of a layer partitioned by store.

    Rebalancing gathers a store's rows into few files and lets adaptive execution
    split a store that holds far more rows than the others over several tasks.
    """
    order = ["store", *[c for c in sort if c != "store"]]
    return df.hint("rebalance", F.col("store")).sortWithinPartitions(*order).write.partitionBy("store")


def write_by_store(df, path, sort=()):
    """Overwrite a layer partitioned by store."""
    _by_store(df, sort).mode("overwrite").parquet(path)
    return _confirmed(df.sparkSession, path)


def replace_stores(df, path, sort=()):
    """Overwrite the partitions of the stores in ``df``, a stored table, and no others."""
    _by_store(df, sort).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return df.count()


def add_by_store(df, path, sort=()):
    """Add files to the partitions of the stores in ``df``, a stored table."""
    _by_store(df, sort).mode("append").parquet(path)
    return df.count()


def sorted_for_export(df, sort, drop=()):
    """Rows in a total order: ties on ``sort`` are settled by the other columns, so
    many rows under one key still spread over range partitions."""
    kept = df.drop(*drop)
    return kept.orderBy(*sort, *[c for c in kept.columns if c not in sort])


def export_csv(df, path, sort=(), drop=()):
    """Sorted CSV files with headers; part files in name order hold the rows in order."""
    rows = sorted_for_export(df, sort, drop) if sort else df.drop(*drop)
    rows.write.mode("overwrite").option("header", "true").csv(path)


def write_metrics(metrics, csv_path, lake_path=None):
    """Metric rows as CSV and, optionally, once more as parquet in the lake."""
    metrics.write.mode("overwrite").option("header", "true").csv(csv_path)
    if lake_path:
        metrics.write.mode("overwrite").parquet(lake_path)


def append_check_log(checks, path):
    """Add (model, rmse, mae, drift_detected) rows to the monitoring log."""
    (
        checks.select(
            F.current_timestamp().alias("timestamp"), "model", "rmse", "mae", "drift_detected"
        )
        .write.mode("append")
        .parquet(path)
    )
