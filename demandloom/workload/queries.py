"""Every operator as a query over the star-schema tables."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..columns import GOLD_SCALARS, HISTORY_COLUMNS, SCALAR_FEATURES, SERIES, TARGET, WEEK_KEY
from ..functions import exact_percentiles, iso_monday
from ..operators import (
    alignment,
    arima,
    arima_exact,
    cleaning,
    evaluation,
    exploration,
    features,
    monitoring,
    regression,
    ridge,
    seasonal,
    selection,
    trees,
    validation,
    weekly as rollup,
)
from ..plans.lake import build_lake, layer_paths, update_lake
from ..plans.monitoring import check_forecaster
from ..plans.scoring import export_filtered, score_by_nodes, score_upload
from ..plans.training import train_and_compare
from ..session import shared_folder
from ..sources import (
    daily_upload,
    export_csv,
    holiday_dates,
    read_layer,
    read_metrics,
    read_raw_sales,
    read_rejected,
    rejected_dates,
    write_metrics,
    write_plain,
)
from ..sources.star import (
    BASE_YEAR,
    DATE_RANGE,
    ITEM_RANGE,
    STORE_RANGE,
    TEST_YEAR,
    TRAIN_UNTIL,
    dirty_sales,
    holiday_rows,
    sales_daily,
)
from ..sources.writers import sorted_for_export, write_by_store
from . import given


# Shared inputs ---------------------------------------------------------------


def holidays(spark, d):
    return holiday_dates(holiday_rows(spark, d))


def daily(spark, d):
    return cleaning.clean_daily(sales_daily(spark, d), holidays(spark, d))


def weekly(spark, d):
    return rollup.to_weekly(daily(spark, d))


def historic(spark, d):
    return features.history_features(features.calendar_features(weekly(spark, d), BASE_YEAR))


def gold_scalars(spark, d):
    return features.feature_rows(weekly(spark, d), BASE_YEAR)


def stored_gold(spark, d):
    """The gold layer over features written once: encoder and models read them often."""
    path = shared_folder(spark, "features")
    write_by_store(gold_scalars(spark, d), path, sort=("year", *WEEK_KEY))
    rows = read_layer(spark, path, GOLD_SCALARS)
    train, _ = selection.split_by_year(rows, TRAIN_UNTIL, TEST_YEAR)
    return features.encode(rows, features.fit_encoder(train))


def split(spark, d, train_until=TRAIN_UNTIL, test_year=TEST_YEAR):
    return selection.split_by_year(alignment.keyed(gold_scalars(spark, d)), train_until, test_year)


def naive_forecasts(spark, d, train_until=TRAIN_UNTIL, test_year=TEST_YEAR):
    return alignment.last_value_forecast(*split(spark, d, train_until, test_year))


def predictions(spark, d):
    """Last-value forecasts of the test year under the column names of scored uploads."""
    return naive_forecasts(spark, d).select(
        *SERIES, "year", F.col("week_of_year").alias("week"), F.col("prediction").alias("sales_prediction")
    )


def metric_rows(spark, d, train_until=TRAIN_UNTIL, test_year=TEST_YEAR):
    """Metric rows of five forecasters, whose predictions stand side by side on one pass
    over the test rows. ARIMA coefficients come with the last value of the series."""
    train, test = split(spark, d, train_until, test_year)
    rows = alignment.with_step(test, "lag_52_week", *HISTORY_COLUMNS[3:]).join(
        arima.fit_arima(train), list(SERIES), "left"
    )
    return evaluation.metrics_side_by_side(
        rows,
        {
            "LastValue": F.col("last_value"),
            "ARIMA": arima.arima_value(F.col("h")),
            "SameWeekLastYear": F.col("lag_52_week"),
            "TrailingMonth": F.col("rolling_4_week_avg"),
            "TrailingQuarter": F.col("rolling_12_week_avg"),
        },
        drop_missing=("LastValue", "ARIMA"),
    )


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Queries ---------------------------------------------------------------------


def layer_scan(spark, d):
    return read_layer(
        spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity"]
    )


def scoring_input(spark, d):
    """The clean daily rows as an upload in three date spellings, without sales."""
    spelled = F.array(
        F.date_format("date", "dd/MM/yyyy"), F.date_format("date", "dd-MM-yyyy"), F.date_format("date", "yyyy-MM-dd")
    )
    upload = sales_daily(spark, d).select(
        F.get(spelled, F.pmod("item", F.lit(3))).alias("date"), "store", "item"
    )
    return daily_upload(upload)


def upload(spark, d):
    return sales_daily(spark, d).where(F.year("date") == TEST_YEAR).select(
        F.date_format("date", "dd/MM/yyyy").alias("date"), "store", "item"
    )


def date_guard(spark, d):
    text = sales_daily(spark, d).withColumn("date", F.col("date").cast("string"))
    return cleaning.ensure_date(text)


def chronological_split(spark, d):
    train, test = selection.split_by_year(weekly(spark, d), TRAIN_UNTIL, TEST_YEAR)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def validation_verdict(spark, d):
    expected = sales_daily(spark, d).agg(F.count(F.lit(1)).alias("n")).scalar()
    return validation.validation_report(
        dirty_sales(spark, d), expected, STORE_RANGE, ITEM_RANGE, DATE_RANGE
    )


def validation_verdict_clean(spark, d):
    """Clean rows against 100, 96 and 94 per cent of the rows that the lines must give.

    That number is counted on the lines and dimension keys themselves, apart from the mapping.
    """
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_shipdate", "l_suppkey", "l_partkey")
    regions = spark.read.parquet(f"{d}/supplier.parquet").join(
        spark.read.parquet(f"{d}/nation.parquet"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    brands = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_brand")
    counted = (
        lines.join(regions, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(brands, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select("l_shipdate", "n_regionkey", "p_brand")
        .distinct()
        .agg(F.count(F.lit(1)).alias("n"))
        .scalar()
    )
    report = validation.validation_report(
        sales_daily(spark, d), 1, STORE_RANGE, ITEM_RANGE, DATE_RANGE
    ).drop("passed")
    shares = report.withColumn("share", F.explode(F.array(F.lit(100), F.lit(96), F.lit(94))))
    expected = F.floor(counted * 100 / F.col("share"))
    counts = [c for c in report.columns if c != "row_count"]
    return validation.with_verdict(shares, expected, 0.05, counts)


def iso_week_dates(spark, d):
    keys = weekly(spark, d)
    return keys.select(*WEEK_KEY, iso_monday(F.col("year"), F.col("week_of_year")).alias("week_date"))


def lag_features(spark, d):
    return historic(spark, d).select(*WEEK_KEY, TARGET, *HISTORY_COLUMNS[:3])


def trailing_averages(spark, d):
    return rounded(historic(spark, d).select(*WEEK_KEY, TARGET, *HISTORY_COLUMNS[3:]), *HISTORY_COLUMNS[3:])


def gold_projection(spark, d):
    return rounded(gold_scalars(spark, d), *HISTORY_COLUMNS[3:])


def prediction_filter(spark, d):
    return selection.filter_predictions(
        predictions(spark, d), year=TEST_YEAR, stores=[1, 2], items=[], weeks=(10, 30)
    )


def prediction_actual_join(spark, d):
    return monitoring.match_actuals(predictions(spark, d), weekly(spark, d))


def model_lookup(spark, d):
    """Rows of the test year looked up in the models of the series seen in training."""
    train, _ = split(spark, d)
    rows = weekly(spark, d).where(F.col("year") == TEST_YEAR)
    return rows.select(*WEEK_KEY).join(alignment.last_values(train), list(SERIES))


def baseline_lookup(spark, d):
    current = metric_rows(spark, d).select("model", "rmse")
    stored = metric_rows(spark, d, TRAIN_UNTIL - 1, TEST_YEAR - 1).where(F.col("model") != "ARIMA")
    return monitoring.with_baseline(current, stored)


def performance_drift(spark, d):
    current = metric_rows(spark, d).select("model", "rmse")
    stored = metric_rows(spark, d, TRAIN_UNTIL - 1, TEST_YEAR - 1)
    return rounded(monitoring.performance_drift(current, stored), "degradation", digits=4)


def describe(df, columns):
    return rounded(rollup.describe_columns(df, columns), "mean", "stddev", "min", "max", digits=4)


def metrics_without_missing(spark, d):
    """Forecasts of only 20 steps: the rows past them are left out of the errors."""
    train, test = split(spark, d)
    short = alignment.last_value_forecast(train, test, horizon=20)
    return evaluation.forecast_metrics(short, model="LastValue", drop_missing=True)


def forecast_union(spark, d):
    train, test = split(spark, d)
    named = [
        alignment.last_value_forecast(train, test).withColumn("model", F.lit("LastValue")),
        arima.arima_forecast(train, test).withColumn("model", F.lit("ARIMA")),
    ]
    return rounded(evaluation.union_all(named), "prediction", digits=4)


def arima_models(spark, d):
    train, _ = split(spark, d)
    models = arima.fit_arima(train).select(
        *SERIES,
        F.get("phi", F.lit(0)).alias("phi"),
        F.get("theta", F.lit(0)).alias("theta"),
        "last_value",
        F.get("values", F.lit(0)).alias("last_diff"),
        F.get("residuals", F.lit(0)).alias("last_residual"),
        "used_rows",
    )
    return rounded(models, "phi", "theta", "last_residual", digits=4)


def distribution_drift(spark, d):
    old, new = F.col("year") <= TRAIN_UNTIL, F.col("year") == TEST_YEAR
    return rounded(monitoring.distribution_drift(weekly(spark, d), old, new), "statistic", "p_value")


def monitor_check(spark, d):
    stored = metric_rows(spark, d, TRAIN_UNTIL - 1, TEST_YEAR - 1)
    check = check_forecaster(
        "LastValue", predictions(spark, d), weekly(spark, d), stored, dirty_sales(spark, d)
    )
    return rounded(check, "rmse", "mae", "degradation", digits=4)


def one_hot_features(spark, d):
    return stored_gold(spark, d).select(*WEEK_KEY, "store_idx", "item_idx", "store_ohe", "item_ohe")


def assembled_features(spark, d):
    return regression.assembler().transform(stored_gold(spark, d)).select(*WEEK_KEY, TARGET, "features")


def regressor(name, **settings):
    def run(spark, d):
        train, test = selection.split_by_year(stored_gold(spark, d), TRAIN_UNTIL, TEST_YEAR)
        model = regression.Regressor(name, **settings).fit(train)
        return model.predict(test).select(*WEEK_KEY, TARGET, F.round("prediction", 4).alias("prediction"))

    return run


def linear_regression(spark, d):
    """Ridge by elimination of the item effects; equal to MLlib's, without one-hot vectors."""
    train, test = split(spark, d)
    found = ridge.fit_ridge(train).predict(test)
    return rounded(found.select(*WEEK_KEY, F.col(TARGET), "prediction"), "prediction", digits=4)


def item_fold_means(spark, d):
    train, _ = split(spark, d)
    means = features.fold_means(train, "item", F.pmod("abs_week", F.lit(regression.FOLDS)))
    return rounded(means.select(*WEEK_KEY, "item_mean"), "item_mean")


def mean_encoded_regression(spark, d):
    """A regressor whose stores and items are one number each."""
    train, test = split(spark, d)
    found = regression.Regressor("LinearRegression", encoder="means").fit(train).predict(test)
    return rounded(found.select(*WEEK_KEY, TARGET, "prediction"), "prediction", digits=4)


#: Inputs of few values, which trees cut half way between neighbours.
FEW_VALUED = ("week_of_year", "week_has_holiday", "month", "quarter", "is_year_end", "store_ohe", "item_ohe")
ONE_TREE = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 2, "maxBins": 64}
FEW_ROUNDS = {"maxIter": 3, "maxDepth": 2, "maxBins": 64}


def small_fit(name, settings):
    """A tree model of few, unsampled choices, whose fit another engine can work out."""

    def run(spark, d):
        train, test = selection.split_by_year(stored_gold(spark, d), TRAIN_UNTIL, TEST_YEAR)
        model = regression.Regressor(name, inputs=FEW_VALUED, **settings).fit(train)
        found = trees.score(test.select(*GOLD_SCALARS), model.nodes(train))
        return rounded(found.select(*WEEK_KEY, TARGET, "prediction"), "prediction", digits=4)

    return run


def forest_tables(spark, d):
    """Forest and boosted trees of full size: rows and slots where the node table differs from the model."""
    rows = stored_gold(spark, d)
    train, test = selection.split_by_year(rows, TRAIN_UNTIL, TEST_YEAR)
    found = []
    for name in ("RandomForest", "GradientBoosting"):
        model = regression.Regressor(name).fit(train)
        path = shared_folder(spark, "nodes")
        write_plain(model.nodes(train), path)
        nodes = spark.read.schema(trees.NODE_DDL).parquet(path)
        own = model.predict(test).select(*WEEK_KEY, F.col("prediction").alias("own"))
        both = trees.score(test.select(*GOLD_SCALARS), nodes).join(own, list(WEEK_KEY))
        slots = F.when(F.col("category").isNull(), F.col("column")).otherwise(F.concat_ws("_ohe_", "column", "category"))
        shares = trees.importances(nodes, per_tree=name == "RandomForest").select(slots.alias("feature"), F.col("importance").alias("own"))
        listed = model.importances(rows).join(shares, "feature", "left")
        apart = lambda a, b: F.count_if(F.abs(F.col(a) - F.coalesce(F.col(b), F.lit(0.0))) > 1e-9)
        found.append(
            both.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("rows"), apart("own", "prediction").alias("rows_apart")).withColumn(
                "slots_apart", listed.agg(apart("importance", "own")).scalar()
            )
        )
    return evaluation.union_all(found)


def given_nodes(spark):
    return spark.createDataFrame(given.FOREST, trees.NODE_DDL)


def given_forest_scores(spark, d):
    found = trees.score(gold_scalars(spark, d), given_nodes(spark))
    return rounded(found.select(*WEEK_KEY, "prediction"), "prediction")


def given_forest_walk(spark, d):
    """The same forest walked level by level in joins."""
    found = trees.score_by_joins(gold_scalars(spark, d), given_nodes(spark), WEEK_KEY, SCALAR_FEATURES, SERIES, depth=3)
    return rounded(found, "prediction")


def given_forest_importances(spark, d):
    """Share of every question's column in the gain, on the rows that the gold layer sends through the forest."""
    nodes = given_nodes(spark)
    seen = gold_scalars(spark, d).agg(F.count(F.lit(1))).scalar()
    scaled = nodes.withColumn("rows", F.col("rows") * seen)
    return rounded(trees.importances(scaled), "importance")


def upload_forest_scores(spark, d):
    """Uploaded weeks scored by a stored forest over the weekly layer's history."""
    path = shared_folder(spark, "nodes")
    write_plain(given_nodes(spark), path)
    nodes = spark.read.schema(trees.NODE_DDL).parquet(path)
    found = score_by_nodes(upload(spark, d), holidays(spark, d), weekly(spark, d), nodes, BASE_YEAR)
    return rounded(found, "sales_prediction")


def feature_importances(spark, d):
    rows = stored_gold(spark, d)
    train, _ = selection.split_by_year(rows, TRAIN_UNTIL, TEST_YEAR)
    model = regression.Regressor("RandomForest").fit(train)
    return model.importances(rows, n=10)


def model_training(spark, d):
    return train_and_compare(
        stored_gold(spark, d),
        shared_folder(spark, "training"),
        TRAIN_UNTIL,
        TEST_YEAR,
    )


def seasonal_models(spark, d):
    train, _ = split(spark, d)
    return seasonal.fit_seasonal(train)


def seasonal_forecast(spark, d):
    return rounded(seasonal.seasonal_forecast(*split(spark, d)), "prediction", digits=4)


def upload_scoring(spark, d):
    train, _ = selection.split_by_year(weekly(spark, d), TRAIN_UNTIL, TEST_YEAR)
    scored = score_upload(upload(spark, d), holidays(spark, d), seasonal.fit_seasonal(train))
    return rounded(scored, "sales_prediction", digits=4)


def lake_build(spark, d):
    """Write all layers, then read back rows and sales of each."""
    root = shared_folder(spark, "lake")
    build_lake(spark, root, holidays(spark, d), BASE_YEAR, raw=dirty_sales(spark, d))
    sums = {
        "bronze/raw_sales": "sales",
        "silver/daily_sales": "sales",
        "silver/weekly_sales": TARGET,
        "gold/features": TARGET,
    }
    return evaluation.union_all(
        [
            read_layer(spark, f"{root}/{layer}").agg(
                F.lit(layer).alias("layer"),
                F.count(F.lit(1)).alias("rows"),
                F.sum(column).alias("total_sales"),
            )
            for layer, column in sums.items()
        ]
    )


def lake_gold(spark, d):
    """Gold scalars read back from a lake of clean rows that passed the checks."""
    root, rows = shared_folder(spark, "lake"), sales_daily(spark, d)
    checks = {
        "expected_rows": rows.agg(F.count(F.lit(1))).scalar(),
        "stores": STORE_RANGE,
        "items": ITEM_RANGE,
        "dates": DATE_RANGE,
    }
    build_lake(spark, root, holidays(spark, d), BASE_YEAR, raw=rows, checks=checks, train_until=TRAIN_UNTIL)
    return rounded(read_layer(spark, layer_paths(root)["gold"], GOLD_SCALARS), *HISTORY_COLUMNS[3:])


def lake_increment(spark, d):
    """Gold of a lake that got its last months, and the first days of a store, in two later steps."""
    root, rows, off = shared_folder(spark, "lake"), sales_daily(spark, d), holidays(spark, d)
    middle, last = F.lit("2000-05-17").cast("date"), F.lit("2000-11-02").cast("date")
    steps = [
        rows.where(F.col("date") < middle),
        rows.where(F.col("date").between(middle, last) & (F.col("store") != 2)),
        rows.where((F.col("date") > last) | ((F.col("date") >= middle) & (F.col("store") == 2))),
    ]
    build_lake(spark, root, off, BASE_YEAR, raw=steps[0], train_until=TRAIN_UNTIL)
    for step in steps[1:]:
        update_lake(spark, root, step, off, BASE_YEAR, TRAIN_UNTIL)
    return rounded(read_layer(spark, layer_paths(root)["gold"], GOLD_SCALARS), *HISTORY_COLUMNS[3:])


#: Faults put into raw CSV lines, by place of the row; the first that fits is the one made.
FAULTS = {"date": 97, "store": 89, "too few fields": 83, "sales": 79, "too many fields": 73}


def raw_csv(spark, d):
    """Daily rows as raw CSV lines, some of them broken."""
    k = F.date_diff("date", F.lit("1995-01-01").cast("date")) * 300 + F.col("store") * 60 + F.col("item")
    date, store, item, sales = (F.col(c).cast("string") for c in ("date", "store", "item", "sales"))
    broken = {
        "date": F.concat_ws(",", F.translate(date, "-", "/"), store, item, sales),
        "store": F.concat_ws(",", date, F.concat(F.lit("s"), store), item, sales),
        "too few fields": F.concat_ws(",", date, store, item),
        "sales": F.concat_ws(",", date, store, item, F.concat(sales, F.lit(" pcs"))),
        "too many fields": F.concat_ws(",", date, store, item, sales, F.lit("1")),
    }
    line = F.concat_ws(",", date, store, item, sales)
    for name, every in reversed(FAULTS.items()):
        line = F.when(k % every == 0, broken[name]).otherwise(line)
    path = shared_folder(spark, "raw-csv")
    header = spark.createDataFrame([("date,store,item,sales",)], "value string")
    header.unionByName(sales_daily(spark, d).select(line.alias("value"))).write.text(path)
    return path


def raw_csv_scan(spark, d):
    return read_raw_sales(spark, raw_csv(spark, d), shared_folder(spark, "rejected"))


def rejected_raw_rows(spark, d):
    """How many lines were written aside, by reason, and one of each."""
    path = shared_folder(spark, "rejected")
    read_raw_sales(spark, raw_csv(spark, d), path)
    return read_rejected(spark, path).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"), F.min("line").alias("first_line"))


def sketch_drift(spark, d):
    """Drift from stored sketches of the old and the new weeks, against the exact statistic."""
    old, new = F.col("year") <= TRAIN_UNTIL, F.col("year") == TEST_YEAR
    path, rows, column = shared_folder(spark, "sketches"), gold_scalars(spark, d), "rolling_4_week_avg"
    # One sketch per year, as a lake of sketches would hold; rounds merge them and read no old row.
    write_plain(monitoring.sketched(rows, [column, TARGET], by=["year"]), path)
    stored = spark.read.parquet(path)
    found = monitoring.sketch_drift(monitoring.merged_sketches(stored.where(old)), monitoring.merged_sketches(stored.where(new)))
    exact = evaluation.union_all(
        [
            monitoring.distribution_drift(rows, old, new, value=c).select(F.lit(c).alias("column"), F.col("statistic").alias("exact"))
            for c in (column, TARGET)
        ]
    )
    near = F.abs(F.col("statistic") - F.col("exact")) <= monitoring.sketch_error()
    return rounded(
        found.join(exact, "column").select("column", "exact", near.alias("within"), "reference_rows", "current_rows"), "exact"
    )


def given_seasonal_scores(spark, d):
    """One seasonal model of all 47 kinds of terms scored on every week of every series."""
    rows = gold_scalars(spark, d)
    models = rows.select(*SERIES).distinct().select(
        *SERIES,
        F.array(*map(F.lit, given.SEASONAL_COEFFICIENTS)).alias("coefficients"),
        F.array(*map(F.lit, given.SEASONAL_BENDS)).alias("bends"),
    )
    return rounded(seasonal.forecast_from(models, rows), "prediction")


def arima_deviance(spark, d):
    """Exact likelihood of the two-step estimates, and whether the exact fit is as good or better."""
    train, _ = split(spark, d)
    place = F.struct("year", "week_of_year", F.col(TARGET).cast("double").alias("y"))
    weeks = train.groupBy(*SERIES).agg(F.sort_array(F.collect_list(place)).alias("weeks"))
    y = F.col("weeks.y")
    changes = F.zip_with(F.slice(y, F.lit(2), F.size(y) - 1), F.slice(y, F.lit(1), F.size(y) - 1), lambda b, a: b - a)
    started = arima.fit_arima(train).where("phi is not null")
    phi, theta = F.get("phi", F.lit(0)), F.get("theta", F.lit(0))
    value = F.when(F.abs(theta) < 1, arima_exact.deviance_of(changes, phi, theta))
    path = shared_folder(spark, "arima-exact")
    write_plain(arima_exact.fit_exact(train), path)
    exact = spark.read.parquet(path).select(*SERIES, F.col("deviance").alias("_exact"))
    return rounded(
        weeks.join(started, list(SERIES)).join(exact, list(SERIES)).select(
            *SERIES, value.alias("deviance"), F.coalesce(F.col("_exact") <= value + 1e-9, F.lit(True)).alias("exact_is_as_good")
        ),
        "deviance",
        digits=4,
    )


def arima_exact_models(spark, d):
    train, _ = split(spark, d)
    path = shared_folder(spark, "arima-exact")
    write_plain(arima_exact.fit_exact(train), path)
    return spark.read.parquet(path)


def arima_exact_forecast(spark, d):
    train, test = split(spark, d)
    path = shared_folder(spark, "arima-exact")
    write_plain(arima_exact.fit_exact(train), path)
    return rounded(arima.forecast_from(spark.read.parquet(path), test), "prediction", digits=4)


def csv_round_trip(spark, d):
    """Daily rows through sorted CSV files and back."""
    path = shared_folder(spark, "csv")
    rows = daily(spark, d)
    export_csv(rows, path, sort=["date", "store", "item"])
    return spark.read.csv(path, schema=rows.schema, header=True)


def filtered_export(spark, d):
    path = shared_folder(spark, "export")
    rows = predictions(spark, d)
    export_filtered(rows, path, year=TEST_YEAR, stores=[1, 2], items=[], weeks=(10, 30))
    return spark.read.csv(path, schema=rows.schema, header=True)


def metrics_round_trip(spark, d):
    path = shared_folder(spark, "metrics")
    write_metrics(metric_rows(spark, d), path)
    return read_metrics(spark, path)


def check_log(spark, d):
    """The log line of one monitoring round, read from the log."""
    path = shared_folder(spark, "log")
    stored = metric_rows(spark, d, TRAIN_UNTIL - 1, TEST_YEAR - 1)
    check_forecaster(
        "LastValue", predictions(spark, d), weekly(spark, d), stored, dirty_sales(spark, d), path
    )
    return rounded(spark.read.parquet(path).drop("timestamp"), "rmse", "mae", digits=4)


def stored_arima_forecast(spark, d):
    """Forecasts from coefficients that were written and read back."""
    path = shared_folder(spark, "arima")
    train, test = split(spark, d)
    write_plain(arima.fit_arima(train), path)
    return rounded(arima.forecast_from(spark.read.parquet(path), test), "prediction", digits=4)


def stored_regressor(spark, d):
    """Predictions of a regressor and of the same one after saving and loading, compared."""
    path = shared_folder(spark, "regressor")
    train, test = selection.split_by_year(
        stored_gold(spark, d).select(*GOLD_SCALARS), TRAIN_UNTIL, TEST_YEAR
    )
    model = regression.Regressor("LinearRegression").fit(train)
    model.save(path)
    loaded = regression.Regressor.load("LinearRegression", path).predict(test)
    both = model.predict(test).select(*WEEK_KEY, F.col("prediction").alias("own")).join(loaded, list(WEEK_KEY))
    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(F.col("own") - F.col("prediction")) > 1e-9).alias("differing"),
    )


def _hot_slot(vector):
    """Place of the one in a one-hot vector; -1 for a category the encoder has not seen."""
    return (F.array_position(vector_to_array(vector), F.lit(1.0)) - 1).cast("int")


def one_hot_slots(spark, d):
    return stored_gold(spark, d).select(
        *WEEK_KEY,
        _hot_slot("store_ohe").alias("store_slot"),
        _hot_slot("item_ohe").alias("item_slot"),
        F.size(vector_to_array("store_ohe")).alias("store_width"),
        F.size(vector_to_array("item_ohe")).alias("item_width"),
    )


def assembled_values(spark, d):
    """The scalar slots of the feature vector, and where its ones stand."""
    rows = regression.assembler().transform(stored_gold(spark, d)).withColumn("f", vector_to_array("features"))
    n = len(SCALAR_FEATURES)
    tail = F.slice("f", n + 1, F.size("f") - n)
    return rounded(
        rows.select(
            *WEEK_KEY,
            *[F.get("f", F.lit(i)).alias(f"f{i}") for i in range(n)],
            F.size("f").alias("width"),
            F.aggregate(tail, F.lit(0.0), lambda total, x: total + x).cast("int").alias("ones"),
        ),
        f"f{n - 2}",
        f"f{n - 1}",
    )


def constant_model_scores(spark, d):
    """Upload weeks scored with a stored model per series, here the mean of its training rows."""
    train, _ = selection.split_by_year(weekly(spark, d), TRAIN_UNTIL, TEST_YEAR)
    path = shared_folder(spark, "constant")
    write_plain(
        train.groupBy(*SERIES).agg(
            F.array(F.avg(TARGET)).alias("coefficients"), F.array().cast("array<double>").alias("bends")
        ),
        path,
    )
    scored = score_upload(upload(spark, d), holidays(spark, d), spark.read.parquet(path))
    return rounded(scored, "sales_prediction", digits=4)


def rejected_upload_dates(spark, d):
    rows = upload(spark, d)
    unreadable = F.when(F.col("item") % 5 == 0, F.translate("date", "/", "~")).otherwise(F.col("date"))
    return rejected_dates(rows.withColumn("date", unreadable))


def item_target_means(spark, d):
    train, _ = split(spark, d)
    return rounded(features.target_means(train, "item"), "item_mean")


def average_percentiles(spark, d):
    """Percentiles of a column of doubles, overall order statistics without a global sort."""
    cuts = {"p10": 0.1, "median": 0.5, "p90": 0.9}
    return rounded(exact_percentiles(gold_scalars(spark, d), "rolling_4_week_avg", cuts), *cuts)


def average_drift(spark, d):
    old, new = F.col("year") <= TRAIN_UNTIL, F.col("year") == TEST_YEAR
    found = monitoring.distribution_drift(gold_scalars(spark, d), old, new, value="rolling_4_week_avg")
    return rounded(found, "statistic", "p_value")


def queries():
    return {
        "lake_gold": lake_gold,
        "lake_increment": lake_increment,
        "raw_csv_scan": raw_csv_scan,
        "rejected_raw_rows": rejected_raw_rows,
        "csv_round_trip": csv_round_trip,
        "filtered_export": filtered_export,
        "metrics_round_trip": metrics_round_trip,
        "check_log": check_log,
        "stored_arima_forecast": stored_arima_forecast,
        "stored_regressor": stored_regressor,
        "one_hot_slots": one_hot_slots,
        "assembled_values": assembled_values,
        "constant_model_scores": constant_model_scores,
        "rejected_upload_dates": rejected_upload_dates,
        "item_target_means": item_target_means,
        "average_percentiles": average_percentiles,
        "average_drift": average_drift,
        # scans and sinks
        "holiday_scan": holidays,
        "layer_scan": layer_scan,
        "scoring_input": scoring_input,
        "csv_export_order": lambda s, d: sorted_for_export(daily(s, d), ["date", "store", "item"]),
        "lake_build": lake_build,
        # projections and filters
        "date_guard": date_guard,
        "nonnegative_sales": lambda s, d: cleaning.keep_nonnegative(dirty_sales(s, d)),
        "chronological_split": chronological_split,
        "split_report": lambda s, d: selection.split_report(gold_scalars(s, d), TRAIN_UNTIL, TEST_YEAR),
        "warmup_filter": lambda s, d: features.drop_warmup(historic(s, d)).select(*WEEK_KEY, TARGET),
        "warmup_report": lambda s, d: features.warmup_report(historic(s, d)),
        "gold_projection": gold_projection,
        "prediction_filter": prediction_filter,
        "single_series": lambda s, d: rounded(
            selection.single_series(gold_scalars(s, d), 1, 1), *HISTORY_COLUMNS[3:]
        ),
        # joins
        "holiday_enrichment": daily,
        "prediction_actual_join": prediction_actual_join,
        "forecast_alignment": lambda s, d: alignment.last_value_forecast(*split(s, d), horizon=20),
        "model_lookup": model_lookup,
        "baseline_lookup": baseline_lookup,
        # aggregations
        "weekly_rollup": weekly,
        "null_profile": lambda s, d: validation.null_profile(dirty_sales(s, d)),
        "range_violations": lambda s, d: validation.range_violations(
            dirty_sales(s, d), STORE_RANGE, ITEM_RANGE, DATE_RANGE
        ),
        "validation_verdict": validation_verdict,
        "validation_verdict_clean": validation_verdict_clean,
        "holiday_day_distribution": lambda s, d: rollup.flag_distribution(daily(s, d), "is_holiday"),
        "holiday_week_distribution": lambda s, d: rollup.flag_distribution(
            weekly(s, d), "week_has_holiday"
        ),
        "weekly_describe": lambda s, d: describe(weekly(s, d), [TARGET]),
        "gold_describe": lambda s, d: describe(
            gold_scalars(s, d), [TARGET, "lag_1_week", "lag_52_week", *HISTORY_COLUMNS[3:]]
        ),
        "rows_per_year": lambda s, d: rollup.rows_per_year(gold_scalars(s, d)),
        "cleaning_report": lambda s, d: cleaning.cleaning_report(dirty_sales(s, d), holidays(s, d)),
        "series_catalogue": lambda s, d: rollup.series_catalogue(weekly(s, d)),
        "test_lengths": lambda s, d: alignment.test_lengths(*split(s, d)),
        # windows
        "lag_features": lag_features,
        "trailing_averages": trailing_averages,
        "weekly_totals": lambda s, d: exploration.weekly_totals(weekly(s, d)),
        "model_ranking": lambda s, d: evaluation.rank_models(metric_rows(s, d)),
        "first_week_places": lambda s, d: exploration.first_week_places(weekly(s, d)),
        "last_value_forecast": naive_forecasts,
        # sorts and top-k
        "canonical_sort": lambda s, d: weekly(s, d).orderBy(*WEEK_KEY),
        "top_items": lambda s, d: exploration.top_items(weekly(s, d)),
        "bottom_items": lambda s, d: exploration.bottom_items(weekly(s, d)),
        "predicted_totals_by_item": lambda s, d: selection.predicted_totals(predictions(s, d), "item"),
        "predicted_totals_by_store": lambda s, d: selection.predicted_totals(predictions(s, d), "store"),
        "feature_importances": feature_importances,
        "model_comparison": lambda s, d: evaluation.compare_models(metric_rows(s, d), exclude=["ARIMA"]),
        "head_sample": lambda s, d: rollup.head_sample(daily(s, d), ["date", "store", "item"], 15),
        # set operations
        "whole_row_dedup": lambda s, d: cleaning.drop_repeats(dirty_sales(s, d)),
        "week_keys": lambda s, d: rollup.week_keys(weekly(s, d)),
        "forecast_union": forecast_union,
        # calendar
        "calendar_features": lambda s, d: features.calendar_features(weekly(s, d), BASE_YEAR),
        "iso_week_dates": iso_week_dates,
        # transformers and regressors
        "store_index": lambda s, d: features.category_index(gold_scalars(s, d), "store"),
        "item_index": lambda s, d: features.category_index(gold_scalars(s, d), "item"),
        "one_hot_features": one_hot_features,
        "assembled_features": assembled_features,
        "linear_regression": linear_regression,
        "item_fold_means": item_fold_means,
        "mean_encoded_regression": mean_encoded_regression,
        "tree_fit": small_fit("RandomForest", ONE_TREE),
        "boosted_fit": small_fit("GradientBoosting", FEW_ROUNDS),
        "forest_tables": forest_tables,
        "given_forest_scores": given_forest_scores,
        "given_forest_walk": given_forest_walk,
        "given_forest_importances": given_forest_importances,
        "upload_forest_scores": upload_forest_scores,
        "random_forest": regressor("RandomForest"),
        "gradient_boosting": regressor("GradientBoosting"),
        "model_training": model_training,
        # per-series forecasting
        "arima_models": arima_models,
        "arima_forecast": lambda s, d: rounded(
            arima.arima_forecast(*split(s, d)), "prediction", digits=4
        ),
        "arima_deviance": arima_deviance,
        "arima_exact_models": arima_exact_models,
        "arima_exact_forecast": arima_exact_forecast,
        "given_seasonal_scores": given_seasonal_scores,
        "seasonal_models": seasonal_models,
        "seasonal_forecast": seasonal_forecast,
        "upload_scoring": upload_scoring,
        # evaluation and monitoring
        "forecast_metrics": metric_rows,
        "metrics_without_missing": metrics_without_missing,
        "ground_truth_errors": lambda s, d: rounded(
            monitoring.ground_truth_errors(predictions(s, d), weekly(s, d)), "rmse", "mae", digits=4
        ),
        "performance_drift": performance_drift,
        "missing_data_alert": lambda s, d: rounded(
            monitoring.missing_data_alert(dirty_sales(s, d)), "null_share"
        ),
        "distribution_drift": distribution_drift,
        "monitor_check": monitor_check,
        "sketch_drift": sketch_drift,
        # exploration
        "weekly_summary": lambda s, d: exploration.weekly_summary(weekly(s, d)),
        "sales_histogram": lambda s, d: rounded(
            exploration.histogram(weekly(s, d)), "bin_start", "bin_end", "mean", "median", digits=4
        ),
        "monthly_boxes": lambda s, d: rounded(
            exploration.monthly_boxes(weekly(s, d)), "q1", "median", "q3", digits=4
        ),
        "year_week_heat": lambda s, d: rounded(exploration.year_week_heat(weekly(s, d)), "avg_sales", digits=4),
        "year_week_heat_table": lambda s, d: exploration.pivot_weeks(
            exploration.year_week_heat(weekly(s, d)), "year", "week_of_year", digits=4
        ),
        "weekday_week_heat": lambda s, d: rounded(
            exploration.weekday_week_heat(daily(s, d)), "avg_sales", digits=4
        ),
        "weekday_week_heat_table": lambda s, d: exploration.pivot_weeks(
            exploration.weekday_week_heat(daily(s, d)), "day_of_week", "week_iso", digits=4
        ),
        "store_totals": lambda s, d: exploration.store_totals(weekly(s, d)),
        "store_season": lambda s, d: rounded(exploration.store_season(weekly(s, d)), "avg_sales", digits=4),
        "item_volatility": lambda s, d: rounded(
            exploration.item_volatility(weekly(s, d)), "variance", digits=4
        ),
        "correlations": lambda s, d: rounded(exploration.correlations(gold_scalars(s, d)), "r"),
        "lag_pairs": lambda s, d: exploration.lag_pairs(gold_scalars(s, d)),
        "dataset_summary": lambda s, d: rounded(
            exploration.dataset_summary(daily(s, d), weekly(s, d), gold_scalars(s, d)),
            "avg_weekly_sales",
            "holiday_pct",
            digits=4,
        ),
        "predicted_by_week_store": lambda s, d: selection.predicted_by_week(predictions(s, d), "store"),
        "predicted_by_week_item": lambda s, d: selection.predicted_by_week(predictions(s, d), "item"),
        "filter_options": lambda s, d: selection.filter_options(predictions(s, d)),
        "layer_shapes": lambda s, d: exploration.layer_shapes(
            daily=daily(s, d), weekly=weekly(s, d), gold=gold_scalars(s, d)
        ),
    }
