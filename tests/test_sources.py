import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from demandloom import sources
from demandloom.columns import DAILY_COLUMNS, GOLD_COLUMNS, WEEK_KEY, WEEKLY_COLUMNS
from demandloom.plans import lake
from demandloom.plans.full import first_open_stage, run_all
from demandloom.plans.lake import LAYERS, build_lake, layer_paths, update_lake
from demandloom.plans.training import train_and_compare
from demandloom.operators.trees import NODE_DDL
from demandloom.plans.scoring import export_filtered, score_by_nodes, score_upload
from demandloom.operators.regression import Regressor
from demandloom.session import shared_folder
from helpers import day, holidays, raw, series, tuples


def test_raw_csv_is_typed_and_tolerant(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("date,store,item,sales\n2013-01-01,1,2,3\nnot a date,1,x,4\n")
    rows = sources.read_raw_sales(spark, str(path))
    assert dict(rows.dtypes) == {"date": "date", "store": "int", "item": "int", "sales": "int"}
    assert tuples(rows) == [(day("2013-01-01"), 1, 2, 3), (None, 1, None, 4)]
    with pytest.raises(AnalysisException):
        sources.read_raw_sales(spark, str(tmp_path / "absent.csv"))


def test_rejected_lines_are_kept_with_their_reason(spark, tmp_path):
    path, aside = tmp_path / "raw.csv", str(tmp_path / "rejected")
    path.write_text(
        "date,store,item,sales\n2013-01-01,1,2,3\n\n2013-01-02,,2,\nnot a date,1,x,4\n2013-01-03,1,2.5,4\n2013-01-04,1\n"
        "2013-01-05,1,2,3,4\n2013-01-06,1,2,many\n"
    )
    rows = sources.read_raw_sales(spark, str(path), aside)
    assert rows.schema == sources.read_raw_sales(spark, str(path)).schema
    assert sorted(tuples(rows), key=str) == [(day("2013-01-01"), 1, 2, 3), (day("2013-01-02"), None, 2, None)] and rows.count() == 2
    assert sorted(tuples(sources.read_rejected(spark, aside))) == [
        ("date", "not a date,1,x,4"), ("item", "2013-01-03,1,2.5,4"), ("sales", "2013-01-06,1,2,many"),
        ("too few fields", "2013-01-04,1"), ("too many fields", "2013-01-05,1,2,3,4"),
    ]
    path.write_text("date,store,item,sales\n2013-01-01,1,2,3\n")
    assert sources.read_raw_sales(spark, str(path), aside).count() == 1
    assert sources.read_rejected(spark, aside).count() == 0


def test_holiday_csv_keeps_one_row_per_date(spark, tmp_path):
    path = tmp_path / "holidays.csv"
    path.write_bytes(
        b'Date,Holiday,WeekDay,Month,Day,Year\r\n2031-05-02,Lantern Night,Friday,5,2,2031\r\n'
        b'2031-08-11,"Harvest, second day",Monday,8,11,2031\r\n2031-05-02,Spring Fair,Friday,5,2,2031\r\n'
    )
    got = sources.read_holidays(spark, str(path))
    assert sorted(tuples(got)) == [(day("2031-05-02"), 1), (day("2031-08-11"), 1)]


def test_upload_dates_are_day_first_and_sales_optional(spark):
    rows = spark.createDataFrame(
        [("03/04/2017", 1, 1), ("03-04-2017", 1, 1), ("2017-04-03", 1, 1), ("soon", 1, 1)],
        "date string, store int, item int",
    )
    got = sources.daily_upload(rows).collect()
    assert [r.date for r in got] == [day("2017-04-03")] * 3 + [None] and {r.sales for r in got} == {0}
    assert [r.sales for r in sources.daily_upload(rows.withColumn("sales", F.lit(9))).collect()] == [9] * 4


def test_partitioned_layer_round_trip(spark, tmp_path):
    rows = series(spark, range(30)).unionByName(series(spark, range(30), store=2))
    path = str(tmp_path / "layer")
    assert sources.write_by_store(rows, path, sort=("year", *WEEK_KEY)) == 60
    back = sources.read_layer(spark, path, rows.columns)
    assert back.columns == rows.columns
    assert sorted(tuples(back)) == sorted(tuples(rows))
    assert sorted(p.name for p in (tmp_path / "layer").iterdir() if p.is_dir()) == ["store=1", "store=2"]


def test_hot_store_is_split_over_files(spark, tmp_path):
    """A store with nearly all rows does not end up in one task."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        rows = spark.range(0, 400_000, 1, 8).select(
            F.when(F.col("id") % 50 == 0, 2).otherwise(1).alias("store"), F.xxhash64("id").alias("v")
        )
        assert sources.write_by_store(rows, str(tmp_path / "hot")) == 400_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = len(list((tmp_path / "hot" / "store=1").glob("*.parquet")))
    cold = len(list((tmp_path / "hot" / "store=2").glob("*.parquet")))
    assert hot > 4 and cold <= 2


def test_csv_export_is_sorted_over_its_parts(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 4).select((F.col("id") % 7).alias("k"), (-F.col("id")).alias("v"), F.lit(1).alias("x"))
    sources.export_csv(rows.repartition(6), str(tmp_path / "out"), sort=["k"], drop=["x"])
    lines = []
    for part in sorted((tmp_path / "out").glob("part-*.csv")):
        header, *body = part.read_text().split()
        assert header == "k,v"
        lines += [tuple(map(int, line.split(","))) for line in body]
    assert lines == sorted(lines) and len(lines) == 5000


def test_metrics_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("m", 1.5, 1.0, 2.0, 0.5, 10)], "model string, rmse double, mae double, mape double, r2 double, n_rows bigint"
    )
    sources.write_metrics(rows, str(tmp_path / "csv"), str(tmp_path / "lake"))
    assert tuples(sources.read_metrics(spark, str(tmp_path / "csv"))) == tuples(rows)
    assert tuples(spark.read.parquet(str(tmp_path / "lake"))) == tuples(rows)


def test_lake_builds_and_resumes(spark, tmp_path):
    dates = [r.d for r in spark.sql("select explode(sequence(date'2013-01-01', date'2014-06-30')) d").collect()]
    rows = [(str(d), s, 1, n % 9) for s in (1, 2) for n, d in enumerate(dates)]
    root, off = str(tmp_path), holidays(spark, "2013-01-01", "2013-07-04")
    counts = build_lake(spark, root, off, 2013, raw=raw(spark, rows + rows[:5]))
    assert list(counts) == list(LAYERS)
    assert counts["bronze"] == len(rows) + 5 and counts["silver_daily"] == len(rows)
    assert counts["gold"] == counts["silver_weekly"] - 2 * 52
    daily = sources.read_layer(spark, layer_paths(root)["silver_daily"], DAILY_COLUMNS)
    assert daily.where("is_holiday = 1").count() == 4
    assert build_lake(spark, root, off, 2013, start="silver_weekly") == {
        k: counts[k] for k in ("silver_weekly", "gold")
    }


def test_upload_file_with_unreadable_dates(spark, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text("date,store,item\n03/04/2017,1,1\n2017/04/10,1,1\n10-04-2017,1,x\n")
    rows = sources.read_upload(spark, str(path))
    assert sources.rejected_dates(rows).first().asDict() == {"rows": 3, "rejected_rows": 1}
    models = spark.createDataFrame([(1, 1, [5.0], [])], "store int, item int, coefficients array<double>, bends array<double>")
    scored = score_upload(rows, holidays(spark, "2017-01-01"), models)
    assert tuples(scored) == [(1, 1, 2017, 14, 5.0)]


def test_upload_scored_by_a_stored_forest(spark):
    """Weeks with and without stored history, an unknown series, unreadable dates."""
    history = series(spark, [10 * n for n in range(1, 61)], start=(2016, 1))
    nodes = spark.createDataFrame(
        [
            (0, 0, "lag_1_week", None, 300.0, 1, 2, 0.0, 1.0, 1.0, 2.0),
            (0, 1, None, None, None, None, None, 1.0, 1.0, None, 1.0),
            (0, 2, None, None, None, None, None, 2.0, 1.0, None, 1.0),
        ],
        NODE_DDL,
    )
    upload = spark.createDataFrame(
        [("11/01/2016", 1, 1), ("12/01/2016", 1, 1), ("2016-12-12", 1, 1), ("27-02-2017", 1, 1), ("06/03/2017", 1, 1), ("06/03/2017", 9, 9), ("never", 1, 1)],
        "date string, store int, item int",
    )
    got = sorted(tuples(score_by_nodes(upload, holidays(spark, "2016-01-11"), history, nodes, 2013)))
    assert got == [(1, 1, 2016, 2, 1.0), (1, 1, 2016, 50, 2.0), (1, 1, 2017, 9, 2.0), (1, 1, 2017, 10, 2.0), (9, 9, 2017, 10, 2.0)]


def test_filtered_export(spark, tmp_path):
    rows = spark.createDataFrame(
        [(s, 1, 2017, w, 1.5) for s in (1, 2, 3) for w in range(1, 6)],
        "store int, item int, year int, week int, sales_prediction double",
    )
    path = str(tmp_path / "out")
    export_filtered(rows, path, stores=[1, 3], weeks=(2, 3), year=2017, items=[])
    back = spark.read.csv(path, schema=rows.schema, header=True)
    assert sorted((r.store, r.week) for r in back.collect()) == [(1, 2), (1, 3), (3, 2), (3, 3)]


def test_whole_job_checks_and_resumes(spark, tmp_path):
    dates = [r.d for r in spark.sql("select explode(sequence(date'2013-01-01', date'2016-06-30')) d").collect()]
    rows = [(str(d), s, i, (n * i) % 9) for s in (1, 2) for i in (1, 2) for n, d in enumerate(dates)]
    frame, off, root = raw(spark, rows), holidays(spark, "2013-01-01"), str(tmp_path)
    checks = {"expected_rows": len(rows), "stores": (1, 2), "items": (1, 2), "dates": ("2013-01-01", "2016-12-31")}
    with pytest.raises(ValueError):
        run_all(spark, root, off, frame, checks | {"stores": (2, 2)}, 2013, 2015, 2016)
    assert not (tmp_path / "bronze").exists()
    small = {"RandomForest": {"numTrees": 2, "maxDepth": 3}, "GradientBoosting": {"maxIter": 2, "maxDepth": 2}}
    metrics = tuples(run_all(spark, root, off, frame, checks, 2013, 2015, 2016, settings=small))
    assert len(metrics) == 5
    assert tuples(run_all(spark, root, off, base_year=2013, train_until=2015, test_year=2016, start="evaluate")) == metrics
    # A stored regressor brings its encoder: it scores plain features, also of a new store.
    loaded = Regressor.load("LinearRegression", f"{root}/training/models/LinearRegression")
    gold = sources.read_layer(spark, layer_paths(root)["gold"]).drop("store_idx", "item_idx", "store_ohe", "item_ohe")
    new = gold.limit(3).withColumn("store", F.lit(77))
    assert loaded.predict(new).where("prediction is not null").count() == 3


def test_shared_folder_needs_a_setting_on_clusters(spark):
    class Conf:
        def __init__(self, **known):
            self.known = known

        def get(self, key, default=None):
            return self.known.get(key.rsplit(".", 1)[-1], default)

    class Session:
        def __init__(self, **known):
            self.conf = Conf(**known)

    assert shared_folder(Session(dir="hdfs://a/b/", master="yarn"), "x").startswith("hdfs://a/b/x-")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:7077"):
        with pytest.raises(ValueError):
            shared_folder(Session(master=master), "x")
    assert "x-" in shared_folder(Session(master="local[4]"), "x")


def lake_rows(spark, root, layer, columns):
    return sorted(tuples(spark.read.parquet(layer_paths(root)[layer]).select(*columns).selectExpr(*[f"cast({c} as string)" for c in columns])), key=str)


def test_increment_equals_a_rebuild(spark, tmp_path):
    """New days at the end, late days in the middle, a repeated delivery, a new series, and stores left alone."""
    start, off = datetime.date(2013, 1, 1), holidays(spark, "2013-07-04", "2015-07-04")
    days = [(start + datetime.timedelta(days=n), s, i, (n * 7 + 3 * s + i) % 31) for n in range(1100) for s in (1, 2, 3) for i in (1, 2)]
    days += [(datetime.date(2015, 12, 20), 2, 9, 5)]
    frame = lambda rows: raw(spark, [(d.isoformat(), s, i, n) for d, s, i, n in rows])
    late = datetime.date(2015, 10, 6)
    first = [r for r in days if r[0] < datetime.date(2015, 11, 1) and not (r[1] == 1 and r[0] == late)]
    second = [r for r in days if r[0] >= datetime.date(2015, 11, 1) and r[1] != 3] + [r for r in days if r[1] == 1 and r[0] == late]
    third = [r for r in days if r[0] >= datetime.date(2015, 11, 1) and r[1] == 3]
    whole, grown = str(tmp_path / "whole"), str(tmp_path / "grown")
    build_lake(spark, whole, off, 2013, raw=frame(days), train_until=2014)
    build_lake(spark, grown, off, 2013, raw=frame(first), train_until=2014)
    untouched = sorted(p.name for p in (tmp_path / "grown/gold/features/store=3").glob("*.parquet"))
    counts = update_lake(spark, grown, frame(second + second[:9]), off, 2013, 2014)
    assert sorted(p.name for p in (tmp_path / "grown/gold/features/store=3").glob("*.parquet")) == untouched
    assert set(counts) == {"silver_weekly", "gold"}
    update_lake(spark, grown, frame(third), off, 2013, 2014)
    update_lake(spark, grown, frame(third), off, 2013, 2014)  # a run that is repeated adds nothing
    assert update_lake(spark, grown, frame([]), off, 2013, 2014) == {}
    for layer, columns in (("silver_daily", DAILY_COLUMNS), ("silver_weekly", WEEKLY_COLUMNS), ("gold", GOLD_COLUMNS)):
        assert lake_rows(spark, grown, layer, columns) == lake_rows(spark, whole, layer, columns)


def test_increment_in_the_encoders_years_builds_gold_anew(spark, tmp_path):
    start, off = datetime.date(2013, 1, 1), holidays(spark, "2013-07-04")
    days = [((start + datetime.timedelta(days=n)).isoformat(), s, 1, (n * 7) % 31) for n in range(800) for s in (1, 2)]
    whole, grown = str(tmp_path / "whole"), str(tmp_path / "grown")
    build_lake(spark, whole, off, 2013, raw=raw(spark, days))
    build_lake(spark, grown, off, 2013, raw=raw(spark, [d for d in days if d[1] == 1]))
    update_lake(spark, grown, raw(spark, [d for d in days if d[1] == 2]), off, 2013)
    assert lake_rows(spark, grown, "gold", GOLD_COLUMNS) == lake_rows(spark, whole, "gold", GOLD_COLUMNS)


def test_training_goes_on_with_the_model_that_failed(spark, tmp_path, monkeypatch):
    start, off = datetime.date(2013, 1, 1), holidays(spark, "2013-07-04")
    days = [((start + datetime.timedelta(days=n)).isoformat(), s, 1, (n * 7 + s) % 31) for n in range(1200) for s in (1, 2)]
    small = {"RandomForest": {"numTrees": 2, "maxDepth": 2}, "GradientBoosting": {"maxIter": 2, "maxDepth": 2}}
    root, fitted, fit = str(tmp_path / "job"), [], Regressor.fit

    def failing(self, train):
        fitted.append(self.name)
        if self.name == "GradientBoosting" and fitted.count(self.name) == 1:
            raise RuntimeError("lost")
        return fit(self, train)

    monkeypatch.setattr(Regressor, "fit", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run_all(spark, root, off, raw(spark, days), None, 2013, 2014, 2015, settings=small)
    assert first_open_stage(spark, root) == "train"
    run_all(spark, root, off, None, None, 2013, 2014, 2015, start=None, settings=small)
    assert fitted == ["LinearRegression", "RandomForest", "GradientBoosting", "GradientBoosting"]
    assert first_open_stage(spark, root) == "evaluate"
    # Other settings, or layers built anew, leave no model complete.
    gold = spark.read.parquet(layer_paths(root)["gold"])
    train_and_compare(gold, f"{root}/training", 2014, 2015, small | {"RandomForest": {"numTrees": 3, "maxDepth": 2}}, resume=True)
    assert fitted[4:] == ["RandomForest"]


def test_a_layer_that_failed_is_written_again(spark, tmp_path, monkeypatch):
    start, off = datetime.date(2013, 1, 1), holidays(spark, "2013-07-04")
    days = raw(spark, [((start + datetime.timedelta(days=n)).isoformat(), s, 1, (n * 7 + s) % 31) for n in range(1200) for s in (1, 2)])
    small = {"RandomForest": {"numTrees": 2, "maxDepth": 2}, "GradientBoosting": {"maxIter": 2, "maxDepth": 2}}
    root, write = str(tmp_path / "job"), lake.write_by_store

    def lost(df, path, sort=()):
        if "weekly" in path:
            raise RuntimeError("half written")
        return write(df, path, sort)

    monkeypatch.setattr(lake, "write_by_store", lost)
    with pytest.raises(RuntimeError, match="half written"):
        run_all(spark, root, off, days, None, 2013, 2014, 2015, settings=small)
    assert first_open_stage(spark, root) == "silver_weekly"
    monkeypatch.setattr(lake, "write_by_store", write)
    assert run_all(spark, root, off, None, None, 2013, 2014, 2015, start=None, settings=small).count() == 5
