import pytest
from pyspark.sql import functions as F

from demandloom.columns import GOLD_COLUMNS, HISTORY_COLUMNS
from demandloom.operators import features
from demandloom.operators.regression import assembler
from demandloom.plans.lake import build_gold
from helpers import raw, series, tuples, weekly


def history(spark, values, **kw):
    rows = features.calendar_features(series(spark, values, **kw), 2013)
    return features.history_features(rows).orderBy("abs_week")


def test_lags_go_by_row_over_a_missing_week(spark):
    rows = history(spark, list(range(60)), skip=(9,)).collect()
    assert rows[9].weekly_sales == 10 and rows[9].lag_1_week == 8
    assert rows[-1].weekly_sales == 59 and rows[-1].lag_52_week == 6


def test_trailing_averages_leave_the_current_row_out(spark):
    rows = history(spark, [10, 20, 30, 40, 1000]).collect()
    assert [r.rolling_4_week_avg for r in rows] == [None, 10.0, 15.0, 20.0, 25.0]
    assert rows[-1].rolling_12_week_avg == 25.0


def test_changing_the_last_week_changes_no_earlier_row(spark):
    a = history(spark, list(range(60))).collect()
    b = history(spark, list(range(59)) + [9999]).collect()
    assert a[:-1] == b[:-1]
    assert [a[-1][c] for c in HISTORY_COLUMNS] == [b[-1][c] for c in HISTORY_COLUMNS]


@pytest.mark.parametrize("length, left", [(52, 0), (53, 1), (54, 2)])
def test_warmup_takes_52_rows_of_a_series(spark, length, left):
    rows = history(spark, list(range(length)))
    assert features.drop_warmup(rows).count() == left
    assert tuple(features.warmup_report(rows).first()) == (length, left, length - left)


def test_category_index_orders_by_frequency_then_text(spark):
    rows = spark.createDataFrame([(i,) for i in (1, 2, 10, 10, 7, 7, 3)], "item int")
    got = features.category_index(rows, "item").orderBy("index")
    assert [(r.category, r["index"]) for r in got.collect()] == [
        ("10", 0.0), ("7", 1.0), ("1", 2.0), ("2", 3.0), ("3", 4.0)
    ]


def test_category_index_with_one_shared_frequency(spark):
    items = spark.range(3000).select(F.col("id").cast("int").alias("item"))
    got = {r.category: r["index"] for r in features.category_index(items, "item").collect()}
    assert got == {c: float(i) for i, c in enumerate(sorted(map(str, range(3000))))}


def many_series(spark, stores=10, items=50):
    weeks = spark.range(54).select((F.col("id") % 52 + 1).cast("int").alias("week_of_year"), (2013 + F.floor(F.col("id") / 52)).cast("int").alias("year"))
    keys = spark.range(stores * items).select(
        (F.col("id") / items + 1).cast("int").alias("store"), (F.col("id") % items + 1).cast("int").alias("item")
    )
    return keys.join(weeks).select(
        "store", "item", "year", "week_of_year", (F.col("store") * 10 + F.col("item") + F.col("week_of_year")).cast("bigint").alias("weekly_sales"), F.lit(0).alias("week_has_holiday"),
    )


def test_gold_columns_and_vector_sizes(spark):
    gold = build_gold(many_series(spark), 2013)
    assert tuple(gold.columns) == GOLD_COLUMNS
    types = dict(gold.dtypes)
    assert types["lag_1_week"] == "bigint" and types["rolling_4_week_avg"] == "double"
    row = assembler().transform(gold).first()
    assert (row.store_ohe.size, row.item_ohe.size, row.features.size) == (10, 50, 70)


def test_index_agrees_with_the_encoder(spark):
    rows = many_series(spark, stores=3, items=12).where("store <> 2 or item <> 5")
    encoded = features.fit_encoder(rows).transform(rows)
    assert "store_idx" in encoded.columns
    by_model = {str(r.item): r.item_idx for r in encoded.select("item", "item_idx").distinct().collect()}
    by_rank = {r.category: r["index"] for r in features.category_index(rows, "item").collect()}
    assert by_model == by_rank


def test_unseen_category_gets_an_empty_vector(spark):
    encoder = features.fit_encoder(weekly(spark, [(1, 1, 2013, 1, 5), (2, 1, 2013, 1, 5)]))
    row = encoder.transform(weekly(spark, [(9, 1, 2013, 1, 5)])).first()
    assert row.store_idx == 2.0 and row.store_ohe.numNonzeros() == 0
