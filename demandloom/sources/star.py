"""Daily sales, holidays and dirty input derived from the star-schema tables.

``store`` is the supplier's region, ``item`` the number in the part's brand. No join
is hinted and each dimension joins the lines directly, so Spark measures it on its own:
below the broadcast threshold it is broadcast, above it is sort-merge joined with
adaptive skew splitting. The sum combines on the map side, so a hot product costs no
more than any other.
"""

from pyspark.sql import functions as F

BASE_YEAR = 1995
TRAIN_UNTIL = 1999
TEST_YEAR = 2000
DATE_RANGE = ("1995-01-01", "2001-12-31")
STORE_RANGE = (0, 4)
ITEM_RANGE = (1, 25)

# The columns used of each table. Stating them spares every scan the
# job that would infer them.
TABLES = {
    "lineitem": "l_shipdate timestamp_ntz, l_partkey bigint, l_suppkey bigint, l_quantity double",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "part": "p_partkey bigint, p_brand string",
    "orders": "o_orderdate timestamp_ntz",
}

# Holidays on a set day, as (month, day).
FIXED_HOLIDAYS = ((1, 1), (2, 14), (6, 19), (7, 4), (11, 11), (12, 24), (12, 25), (12, 31))
# Holidays on a weekday, as (month, first day, last day, weekday with
# Monday = 0). A rule that stands twice lists its dates under two names.
WEEKDAY_HOLIDAYS = (
    (1, 15, 21, 0),
    (2, 15, 21, 0),
    (5, 25, 31, 0),
    (9, 1, 7, 0),
    (9, 1, 7, 0),
    (10, 8, 14, 0),
    (11, 22, 28, 3),
)


def table(spark, sf_dir, name):
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def sales_daily(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), "l_partkey", "l_suppkey", "l_quantity"
    )
    regions = table(spark, sf_dir, "nation").select(
        "n_nationkey", F.col("n_regionkey").cast("int").alias("store")
    )
    items = table(spark, sf_dir, "part").select(
        "p_partkey", F.regexp_extract("p_brand", "[0-9]+", 0).try_cast("int").alias("item")
    )
    return (
        lines.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(regions, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(items, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("date", "store", "item")
        .agg(F.sum("l_quantity").cast("bigint").alias("sales"))
    )


def dirty_sales(spark, sf_dir):
    """Daily sales with repeated rows, negative and missing sales and unknown stores."""
    k = F.date_diff("date", F.lit("1995-01-01").cast("date")) * 300 + F.col("store") * 60 + F.col("item")
    return (
        sales_daily(spark, sf_dir)
        .withColumn("k", k)
        .select(
            "date",
            F.when(F.col("k") % 107 == 0, F.lit(99)).otherwise(F.col("store")).alias("store"),
            "item",
            F.when(F.col("k") % 103 == 0, F.lit(None))
            .when(F.col("k") % 101 == 0, -F.col("sales"))
            .otherwise(F.col("sales"))
            .alias("sales"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("k") % 97 == 0, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def holiday_rows(spark, sf_dir):
    """(Date, Holiday) text rows, one per date with an order and holiday rule it meets.

    Orders collapse to their dates before any rule is tried.
    """
    fixed = [f"if(month(d) = {m} and day(d) = {n}, 'day-{m}-{n}', null)" for m, n in FIXED_HOLIDAYS]
    moving = [
        f"if(month(d) = {m} and day(d) between {first} and {last} and weekday(d) = {wd}, 'week-rule-{k}', null)"
        for k, (m, first, last, wd) in enumerate(WEEKDAY_HOLIDAYS)
    ]
    names = f"array_compact(array({', '.join(fixed + moving)}))"
    dates = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return dates.select(
        F.date_format("d", "yyyy-MM-dd").alias("Date"), F.explode(F.expr(names)).alias("Holiday")
    )
