"""Bronze, silver and gold layers as parquet."""

from pyspark.ml import PipelineModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..columns import BASE_YEAR, DAILY_COLUMNS, GOLD_SCALARS, LAGS, SERIES, WEEK_KEY, WEEKLY_COLUMNS
from ..operators.cleaning import clean_daily
from ..operators.features import calendar_features, drop_warmup, encode, feature_rows, fit_encoder, history_features
from ..operators.validation import require_valid, validation_report
from ..operators.weekly import to_weekly
from ..session import shared_folder
from ..sources.readers import read_layer
from ..sources.writers import add_by_store, replace_stores, write_by_store, write_plain

LAYERS = ("bronze", "silver_daily", "silver_weekly", "gold")


def layer_paths(root):
    return {
        "bronze": f"{root}/bronze/raw_sales",
        "silver_daily": f"{root}/silver/daily_sales",
        "silver_weekly": f"{root}/silver/weekly_sales",
        "gold": f"{root}/gold/features",
        "encoder": f"{root}/gold/encoder",
    }


def gold_and_encoder(weekly, base_year=BASE_YEAR, train_until=None):
    """Gold features and their encoder, which learns the categories of the years up to
    ``train_until`` only, or of all years without it."""
    features = feature_rows(weekly, base_year)
    encoder = fit_encoder(features if train_until is None else features.where(F.col("year") <= train_until))
    return encode(features, encoder), encoder


def build_gold(weekly, base_year=BASE_YEAR, train_until=None):
    return gold_and_encoder(weekly, base_year, train_until)[0]


def build_lake(
    spark, root, holidays, base_year=BASE_YEAR, raw=None, start="bronze", checks=None, train_until=None, stop="gold"
):
    """Build the layers from ``start`` to ``stop``, each from the layer stored before it.

    Returns the row count read back from every layer built. ``raw`` is needed only
    when bronze is built. With ``checks``, the arguments of ``validation_report``, raw
    rows that fail raise before anything is written. The encoder is stored beside gold.
    """
    paths = layer_paths(root)
    todo = LAYERS[LAYERS.index(start) : LAYERS.index(stop) + 1]
    counts = {}
    if "bronze" in todo:
        if checks is not None:
            require_valid(validation_report(raw, **checks))
        counts["bronze"] = write_plain(raw, paths["bronze"])
    if "silver_daily" in todo:
        daily = clean_daily(read_layer(spark, paths["bronze"]), holidays)
        counts["silver_daily"] = write_by_store(daily, paths["silver_daily"], sort=("date", "item"))
    if "silver_weekly" in todo:
        weekly = to_weekly(read_layer(spark, paths["silver_daily"], DAILY_COLUMNS))
        counts["silver_weekly"] = write_by_store(weekly, paths["silver_weekly"], sort=("year", *WEEK_KEY))
    if "gold" in todo:
        stored = read_layer(spark, paths["silver_weekly"], WEEKLY_COLUMNS)
        gold, encoder = gold_and_encoder(stored, base_year, train_until)
        encoder.write().overwrite().save(paths["encoder"])
        counts["gold"] = write_by_store(gold, paths["gold"], sort=("year", *WEEK_KEY))
    return counts


def _stored(spark, frame, name):
    path = shared_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def update_lake(spark, root, raw, holidays, base_year=BASE_YEAR, train_until=None, checks=None):
    """Bring new raw rows into a lake that ``build_lake`` made; equal to building it anew.

    Daily rows are added; they are compared with stored rows of the same stores and dates
    only. Weeks that hold a new day are summed again, and features from the first such week of
    a store on, from it and as many rows of history as the longest lag. Partitions of stores
    without new rows are not touched, and those of others are replaced whole, from a staged
    copy. A run that failed can be repeated with the same rows. If new rows are of the years that
    the encoder learned, gold is built anew, as every store's slots may move.

    Returns the rows per layer in the stores touched, or an empty dict without a valid new row.
    """
    paths = layer_paths(root)
    if checks is not None:
        require_valid(validation_report(raw, **checks))
    raw = _stored(spark, raw, "new-raw")
    new = _stored(spark, clean_daily(raw, holidays), "new-days")
    days = new.agg(F.min("date").alias("first"), F.max("date").alias("last"), F.min(F.year("date")).alias("year")).first()
    raw.write.mode("append").parquet(paths["bronze"])
    if days["first"] is None:
        return {}
    stores = _stored(spark, new.select("store").distinct(), "new-stores")

    def of_stores(layer, columns):
        """A layer's rows in the touched stores; the join prunes the other partitions."""
        return read_layer(spark, paths[layer], columns).join(stores, "store", "left_semi")

    same_days = of_stores("silver_daily", DAILY_COLUMNS).where(F.col("date").between(days["first"], days["last"]))
    known = F.struct(*DAILY_COLUMNS)
    fresh = new.join(same_days.select(known.alias("_known")), F.struct(*DAILY_COLUMNS).eqNullSafe(F.col("_known")), "left_anti")
    add_by_store(_stored(spark, fresh, "fresh-days"), paths["silver_daily"], sort=("date", "item"))

    # A week is named by calendar year and ISO week, so its days may lie at both ends of a year.
    weeks = _stored(
        spark, new.select("store", F.year("date").alias("year"), F.weekofyear("date").alias("week_of_year")).distinct(), "new-weeks"
    )
    years = F.col("date").between(F.make_date(F.lit(days["first"].year), F.lit(1), F.lit(1)), F.make_date(F.lit(days["last"].year), F.lit(12), F.lit(31)))
    open_days = of_stores("silver_daily", DAILY_COLUMNS).where(years).join(
        weeks.withColumnsRenamed({"store": "_s", "year": "_y", "week_of_year": "_w"}),
        (F.col("store") == F.col("_s")) & (F.year("date") == F.col("_y")) & (F.weekofyear("date") == F.col("_w")),
        "left_semi",
    )
    summed = _stored(spark, to_weekly(open_days), "new-sums")
    kept = of_stores("silver_weekly", WEEKLY_COLUMNS).join(weeks, ["store", "year", "week_of_year"], "left_anti").select(*WEEKLY_COLUMNS)
    weekly = _stored(spark, kept.unionByName(summed), "new-weekly")
    counts = {"silver_weekly": replace_stores(weekly, paths["silver_weekly"], sort=("year", *WEEK_KEY))}

    if train_until is None or days["year"] <= train_until:
        counts["gold"] = build_lake(spark, root, holidays, base_year, start="gold", train_until=train_until)["gold"]
        return counts
    # Features of a series from the first week that changed in its store.
    placed = calendar_features(weekly, base_year)
    first = calendar_features(summed, base_year).groupBy("store").agg(F.min("abs_week").alias("_first"))
    back = F.row_number().over(Window.partitionBy(*SERIES, "_late").orderBy(F.desc("abs_week")))
    needed = (
        placed.join(first, "store")
        .withColumn("_late", F.col("abs_week") >= F.col("_first"))
        .withColumn("_back", back)
        .where(F.col("_late") | (F.col("_back") <= max(LAGS)))
    )
    late = drop_warmup(history_features(needed)).where("_late").select(*GOLD_SCALARS)
    encoder = PipelineModel.load(paths["encoder"])
    old = read_layer(spark, paths["gold"]).join(first, "store").where(F.col("abs_week") < F.col("_first")).drop("_first")
    gold = _stored(spark, old.unionByName(encode(late, encoder)), "new-gold")
    counts["gold"] = replace_stores(gold, paths["gold"], sort=("year", *WEEK_KEY))
    return counts
