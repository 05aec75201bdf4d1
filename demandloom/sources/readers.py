"""Typed scans of raw files, dimension files and lake layers."""

from pyspark.sql import functions as F

from ..columns import RAW_SCHEMA

# Accepted spellings of an uploaded date, day first.
UPLOAD_DATE_FORMATS = ("dd/MM/yyyy", "dd-MM-yyyy", "yyyy-MM-dd")


REJECTED = "rejected_line"


def parsed_sales(spark, path):
    """Daily sales CSV with the text of every line that does not parse in ``rejected_line``.

    An empty field is a null, not a fault; a field of another type, or a line with too few or
    too many fields, is one. Header lines, of any file, and blank lines are no rows.
    """
    header = ",".join(f.name for f in RAW_SCHEMA)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMA) + f", {REJECTED} string"
    options = {"mode": "PERMISSIVE", "dateFormat": "yyyy-MM-dd", "columnNameOfCorruptRecord": REJECTED}
    lines = spark.read.text(path).where((F.trim("value") != "") & (F.lower(F.translate("value", '" ', "")) != header))
    return lines.select(F.from_csv("value", schema, options).alias("row")).select("row.*")


def accepted_sales(parsed):
    return parsed.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_sales(parsed):
    """Reason and text of every rejected line; the first fault from the left is the reason."""
    fields = F.split(REJECTED, ",", -1)
    count = F.when(F.size(fields) < len(RAW_SCHEMA), "too few fields").when(F.size(fields) > len(RAW_SCHEMA), "too many fields")
    # A value of another type: text that is there, and no value.
    types = [
        F.when((F.trim(F.get(fields, F.lit(k))) != "") & F.col(f.name).isNull(), f.name) for k, f in enumerate(RAW_SCHEMA)
    ]
    return parsed.where(F.col(REJECTED).isNotNull()).select(
        F.coalesce(count, *types, F.lit("unreadable")).alias("reason"), F.col(REJECTED).alias("line")
    )


def read_raw_sales(spark, path, rejected=None):
    """Daily sales CSV.

    Without ``rejected``, a field that does not parse becomes null. With it, lines that do not
    parse are left out and written below that path, one folder per reason, before the rows
    are returned.
    """
    if rejected is None:
        return spark.read.csv(path, schema=RAW_SCHEMA, header=True, dateFormat="yyyy-MM-dd", mode="PERMISSIVE")
    parsed = parsed_sales(spark, path)
    rejected_sales(parsed).write.mode("overwrite").partitionBy("reason").parquet(rejected)
    return accepted_sales(parsed)


def read_rejected(spark, path):
    """Lines that ``read_raw_sales`` wrote aside, with their reason; none if it found none."""
    return spark.read.schema("line string, reason string").parquet(path).select("reason", "line")


def holiday_dates(rows, column="Date", fmt="yyyy-MM-dd"):
    """One row per holiday date, however many names a date is listed under."""
    return (
        rows.select(F.try_to_date(F.col(column), fmt).alias("holiday_date"))
        .where(F.col("holiday_date").isNotNull())
        .dropDuplicates()
        .withColumn("is_holiday", F.lit(1))
    )


def read_holidays(spark, path, column="Date", fmt="yyyy-MM-dd"):
    return holiday_dates(spark.read.csv(path, header=True), column, fmt)


def read_layer(spark, path, columns=None):
    """A parquet layer. Naming columns also restores their order, which a
    partitioned layout changes."""
    layer = spark.read.parquet(path)
    return layer.select(*columns) if columns else layer


def read_metrics(spark, path):
    """Stored metric rows, as ``write_metrics`` leaves them in CSV."""
    schema = "model string, rmse double, mae double, mape double, r2 double, n_rows bigint"
    return spark.read.csv(path, schema=schema, header=True)


def read_upload(spark, path):
    """An uploaded CSV with a header: date as text, store, item, and sales if it has them."""
    rows = spark.read.csv(path, header=True)
    whole = [c for c in ("store", "item", "sales") if c in rows.columns]
    return rows.select("date", *[F.col(c).try_cast("int").alias(c) for c in whole])


def rejected_dates(rows):
    """How many uploaded rows have no date that can be read."""
    return daily_upload(rows).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("date").isNull()).alias("rejected_rows")
    )


def daily_upload(rows):
    """Rows uploaded for scoring: day-first text dates, sales optional. A date that
    cannot be read is null; ``rejected_dates`` counts those."""
    if dict(rows.dtypes)["date"] == "string":
        parsed = [F.try_to_date(F.col("date"), fmt) for fmt in UPLOAD_DATE_FORMATS]
        rows = rows.withColumn("date", F.coalesce(*parsed))
    if "sales" not in rows.columns:
        rows = rows.withColumn("sales", F.lit(0))
    return rows.select("date", "store", "item", "sales")
