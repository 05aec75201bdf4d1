"""Order statistics of a column that never sort it in one task.

Equal values are counted first, which collapses any hot value on the map side. The
counted rows are range-partitioned and stored with the number of their partition; the
bounds of the ranges are sampled, so they are never worked out twice. What stands before
a row is then the sum over earlier partitions, one row each, plus a running sum inside
its own partition. Any type with an order will do: whole numbers, doubles, text, dates.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import shared_folder


def stored_in_order(df, *order):
    """``df`` as a shared table of ranges in ``order``, with their number as ``_part``."""
    spark = df.sparkSession
    path = shared_folder(spark, "ordered")
    placed = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def _before(count, window):
    return F.coalesce(F.sum(count).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def range_starts(stored, weights, by=()):
    """Per group and range: ``_start_<w>`` before the range and ``_total_<w>`` of the group.

    The windows see one row per range, however many rows the ranges hold.
    """
    group = Window.partitionBy(*by)
    sums = stored.groupBy(*by, "_part").agg(*[F.sum(w).alias(f"_size_{w}") for w in weights])
    return sums.withColumns(
        {f"_start_{w}": _before(f"_size_{w}", group.orderBy("_part")) for w in weights}
        | {f"_total_{w}": F.sum(f"_size_{w}").over(group) for w in weights}
    )


def with_running(stored, order, weights, by=()):
    """Add ``_before_<w>``, the sum of ``w`` over earlier rows of the group, and ``_total_<w>``."""
    by = list(by)
    inside = Window.partitionBy(*by, "_part").orderBy(*order)
    rows = stored.withColumns({f"_inside_{w}": _before(w, inside) for w in weights})
    joined = rows.join(range_starts(stored, weights, by), [*by, "_part"])
    return joined.withColumns({f"_before_{w}": F.col(f"_start_{w}") + F.col(f"_inside_{w}") for w in weights})


def _counted(df, value, by, counts):
    known = F.col(value).isNotNull()
    if dict(df.dtypes)[value] in ("double", "float"):
        known = known & ~F.isnan(value)
    return df.where(known).groupBy(*by, F.col(value).alias("_v")).agg(*counts)


def stored_counts(df, value, by=(), **extra):
    """How often each value stands in each group, stored in order: group, ``_v``, ``n``.

    Null and NaN are values here. ``extra`` adds named aggregates of the same rows. The
    one pass over ``df`` runs now; whatever is asked of the counts later reads only them.
    """
    counted = df.groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in extra.items()])
    return stored_in_order(counted, *by, "_v")


def known_values(stored):
    """Stored counts without null and NaN."""
    known = F.col("_v").isNotNull()
    if dict(stored.dtypes)["_v"] in ("double", "float"):
        known = known & ~F.isnan("_v")
    return stored.where(known)


def exact_percentiles(df, value, percentiles, by=()):
    """Linearly interpolated percentiles of a numeric column; null and NaN are left out.

    ``percentiles`` maps output names to probabilities. One row per group in ``by``.
    """
    return percentiles_of(stored_counts(df, value, by), percentiles, by)


def percentiles_of(stored, percentiles, by=()):
    """``exact_percentiles`` of rows that ``stored_counts`` has counted."""
    by, stored = list(by), known_values(stored)
    ranges = range_starts(stored, ["n"], by)

    def wanted(name, probability):
        position = F.lit(float(probability)) * (F.col("_total_n") - 1)
        low = F.floor(position)
        weight = position - low
        return [
            F.struct(F.lit(name).alias("name"), low.alias("rank"), (1 - weight).alias("weight")),
            F.struct(F.lit(name).alias("name"), (low + 1).alias("rank"), weight.alias("weight")),
        ]

    targets = [t for name, p in percentiles.items() for t in wanted(name, p)]
    # The ranges that hold a wanted rank: at most two per group and percentile.
    ranks = (
        ranges.withColumn("_t", F.explode(F.array(*targets)))
        .where((F.col("_t.rank") >= F.col("_start_n")) & (F.col("_t.rank") < F.col("_start_n") + F.col("_size_n")))
        .select(
            *by,
            "_part",
            F.col("_t.name").alias("_name"),
            F.col("_t.weight").alias("_weight"),
            (F.col("_t.rank") - F.col("_start_n")).alias("_offset"),
        )
    )
    inside = Window.partitionBy(*by, "_part").orderBy("_v")
    located = (
        stored.withColumn("_below", _before("n", inside))
        .join(ranks, on=[*by, "_part"])
        .where((F.col("_offset") >= F.col("_below")) & (F.col("_offset") < F.col("_below") + F.col("n")))
    )
    return located.groupBy(*by).agg(
        *[
            F.sum(F.when(F.col("_name") == name, F.col("_v") * F.col("_weight"))).alias(name)
            for name in percentiles
        ]
    )


def running_shares(df, value, flags):
    """Empirical distribution functions of several row subsets at every value.

    ``flags`` maps output names to boolean conditions. Returns one row per distinct
    value with the share of each subset at or below it, and each subset's size as
    ``<name>_rows``. Null and NaN are left out.
    """
    stored = stored_in_order(
        _counted(df, value, [], [F.count_if(cond).alias(name) for name, cond in flags.items()]), "_v"
    )
    running = with_running(stored, ["_v"], list(flags))
    return running.select(
        F.col("_v").alias(value),
        *[F.col(f"_total_{name}").alias(f"{name}_rows") for name in flags],
        *[
            ((F.col(f"_before_{name}") + F.col(name)) / F.nullif(F.col(f"_total_{name}"), F.lit(0))).alias(name)
            for name in flags
        ],
    )


def places(df, *order):
    """``df`` with ``place``, its row's place from 0 in a total ``order``."""
    stored = stored_in_order(df.withColumn("_one", F.lit(1).cast("bigint")), *order)
    return with_running(stored, order, ["_one"]).select(*df.columns, F.col("_before__one").alias("place"))
