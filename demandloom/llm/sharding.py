"""Shards of nearly equal bytes by sampled splitters.

Each record has a place on a line of 64-bit keys: the hash of its text, then a few bits
of a hash of its id and row number, so equal texts are neighbours. The row number is stored
with the record; it alone tells repeated rows, or rows without an id, apart. A size-weighted sample of keys gives
quantile boundaries of many small ranges. A group of equal texts stays whole unless the
sample shows it to hold more than a set share of a shard; only then do boundaries cut it.
The ranges are measured over all records, overfull ones are subdivided, and the pieces
are laid into shards, the largest first, always into the emptiest shard.

Only the sample, the boundaries and one count per piece reach the driver. Their number
is set by parameters, not by the documents. Slots are numbered in parts of bounded rows,
whose starts are running sums inside Spark. Text is read once; everything later works on a stored table of ids and sizes.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .rows import map_slices

SHARDS = 40
RANGES_PER_SHARD = 32
#: Rows whose slots are numbered in one task.
ROWS_PER_PART = 200_000
SAMPLES_PER_RANGE = 16
#: A range is overfull when it holds more than this share of an even range.
OVERFULL = 1.5
#: A group of equal texts is cut when it holds more than this share of a shard.
GROUP_SHARE = 1 / 8
RECORD_BYTES = 16
#: Low bits of a key that tell records with one text apart.
ID_BITS = 20


def keyed_records(docs, id_col="doc_id", text_col="text"):
    """doc_id, size, text_crc32, a row number and the place on the key line, as narrow rows.

    The number hangs on the task that reads a row, so it must be stored before it is used twice.
    """
    numbered = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row")
    )
    group = F.xxhash64("text").bitwiseAND(F.lit(-(1 << ID_BITS)))
    own = F.xxhash64(F.col("doc_id").cast("string"), "_row", F.lit("id")).bitwiseAND(F.lit((1 << ID_BITS) - 1))
    return numbered.select(
        "doc_id",
        (F.octet_length("text") + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        "_row",
        group.bitwiseOR(own).alias("_key"),
    )


def sampled_boundaries(records, total, n_ranges, group_bytes, per_range=SAMPLES_PER_RANGE):
    """Range boundaries at quantiles of a sample in which bytes, not rows, are equally likely,
    and the groups of equal texts that hold more than ``group_bytes`` of it.

    The draw depends on the stored record alone, so a task that runs again draws the same, and
    every row, repeated or not, is drawn for itself. About ``n_ranges * per_range`` keys come to the driver. A boundary inside any other group is
    moved to the group's start.
    """
    wanted = n_ranges * per_range
    draw = F.pmod(F.xxhash64("_row", F.lit("draw")), F.lit(1 << 30)) / (1 << 30)
    sample = records.where(draw * F.lit(float(total)) < F.col("size") * F.lit(float(wanted))).select("_key", "size")
    rows = sample.toArrow()
    if not rows.num_rows:
        return np.zeros(0, dtype=np.int64), []
    keys, sizes = rows["_key"].to_numpy(), rows["size"].to_numpy().astype(float)
    order = np.argsort(keys, kind="stable")
    # A record larger than one sampling step is drawn for sure and stands for all its bytes.
    keys, weights = keys[order], np.maximum(sizes[order], total / wanted)
    passed = np.cumsum(weights)
    cuts = keys[np.searchsorted(passed, passed[-1] * np.arange(1, n_ranges) / n_ranges)]
    groups, place = np.unique(keys >> ID_BITS, return_inverse=True)
    large = groups[np.bincount(place, weights) > group_bytes]
    own = cuts >> ID_BITS
    return np.unique(np.where(np.isin(own, large), cuts, own << ID_BITS)), large.tolist()


def _ranged(records, boundaries):
    kind = records.schema["doc_id"].dataType.simpleString()

    def work(slices):
        for b in slices:
            keys = b.column("_key").to_numpy(zero_copy_only=False)
            yield {
                **{c: b.column(c) for c in b.schema.names},
                "_range": pa.array(np.searchsorted(boundaries, keys, side="right").astype(np.int32)),
            }

    return map_slices(records, work, f"doc_id {kind}, size long, text_crc32 long, _row long, _key long, _range int")


def place_by_bytes(docs, n_shards=SHARDS, id_col="doc_id", text_col="text", ranges_per_shard=RANGES_PER_SHARD):
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row of ``docs``.

    A null text counts as empty, a null id is an id like others, repeated rows are placed
    each for itself and get slots of their own, an empty table gives no rows, and other
    columns are not read. The law is ``bytes``, so grown_shard is null. It holds to a few
    parts in a hundred for any rows smaller than that, repeated ones too.
    """
    spark = docs.sparkSession
    path = shared_folder(spark, "sharding")
    keyed_records(docs, id_col, text_col).write.parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records")
    total = records.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    n_ranges = n_shards * ranges_per_shard
    group_bytes = GROUP_SHARE * total / n_shards
    boundaries, large = sampled_boundaries(records, max(total, 1), n_ranges, group_bytes)
    _ranged(records, boundaries).write.parquet(f"{path}/ranged")
    ranged = spark.read.parquet(f"{path}/ranged")

    # Overfull ranges go into as many pieces as they hold even ranges, whole groups together
    # but for the large ones. Both tables are bounded: a range has one row, and at most
    # n_shards / GROUP_SHARE groups are large.
    measured = ranged.groupBy("_range").agg(F.sum("size").alias("bytes")).toArrow()
    even = max(total / n_ranges, 1)
    cuts = [
        (r, int(np.ceil(b / even)))
        for r, b in zip(measured["_range"].to_pylist(), measured["bytes"].to_pylist())
        if b > OVERFULL * even
    ]
    cut = F.broadcast(spark.createDataFrame(cuts, "_range int, _pieces int"))
    known = F.broadcast(spark.createDataFrame([(g, True) for g in large], "_group long, _large boolean"))
    group = F.shiftright("_key", ID_BITS)
    unit = F.when(F.col("_large"), F.xxhash64("_row", F.lit("piece"))).otherwise(F.xxhash64("_group"))
    pieced = (
        ranged.withColumn("_group", group)
        .join(cut, "_range", "left")
        .join(known, "_group", "left")
        .withColumn("_piece", F.coalesce(F.pmod(unit, F.col("_pieces")), F.lit(0)).cast("int"))
        .select("doc_id", "size", "text_crc32", "_row", "_key", "_range", "_piece")
    )

    held = pieced.groupBy("_range", "_piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).toArrow()
    pieces = sorted(zip(*(held[c].to_pylist() for c in ("bytes", "rows", "_range", "_piece"))), key=lambda p: (-p[0], p[2:]))
    shards, placed = [(0, s) for s in range(n_shards)], []
    for size, count, r, p in pieces:
        filled, shard = heapq.heappop(shards)
        placed.append((r, p, shard, -(-count // ROWS_PER_PART)))
        heapq.heappush(shards, (filled + size, shard))
    # At most 2.5 pieces per range: a bounded table again.
    where = F.broadcast(spark.createDataFrame(placed, "_range int, _piece int, shard int, _parts int"))
    part = F.pmod(F.xxhash64("_row", F.lit("part")), F.col("_parts")).cast("int")
    spots = ["shard", "_range", "_piece", "_part"]
    parted = pieced.join(where, ["_range", "_piece"]).withColumn("_part", part)
    earlier = Window.partitionBy("shard").orderBy("_range", "_piece", "_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per ROWS_PER_PART documents: summed in Spark, and joined as their size allows.
    starts = parted.groupBy(*spots).count().select(*spots, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*spots).orderBy("_key", "_row")
    return parted.join(starts, spots).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_start") + F.row_number().over(inside) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs, placed, path, id_col="doc_id", files_per_shard=8):
    """Write ``docs`` below ``path``, one folder per shard, in slot order inside each file.

    ``doc_id`` must be unique in ``docs``. A shard is spread over several tasks by slot.
    """
    spots = placed.select(F.col("doc_id").alias(id_col), "shard", "slot")
    (
        docs.join(spots, id_col)
        .repartition(F.col("shard"), F.pmod("slot", F.lit(files_per_shard)))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
