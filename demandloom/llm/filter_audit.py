"""How five filters interact in each of their 120 orders, without running any order.

A document's fate in every order follows from its mask, the set of filters it fails. It is
removed at step s by filter f where f stands at place s and no filter of the mask stands
before. Orders that begin with the same s letters follow each other in the dictionary, so
their Lehmer ranks are one interval. Each mask therefore covers a fixed set of intervals
per step; documents are counted per part and mask, the counts are added where an interval
begins and taken away where it ends, and a running sum over the 120 ranks gives the totals.

Texts are read once, for the mask and a digest. Whether a text stands under a smaller id
is asked with the pair of digest and least id, which is as good as unique, so a group of
copies never meets under one key.
"""

import hashlib
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .rows import map_slices

FILTERS = "ABCDE"
# Fixed by the contract.
LEAST_WORDS = 50
DISTINCT_SHARE = 65
CAPITAL_SHARE = 5
MARKS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: UTF-8 bytes that continue a character.
CONTINUING = bytes(range(0x80, 0xC0))
MEASURES = ("removed", "good_lost", "toxic_lost")


def text_mask(data):
    """Bits of the filters A to D that a text, as UTF-8 bytes, fails."""
    words = data.split()  # ASCII white space, the contract's
    length = len(data.translate(None, CONTINUING))
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < DISTINCT_SHARE * len(words)) << 1
        | (100 * capitals > CAPITAL_SHARE * length) << 2
        | (len(data.translate(None, MARKS)) < len(data)) << 3
    )


def lehmer_rank(order, letters=FILTERS):
    """Place of an order of ``letters``, or of the first order that begins so, in the dictionary."""
    left, rank = sorted(letters), 0
    for k, letter in enumerate(order):
        rank = rank * (len(letters) - k) + left.index(letter)
        left.remove(letter)
    for k in range(len(order), len(letters)):
        rank *= len(letters) - k
    return rank


def removal_intervals(letters=FILTERS):
    """(mask, step, first rank, rank behind the last) of every removal, from the orders' beginnings."""
    out = []
    for mask in range(1, 1 << len(letters)):
        fails = {f for k, f in enumerate(letters) if mask >> k & 1}
        for step in range(1, len(letters) + 1):
            width = 1
            for k in range(1, len(letters) - step + 1):
                width *= k
            for begin in permutations(letters, step):
                if begin[-1] in fails and not fails & set(begin[:-1]):
                    rank = lehmer_rank(begin, letters)
                    out.append((mask, step, rank, rank + width))
    return out


def _letters_at(rank, size):
    """The order of a rank as a text: its Lehmer digits pick letters from those left."""
    left, order, below = F.lit(FILTERS[:size]), F.lit(""), 1
    for k in range(1, size + 1):
        below *= k
    for k in range(size):
        below //= size - k
        digit = F.floor(rank / below) % (size - k)
        letter = F.call_function("substring", left, (digit + 1).cast("int"), F.lit(1))
        order, left = F.concat(order, letter), F.replace(left, letter, F.lit(""))
    return order


def failed_masks(docs, id_col="doc_id", text_col="text", part_col="source"):
    """doc_id, part, mask of the filters failed (bit 0 is A) and how many documents have all three.

    A null text is empty, a null part the empty string. Equal texts are those with one
    BLAKE2 digest of 128 bits. A row without an id has no smaller one to repeat and passes E;
    rows that share id and text are no copies of each other. Other columns are not read.
    """
    spark = docs.sparkSession
    path = shared_folder(spark, "filter-audit")

    def work(slices):
        for batch in slices:
            texts = [t or b"" for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            yield {
                "doc_id": batch.column("doc_id"),
                "part": batch.column("part"),
                "own": [text_mask(t) for t in texts],
                "digest": [hashlib.blake2b(t, digest_size=16).digest() for t in texts],
            }

    kind = docs.schema[id_col].dataType.simpleString()
    columns = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).alias("_text"),
    )
    map_slices(columns, work, f"doc_id {kind}, part string, own int, digest binary").write.parquet(path)
    stored = spark.read.parquet(path)
    least = stored.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    # Repeated rows are one row with a count before the join, whose key is then unique.
    rows = stored.groupBy("doc_id", "part", "own", "digest").agg(F.count(F.lit(1)).alias("n"))
    copied = F.col("_first").isNull() & F.col("doc_id").isNotNull()
    return (
        rows.join(least, ["digest", "doc_id"], "left")
        .withColumn("mask", F.when(copied, F.col("own") + 16).otherwise(F.col("own")))
        .groupBy("doc_id", "part", "mask")
        .agg(F.sum("n").alias("n"))
    )


def mask_counts(masks, labels, id_col="doc_id"):
    """Documents per part and mask, and those of them marked as good and as toxic.

    A document is marked if any label row of its id says so; null ids and marks say nothing.
    """
    marked = labels.groupBy(F.col(id_col).alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    of = lambda mark: F.sum(F.when(F.col(mark) == 1, F.col("n")).otherwise(0))
    return (
        masks.join(marked, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("removed"), of("good").alias("good_lost"), of("toxic").alias("toxic_lost"))
    )


def audit(counts):
    """One row per part, order of the filters and step, from the rows of ``mask_counts``.

    Everything here is small: 32 rows a part come in, 600 go out, and no window holds more.
    """
    spark, steps, ranks = counts.sparkSession, len(FILTERS), lehmer_rank(FILTERS[::-1]) + 1
    path = shared_folder(spark, "mask-counts")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    intervals = spark.createDataFrame(removal_intervals(), "mask int, step int, low int, high int")
    ends = F.explode(
        F.array(
            F.struct(F.col("low").alias("rank"), F.lit(1).alias("sign")),
            F.struct(F.col("high").alias("rank"), F.lit(-1).alias("sign")),
        )
    )
    changes = (
        counts.join(intervals, "mask")
        .withColumn("end", ends)
        .select("part", "step", "end.rank", *[(F.col(c) * F.col("end.sign")).alias(c) for c in MEASURES])
        .where(F.col("rank") < ranks)
    )
    every = (
        counts.select("part")
        .distinct()
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
        .withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))))
        .select("part", "step", "rank", *[F.lit(0).cast("long").alias(c) for c in MEASURES])
    )
    up_to_rank = Window.partitionBy("part", "step").orderBy("rank")
    up_to_step = Window.partitionBy("part", "rank").orderBy("step")
    any_step = Window.partitionBy("part", "filter")
    fails = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("filter"),
                    F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.col("removed")).otherwise(0).alias("fails"),
                    F.when(F.col("mask") == 1 << k, F.col("removed")).otherwise(0).alias("alone"),
                )
                for k, f in enumerate(FILTERS)
            ]
        )
    )
    per_filter = (
        counts.select("part", "removed", fails.alias("f"))
        .groupBy("part", "f.filter")
        .agg(F.sum("removed").alias("total"), F.sum("f.fails").alias("fails"), F.sum("f.alone").alias("unique_fails"))
    )
    placed = (
        changes.unionByName(every)
        .groupBy("part", "step", "rank")
        .agg(*[F.sum(c).alias(c) for c in MEASURES])
        .repartition("part")
        .withColumns({c: F.sum(c).over(up_to_rank) for c in MEASURES})
        .withColumn("filter_order", _letters_at(F.col("rank"), steps))
        .withColumn("filter", F.call_function("substring", "filter_order", "step", F.lit(1)))
        .withColumns({"gone": F.sum("removed").over(up_to_step), "shapley": F.sum("removed").over(any_step)})
    )
    return placed.join(per_filter, ["part", "filter"]).select(
        "part",
        "filter_order",
        "step",
        "filter",
        (F.col("total") - F.col("gone")).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )


def audit_filters(docs, labels, id_col="doc_id", text_col="text", part_col="source"):
    """The audit of whole ``docs``; no rows for an empty table."""
    return audit(mask_counts(failed_masks(docs, id_col, text_col, part_col), labels, id_col))
