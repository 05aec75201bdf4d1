"""Ridge regression on scalars and two categories, from sums alone.

The model is an intercept, one slope per scalar, one effect per store and one per item, with the
penalty on standardised effects that MLlib's linear regression uses. The items' part of the
normal equations is diagonal, as a row has one item, so it is eliminated: what is left to
solve is as wide as the scalars and the stores, whatever the catalogue. Every item's effect
follows from its own sums and stays a row of a table. One pass over the rows makes all sums.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..columns import SCALAR_FEATURES, TARGET
from ..session import shared_folder

PENALTY = 0.1
#: Scalars and stores that the equations left may have; they are solved in one process.
MOST_DENSE = 4096


def _sums(rows, scalars, dense, sparse, target):
    """Per store and item: rows, sums of scalars and target, and all second moments."""
    x = [F.col(c).cast("double") for c in scalars]
    y = F.col(target).cast("double")
    return rows.groupBy(F.col(dense).cast("string").alias("dense"), F.col(sparse).cast("string").alias("sparse")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("y"), *[F.sum(v).alias(f"x{k}") for k, v in enumerate(x)]
    )


def _moments(rows, scalars, target, means):
    """Centred second moments of the scalars and the target, as one row of sums."""
    values = [F.col(c).cast("double") - F.lit(m) for c, m in zip((*scalars, target), means)]
    pairs = [(a, b) for a in range(len(values)) for b in range(a + 1)]
    row = rows.agg(*[F.sum(values[a] * values[b]).alias(f"s{a}_{b}") for a, b in pairs]).first()
    out = np.zeros((len(values), len(values)))
    for a, b in pairs:
        out[a, b] = out[b, a] = row[f"s{a}_{b}"] or 0.0
    return out


class Ridge:
    """Intercept, slopes, store effects, and a table of item effects."""

    def __init__(self, scalars, dense, sparse, intercept, slopes, dense_effects, sparse_effects):
        self.scalars, self.dense, self.sparse = list(scalars), dense, sparse
        self.intercept, self.slopes, self.dense_effects = float(intercept), list(map(float, slopes)), dict(dense_effects)
        self.sparse_effects = sparse_effects

    def predict(self, rows, output="prediction"):
        """``rows`` with the prediction; a store or item not seen in fitting has no effect."""
        spark = rows.sparkSession
        value = F.lit(self.intercept)
        for name, slope in zip(self.scalars, self.slopes):
            value = value + F.col(name).cast("double") * F.lit(slope)
        known = spark.createDataFrame(list(self.dense_effects.items()), "_dense string, _dense_effect double")
        return (
            rows.join(F.broadcast(known), F.col(self.dense).cast("string") == F.col("_dense"), "left")
            .join(self.sparse_effects, F.col(self.sparse).cast("string") == F.col("_sparse"), "left")
            .withColumn(
                output, value + F.coalesce("_dense_effect", F.lit(0.0)) + F.coalesce("_sparse_effect", F.lit(0.0))
            )
            .drop("_dense", "_sparse", "_dense_effect", "_sparse_effect")
        )

    def save(self, path):
        spark = self.sparse_effects.sparkSession
        whole = [("intercept", None, self.intercept)] + [("slope", c, b) for c, b in zip(self.scalars, self.slopes)]
        whole += [("dense", c, b) for c, b in self.dense_effects.items()] + [("names", f"{self.dense}/{self.sparse}", 0.0)]
        spark.createDataFrame(whole, "kind string, name string, value double").write.mode("overwrite").parquet(f"{path}/dense")
        self.sparse_effects.write.mode("overwrite").parquet(f"{path}/sparse")

    @classmethod
    def load(cls, spark, path):
        rows = spark.read.parquet(f"{path}/dense").collect()
        of = lambda kind: [(r["name"], r["value"]) for r in rows if r["kind"] == kind]
        dense, sparse = of("names")[0][0].split("/")
        slopes = of("slope")
        return cls(
            [c for c, _ in slopes], dense, sparse, of("intercept")[0][1], [b for _, b in slopes], of("dense"),
            spark.read.parquet(f"{path}/sparse"),
        )


def fit_ridge(rows, scalars=SCALAR_FEATURES, dense="store", sparse="item", target=TARGET, penalty=PENALTY):
    """Fit on the rows of complete scalars and target; ``dense`` is the smaller category.

    Item sums are a stored table. Its part of the equations comes as one small matrix per
    task and is added in Spark; only matrices as wide as scalars and stores reach the driver.
    """
    spark = rows.sparkSession
    known = rows.dropna(subset=[*scalars, target, dense, sparse])
    path = shared_folder(spark, "ridge")
    _sums(known, scalars, dense, sparse, target).write.parquet(path)
    sums = spark.read.parquet(path)
    p = len(scalars)
    per_dense = sums.groupBy("dense").agg(*[F.sum(c).alias(c) for c in ("n", "y", *(f"x{k}" for k in range(p)))])
    stores = sorted(per_dense.limit(MOST_DENSE + 1).collect(), key=lambda r: r["dense"])
    if p + len(stores) > MOST_DENSE:
        raise ValueError(f"over {MOST_DENSE} scalars and categories of {dense}: give the smaller category as dense")
    if not stores:
        raise ValueError("no complete row to fit on")
    total = sum(r["n"] for r in stores)
    means = np.array([sum(r[f"x{k}"] for r in stores) for k in range(p)] + [sum(r["y"] for r in stores)]) / total
    moments = _moments(known, scalars, target, means)
    spread = np.sqrt(moments[p, p] / total)
    width = p + len(stores)
    place = {r["dense"]: p + k for k, r in enumerate(stores)}
    ridge = penalty / spread if spread > 0 else 0.0

    # Unknowns: slopes, store effects, item effects, and last the intercept, on centred scalars and target.
    gram, right = np.zeros((width + 1, width + 1)), np.zeros(width + 1)
    gram[:p, :p], right[:p] = moments[:p, :p], moments[:p, p]
    gram[width, width] = total
    for r in stores:
        k, n = place[r["dense"]], r["n"]
        centred = np.array([r[f"x{j}"] for j in range(p)]) - n * means[:p]
        gram[k, :p], gram[:p, k] = centred, centred
        gram[k, k] = gram[k, width] = gram[width, k] = n
        right[k] = r["y"] - n * means[p]
        gram[k, k] += ridge * n * (1 - n / total)
    gram[np.arange(p), np.arange(p)] += ridge * np.diag(moments)[:p]

    def penalised(n):
        return n + ridge * n * (1 - n / total)

    # Per item: its column of the equations, divided by its diagonal, is taken from the rest.
    items = sums.groupBy("sparse").agg(
        F.sum("n").alias("n"), F.sum("y").alias("y"), *[F.sum(f"x{k}").alias(f"x{k}") for k in range(p)],
        F.collect_list(F.struct("dense", "n")).alias("by_dense"),  # bounded by the stores
    )

    def columns_of(batch):
        n = batch.column("n").to_numpy(zero_copy_only=False).astype(float)
        z = np.zeros((len(n), width + 1))
        for k in range(p):
            z[:, k] = batch.column(f"x{k}").to_numpy(zero_copy_only=False) - n * means[k]
        for i, own in enumerate(batch.column("by_dense").to_pylist()):
            for pair in own:
                z[i, place[pair["dense"]]] = pair["n"]
        z[:, width] = n
        return n, batch.column("y").to_numpy(zero_copy_only=False).astype(float) - n * means[p], z

    def taken(batches):
        matrix = np.zeros((width + 1, width + 2))
        for batch in batches:
            n, y, z = columns_of(batch)
            scaled = z / penalised(n)[:, None]
            matrix[:, :-1] += z.T @ scaled
            matrix[:, -1] += scaled.T @ y
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(width + 1), pa.int32()), "row": list(matrix)})

    parts = items.mapInArrow(taken, "at int, row array<double>").select("at", F.posexplode("row").alias("column", "value"))
    for r in parts.groupBy("at", "column").agg(F.sum("value").alias("value")).collect():
        if r["column"] <= width:
            gram[r["at"], r["column"]] -= r["value"]
        else:
            right[r["at"]] -= r["value"]

    # A scalar without spread has no slope.
    constant = np.flatnonzero(np.diag(moments)[:p] <= 0)
    gram[constant, :], gram[:, constant], right[constant] = 0.0, 0.0, 0.0
    gram[constant, constant] = 1.0
    found = np.linalg.lstsq(gram, right, rcond=1e-13)[0]

    def effects(batches):
        for batch in batches:
            n, y, z = columns_of(batch)
            yield pa.RecordBatch.from_pydict(
                {"_sparse": batch.column("sparse"), "_sparse_effect": (y - z @ found) / penalised(n)}
            )

    items.mapInArrow(effects, "_sparse string, _sparse_effect double").write.parquet(f"{path}-effects")
    intercept = means[p] + found[width] - means[:p] @ found[:p]
    return Ridge(
        scalars, dense, sparse, intercept, found[:p], [(s, float(found[k])) for s, k in place.items()],
        spark.read.parquet(f"{path}-effects"),
    )
