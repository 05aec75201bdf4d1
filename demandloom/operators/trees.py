"""Fitted tree ensembles as a table of nodes, scored and explained without their library.

A node row holds a question on a plain column (``column <= limit``, or for one category of
a column, ``column <> category``), the nodes on either side, the node's value, and how much
the question gained on how many rows. So stored models need no feature vectors, no encoder and
no session that trained them, and a table's size is set by the number and depth of trees.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..session import shared_folder

NODE_DDL = (
    "tree int, node int, column string, category string, limit double, left int, right int, "
    "value double, weight double, gain double, rows double"
)
#: Nodes of a table that one process holds for scoring; a table of more must be scored by joins.
MOST_NODES = 5_000_000


def slot_columns(attributes, one_hot):
    """(slot, column, category) of a feature vector from its attribute names.

    ``one_hot`` maps a one-hot column to the column it encodes; its slots are named after it.
    """
    out = []
    for group in attributes.values():
        for a in group:
            source = next((c for c in one_hot if a["name"].startswith(f"{c}_")), None)
            out.append((a["idx"], one_hot[source], a["name"][len(source) + 1 :]) if source else (a["idx"], a["name"], None))
    return sorted(out)


def node_table(spark, model, slots):
    """Node rows of a fitted MLlib forest or boosted ensemble.

    The library's own stored form is read back as a table, so no node passes through the
    driver. ``slots`` are the rows of ``slot_columns``. Weights are such that a prediction is
    the sum of weight times value over the trees.
    """
    path = shared_folder(spark, "trees")
    model.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "_about", "_weight").select("tree", "_weight")
    named = spark.createDataFrame(slots, "slot int, column string, category string")
    averaged = "Forest" in type(model).__name__
    split = F.col("nodeData.split")
    bound = F.get(split["leftCategoriesOrThreshold"], F.lit(0))
    # A slot of zeros and ones may come as two categories; the side of the zeros is left here.
    binary = split["numCategories"] == 2
    swapped = binary & (bound == 1.0)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.when(split["featureIndex"] >= 0, split["featureIndex"]).alias("slot"),
        F.when(split["numCategories"] > 2, F.raise_error(F.lit("questions on more than two categories"))).otherwise(
            F.when(binary, F.lit(0.5)).otherwise(bound)
        ).cast("double").alias("limit"),
        F.when(swapped, F.col("nodeData.rightChild")).otherwise(F.col("nodeData.leftChild")).alias("_left"),
        F.when(swapped, F.col("nodeData.leftChild")).otherwise(F.col("nodeData.rightChild")).alias("_right"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.gain").alias("gain"),
        F.get("nodeData.impurityStats", F.lit(0)).alias("rows"),
    )
    inner = F.col("slot").isNotNull()
    return nodes.join(named, "slot", "left").join(weights, "tree").select(
        "tree",
        "node",
        "column",
        "category",
        F.when(inner, F.col("limit")).alias("limit"),
        F.when(inner, F.col("_left")).alias("left"),
        F.when(inner, F.col("_right")).alias("right"),
        "value",
        (F.col("_weight") / (F.lit(model.getNumTrees) if averaged else F.lit(1))).alias("weight"),
        F.when(inner, F.col("gain")).alias("gain"),
        "rows",
    )


class Ensemble:
    """The nodes of a table as arrays: one walk takes a batch of rows through all trees."""

    def __init__(self, nodes):
        nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
        inner = nodes["column"].notna().to_numpy()
        asked = nodes["column"][inner].unique().tolist()
        self.columns = sorted(asked)
        of = {c: k for k, c in enumerate(self.columns)}
        self.categories = {c: {} for c in self.columns}
        first = {t: k for k, t in reversed(list(enumerate(nodes["tree"])))}
        place = {key: k for k, key in enumerate(zip(nodes["tree"], nodes["node"]))}
        n = len(nodes)
        self.inner, self.value = inner, (nodes["value"] * nodes["weight"]).to_numpy(dtype=float)
        self.column, self.limit = np.zeros(n, dtype=np.intp), np.zeros(n)
        self.named, self.left, self.right = np.zeros(n, dtype=bool), np.arange(n), np.arange(n)
        for k in np.flatnonzero(inner):
            row = nodes.iloc[k]
            self.column[k] = of[row["column"]]
            if row["category"] is not None:
                known = self.categories[row["column"]]
                self.named[k], self.limit[k] = True, known.setdefault(row["category"], len(known))
            else:
                self.limit[k] = row["limit"]
            self.left[k], self.right[k] = place[row["tree"], row["left"]], place[row["tree"], row["right"]]
        self.roots = sorted(first.values())

    def matrix(self, columns):
        """Values of all asked columns; of a category its number, or -1 where no node asks for it."""
        out = np.empty((len(columns[0]) if columns else 0, len(self.columns)))
        for k, (name, values) in enumerate(zip(self.columns, columns)):
            known = self.categories[name]
            if known:
                out[:, k] = values.map(lambda v: known.get(v, -1)).to_numpy(dtype=float)
            else:
                out[:, k] = pd.to_numeric(values).to_numpy(dtype=float)
        return out

    def predict(self, x):
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots:
            at, open_rows = np.full(len(x), root), rows
            while len(open_rows):
                here = at[open_rows]
                open_rows, here = open_rows[self.inner[here]], here[self.inner[here]]
                seen, limit = x[open_rows, self.column[here]], self.limit[here]
                # A null answers no question and goes right, as in the library.
                go_left = np.where(self.named[here], seen != limit, seen <= limit)
                at[open_rows] = np.where(go_left, self.left[here], self.right[here])
            total += self.value[at]
        return total


def score(rows, nodes):
    """``rows`` with ``prediction`` from a node table, whose nodes are few enough to hold."""
    held = nodes.limit(MOST_NODES + 1).toPandas()
    if len(held) > MOST_NODES:
        raise ValueError(f"over {MOST_NODES} nodes: use score_by_joins")
    held["category"] = held["category"].astype(object).where(held["category"].notna(), None)
    ensemble = rows.sparkSession.sparkContext.broadcast(Ensemble(held))
    own = ensemble.value

    @F.pandas_udf("double")
    def walk(row: pd.DataFrame) -> pd.Series:
        model = ensemble.value
        return pd.Series(model.predict(model.matrix([row[c] for c in model.columns])))

    def asked(name):
        return F.col(name).cast("string" if own.categories[name] else "double").alias(name)

    if not own.columns:
        return rows.withColumn("prediction", F.lit(float(own.value[own.roots].sum())))
    return rows.withColumn("prediction", walk(F.struct(*map(asked, own.columns))))


def score_by_joins(rows, nodes, keys, columns, categories=(), depth=30):
    """Keys and ``prediction`` by walking the table with one join a level, for tables of any size.

    ``keys`` name a row. ``columns`` are the numeric and ``categories`` the category columns
    that nodes may ask for.
    """
    keys = list(keys)
    numbers = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("double"))]) if columns else F.create_map()
    names = F.create_map(*[x for c in categories for x in (F.lit(c), F.col(c).cast("string"))]) if categories else F.create_map()
    state = rows.select(
        *keys, numbers.cast("map<string,double>").alias("_numbers"), names.cast("map<string,string>").alias("_names")
    ).withColumn("node", F.lit(0))
    # The number of trees is a setting of the model.
    trees = [r["tree"] for r in nodes.select("tree").distinct().collect()]
    state = state.withColumn("tree", F.explode(F.array(*map(F.lit, trees)).cast("array<int>")))
    done = []
    for _ in range(depth + 1):
        met = state.join(nodes, ["tree", "node"])
        done.append(met.where("column is null").select(*keys, (F.col("weight") * F.col("value")).alias("_part")))
        seen = F.coalesce(F.element_at("_numbers", F.col("column")), F.lit(float("nan")))
        left = F.when(F.col("category").isNotNull(), ~F.element_at("_names", F.col("column")).eqNullSafe(F.col("category"))).otherwise(
            seen <= F.col("limit")
        )
        state = met.where("column is not null").select(
            *keys, "_numbers", "_names", "tree", F.when(left, F.col("left")).otherwise(F.col("right")).alias("node")
        )
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*keys).agg(F.sum("_part").alias("prediction"))


def importances(nodes, per_tree=True):
    """Share of each column (or category) in the gain of all questions, highest first.

    With ``per_tree`` every tree counts alike, as in forests; without it, trees that gained
    more count more, as in boosting.
    """
    gains = (
        nodes.where("column is not null")
        .groupBy("tree", "column", "category")
        .agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    )
    if per_tree:
        whole = gains.groupBy("tree").agg(F.sum("gain").alias("_tree_gain")).where("_tree_gain <> 0")
        gains = gains.join(whole, "tree").withColumn("gain", F.col("gain") / F.col("_tree_gain"))
    summed = gains.groupBy("column", "category").agg(F.sum("gain").alias("gain"))
    total = summed.agg(F.sum("gain")).scalar()
    return summed.select("column", "category", F.try_divide(F.col("gain"), total).alias("importance")).orderBy(
        F.desc("importance"), "column", "category"
    )


def leaf_errors(assigned, nodes):
    """Leaves whose value is not the mean of their rows, from (tree, node, target) rows."""
    means = assigned.groupBy("tree", "node").agg(F.avg("target").alias("mean"), F.count(F.lit(1)).alias("n"))
    leaves = nodes.where("column is null")
    return leaves.join(means, ["tree", "node"], "left").withColumn("error", F.abs(F.col("value") - F.col("mean")))
