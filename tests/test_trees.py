"""Node tables against the library's own predictions, ridge by elimination, encoders without one-hot vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.columns import GOLD_SCALARS, SCALAR_FEATURES, SERIES, WEEK_KEY
from demandloom.operators import features, ridge, trees
from demandloom.operators.regression import MEAN_INPUTS, Regressor
from demandloom.plans.lake import build_gold
from helpers import series

SMALL = {
    "RandomForest": {"numTrees": 6, "maxDepth": 5},
    "GradientBoosting": {"maxIter": 5, "maxDepth": 3},
}


@pytest.fixture(scope="module")
def gold(spark):
    frames = [
        series(spark, [40 * s + 9 * i + n + (n * 7 * i) % 13 + 30 * (n % 52 > 44) for n in range(150)], store=s, item=i)
        for s in (1, 2, 3) for i in (1, 2, 5, 10)
    ]
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    return build_gold(whole, 2013).cache()


def compared(own, other):
    both = own.select(*WEEK_KEY, F.col("prediction").alias("a")).join(other.select(*WEEK_KEY, F.col("prediction").alias("b")), list(WEEK_KEY))
    rows = both.collect()
    assert len(rows) == own.count() > 500
    return max(abs(r.a - r.b) for r in rows)


@pytest.mark.parametrize("name", sorted(SMALL))
@pytest.mark.parametrize("encoder", ["one_hot", "means"])
def test_node_table_predicts_like_the_model(spark, gold, name, encoder, tmp_path):
    model = Regressor(name, encoder, **SMALL[name]).fit(gold)
    model.nodes(gold).write.parquet(str(tmp_path / "nodes"))
    nodes = spark.read.schema(trees.NODE_DDL).parquet(str(tmp_path / "nodes"))
    rows = gold.select(*GOLD_SCALARS)
    plain = model.encoded(rows)
    assert compared(model.predict(gold), trees.score(plain, nodes)) < 1e-9
    columns = [c for c in plain.columns if c not in SERIES]
    walked = trees.score_by_joins(plain, nodes, WEEK_KEY, columns, SERIES, depth=6)
    assert compared(walked, trees.score(plain, nodes)) < 1e-9
    # Importances from node statistics.
    slots = F.when(F.col("category").isNull(), F.col("column")).otherwise(F.concat_ws("_ohe_", "column", "category"))
    shares = {r["feature"]: r["importance"] for r in trees.importances(nodes, name == "RandomForest").select(slots.alias("feature"), "importance").collect()}
    for r in model.importances(gold).collect():
        assert shares.get(r["feature"], 0.0) == pytest.approx(r["importance"], abs=1e-9)


def test_every_leaf_of_a_boosted_model_is_a_mean(spark, gold):
    """Recomputed by the walk: the first tree means targets, each later one twice what is left."""
    model = Regressor("GradientBoosting", maxIter=4, maxDepth=3).fit(gold)
    nodes = model.nodes(gold).toPandas()
    rows = gold.select(*GOLD_SCALARS).toPandas()
    y, total = rows["weekly_sales"].to_numpy(dtype=float), np.zeros(len(rows))
    for tree, own in nodes.groupby("tree"):
        own = own.set_index("node")
        target = y if tree == 0 else 2 * (y - total)
        at = []
        for _, r in rows.iterrows():
            k = 0
            while own.loc[k, "column"] is not None and own.loc[k, "column"] == own.loc[k, "column"]:
                n = own.loc[k]
                left = r[n["column"]] <= n["limit"] if n["category"] is None else str(int(r[n["column"]])) != n["category"]
                k = int(n["left"] if left else n["right"])
            at.append(k)
        at = np.array(at)
        for k in set(at):
            assert own.loc[k, "value"] == pytest.approx(target[at == k].mean(), abs=1e-6)
            assert own.loc[k, "rows"] == (at == k).sum()
        total += own.loc[0, "weight"] * own.loc[at, "value"].to_numpy()


def test_odd_rows_are_scored(spark, gold):
    """Unseen categories, nulls, and a table of one leaf."""
    nodes = spark.createDataFrame(
        [
            (0, 0, "lag_1_week", None, 5.0, 1, 2, 0.0, 1.0, 1.0, 9.0),
            (0, 1, None, None, None, None, None, 10.0, 1.0, None, 4.0),
            (0, 2, "store", "2", 0.5, 3, 4, 0.0, 1.0, 1.0, 5.0),
            (0, 3, None, None, None, None, None, 20.0, 1.0, None, 3.0),
            (0, 4, None, None, None, None, None, 30.0, 1.0, None, 2.0),
        ],
        trees.NODE_DDL,
    )
    rows = spark.createDataFrame([(1, 4.0, 2), (2, 6.0, 2), (3, 6.0, 77), (4, None, 2), (5, None, None)], "k int, lag_1_week double, store int")
    want = {1: 10.0, 2: 30.0, 3: 20.0, 4: 30.0, 5: 20.0}
    assert {r.k: r.prediction for r in trees.score(rows, nodes).collect()} == want
    assert {r.k: r.prediction for r in trees.score_by_joins(rows, nodes, ["k"], ["lag_1_week"], ["store"], 3).collect()} == want
    leaf = nodes.where("node = 1").withColumn("node", F.lit(0))
    assert {r.prediction for r in trees.score(rows, leaf).collect()} == {10.0}
    assert trees.score(rows.where("false"), nodes).count() == 0
    assert trees.importances(leaf).collect() == []


def test_ridge_equals_the_library(spark, gold, tmp_path):
    library = Regressor("LinearRegression").fit(gold).predict(gold)
    found = ridge.fit_ridge(gold)
    assert compared(library, found.predict(gold)) < 1e-6
    found.save(str(tmp_path / "ridge"))
    assert compared(found.predict(gold), ridge.Ridge.load(spark, str(tmp_path / "ridge")).predict(gold)) < 1e-12
    unseen = gold.limit(1).withColumn("store", F.lit(99)).withColumn("item", F.lit(None).cast("int"))
    assert found.predict(unseen).first().prediction is not None


def test_ridge_of_plain_equations(spark):
    """All equations in full width, solved by numpy."""
    rng = np.random.default_rng(4)
    rows = [(float(x), 7.0, int(s), int(i), float(3 * x + 5 * s - 2 * i + e)) for x, s, i, e in zip(rng.normal(900, 2, 400), rng.integers(0, 3, 400), rng.integers(0, 30, 400), rng.normal(size=400))]
    df = spark.createDataFrame(rows, "x double, flat double, store int, item int, y double")
    found = ridge.fit_ridge(df, ("x", "flat"), target="y")
    x = np.array([r[0] for r in rows])
    dummies = [np.array([float(r[2] == s) for r in rows]) for s in range(3)] + [np.array([float(r[3] == i) for r in rows]) for i in range(30)]
    z, y = np.column_stack([x, *dummies]), np.array([r[4] for r in rows])
    centred, target = z - z.mean(axis=0), y - y.mean()
    gram = centred.T @ centred / 400
    beta = np.linalg.solve(gram + 0.1 / y.std() * np.diag(np.diag(gram)), centred.T @ target / 400)
    want = y.mean() + centred @ beta
    got = {(r.x, r.store, r["item"]): r.prediction for r in found.predict(df).collect()}
    assert all(got[r[0], r[2], r[3]] == pytest.approx(w, abs=1e-8) for r, w in zip(rows, want))
    assert abs(found.slopes[1]) < 1e-9


def test_fold_means_leave_the_own_fold_out(spark):
    rows = [(1, w, w % 3, 10 * w + c) for w in range(9) for c in range(2)] + [(2, 0, 0, 500), (None, 1, 1, 7), (3, 2, 2, None)]
    df = spark.createDataFrame(rows, "item int, week int, f int, weekly_sales int")
    got = features.fold_means(df, "item", F.col("f"), weight=4).collect()
    assert len(got) == len(rows)
    for r in got:
        others = [x for x in rows if x[2] != r.f and x[3] is not None]
        mine = [x[3] for x in others if x[0] == r["item"]]
        overall = sum(x[3] for x in others) / len(others)
        assert r.item_mean == pytest.approx((sum(mine) + 4 * overall) / (len(mine) + 4))


def test_mean_encoded_regressor_saves_and_needs_no_catalogue(spark, gold, tmp_path):
    model = Regressor("LinearRegression", "means").fit(gold.select(*GOLD_SCALARS))
    path = str(tmp_path / "m")
    model.save(path)
    again = Regressor.load("LinearRegression", path, "means")
    assert compared(model.predict(gold.select(*GOLD_SCALARS)), again.predict(gold.select(*GOLD_SCALARS))) < 1e-9
    assert len(model.model.stages) == 2 and model.inputs == MEAN_INPUTS


def test_a_catalogue_of_many_items(spark):
    """A regressor and a ridge of 300,000 items: nothing is as wide as the catalogue."""
    values = [((F.col("id") * 7919 + k) % 97).cast("double").alias(c) for k, c in enumerate(SCALAR_FEATURES)]
    rows = spark.range(600_000).select(
        (F.col("id") % 5).cast("int").alias("store"), (F.col("id") % 300_000).cast("int").alias("item"), (F.col("id") % 150).cast("int").alias("abs_week"),
        *values, (F.col("id") % 300_000 % 50 + F.col("id") % 3).cast("double").alias("weekly_sales"),
    )
    model = Regressor("LinearRegression", "means").fit(rows)
    assert len(model.model.stages[-1].coefficients) == len(MEAN_INPUTS)
    found = ridge.fit_ridge(rows)
    assert found.sparse_effects.count() == 300_000 and len(found.dense_effects) == 5
