"""Cluster-wide regressors on the gold features."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..columns import SCALAR_FEATURES, SERIES, TARGET
from ..session import shared_folder
from . import trees
from .features import encode_by_mean, encoder_stages, fold_means, target_means

ONE_HOT = {"store_ohe": "store", "item_ohe": "item"}
INPUTS = (*SCALAR_FEATURES, *ONE_HOT)
MEAN_INPUTS = (*SCALAR_FEATURES, *(f"{c}_mean" for c in SERIES))
FOLDS = 5

ESTIMATORS = {
    "LinearRegression": LinearRegression,
    "RandomForest": RandomForestRegressor,
    "GradientBoosting": GBTRegressor,
}
# Default settings of each regressor.
DEFAULTS = {
    "LinearRegression": {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.0},
    "RandomForest": {"numTrees": 100, "maxDepth": 10, "featureSubsetStrategy": "auto", "seed": 42},
    "GradientBoosting": {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": 42},
}
# Not part of a model: larger node groups take fewer passes over the training rows and
# give the same trees.
TUNING = {
    "LinearRegression": {},
    "RandomForest": {"maxMemoryInMB": 512},
    "GradientBoosting": {"maxMemoryInMB": 512},
}


def assembler(inputs=INPUTS):
    return VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="keep")


class Regressor:
    """Assembler and one MLlib regressor, named as in ``ESTIMATORS``.

    Fitted on rows without one-hot columns, it learns the encoder from those rows too and
    keeps it: a loaded regressor scores new weeks, also of stores it has never seen.

    With ``encoder="means"`` a store and an item are one number each, their mean target in
    training, so neither the width nor anything on the driver grows with the catalogue. Training
    rows get the means of the other folds, of weeks dealt out in turn; other rows get the stored
    means of all training rows, and what has none the overall mean.
    """

    def __init__(self, name, encoder="one_hot", inputs=None, **settings):
        if encoder not in ("one_hot", "means"):
            raise ValueError(f"no encoder named {encoder}")
        self.name, self.encoder = name, encoder
        self.inputs = inputs or (MEAN_INPUTS if encoder == "means" else INPUTS)
        self.settings = DEFAULTS[name] | TUNING[name] | settings
        self.model, self.means = None, None

    def fit(self, train):
        estimator = ESTIMATORS[self.name](
            featuresCol="features", labelCol=TARGET, predictionCol="prediction", **self.settings
        )
        stages = []
        if self.encoder == "means":
            spark, path = train.sparkSession, shared_folder(train.sparkSession, "means")
            for column in SERIES:
                target_means(train, column).withColumn("_overall", train.agg(F.avg(TARGET)).scalar()).write.parquet(f"{path}/{column}")
            self.means = {c: spark.read.parquet(f"{path}/{c}") for c in SERIES}
            for column in SERIES:
                train = fold_means(train, column, F.pmod("abs_week", F.lit(FOLDS)))
            # Trees read their rows once a level.
            train.select(*self.inputs, TARGET).write.parquet(f"{path}/train")
            train = spark.read.parquet(f"{path}/train")
        elif any(c in self.inputs and c not in train.columns for c in ONE_HOT):
            stages = encoder_stages()
        self.model = Pipeline(stages=[*stages, assembler(self.inputs), estimator]).fit(train)
        return self

    def _fitted(self):
        if self.model is None:
            raise RuntimeError(f"{self.name} is not fitted")
        return self.model

    def encoded(self, rows):
        """``rows`` with what the model's inputs ask for besides plain columns and one-hot vectors."""
        for column, means in (self.means or {}).items():
            default = means.select("_overall").first()
            rows = encode_by_mean(rows, means.drop("_overall"), column, default[0] if default else 0.0)
        return rows

    def predict(self, rows):
        return self._fitted().transform(self.encoded(rows))

    def save(self, path):
        self._fitted().write().overwrite().save(path)
        for column, means in (self.means or {}).items():
            means.write.mode("overwrite").parquet(f"{path}-means/{column}")

    @classmethod
    def load(cls, name, path, encoder="one_hot"):
        regressor = cls(name, encoder)
        regressor.model = PipelineModel.load(path)
        if encoder == "means":
            spark = SparkSession.getActiveSession()
            regressor.means = {c: spark.read.parquet(f"{path}-means/{c}") for c in SERIES}
        return regressor

    def _attributes(self, rows):
        inputs = PipelineModel(stages=self._fitted().stages[:-1])
        return inputs.transform(self.encoded(rows.limit(0))).schema["features"].metadata["ml_attr"]["attrs"]

    def nodes(self, rows):
        """The trees as a table of nodes on plain columns; ``rows`` only show the columns' names."""
        slots = trees.slot_columns(self._attributes(rows), ONE_HOT)
        return trees.node_table(rows.sparkSession, self._fitted().stages[-1], slots)

    def training_fit(self):
        """Training rmse and R² of a linear regression."""
        summary = self._fitted().stages[-1].summary
        return {"rmse": summary.rootMeanSquaredError, "r2": summary.r2}

    def importances(self, rows, n=None):
        """Slot, feature name and importance of a tree model, highest first.

        Slot names come from the vector column's metadata; the values are model
        state, one per feature slot.
        """
        spark = rows.sparkSession
        names = {a["idx"]: a["name"] for group in self._attributes(rows).values() for a in group}
        values = self._fitted().stages[-1].featureImportances.toArray()
        table = spark.createDataFrame(
            [(i, names.get(i, str(i)), float(v)) for i, v in enumerate(values)],
            "slot int, feature string, importance double",
        ).orderBy(F.desc("importance"), "slot")
        return table.limit(n) if n else table
