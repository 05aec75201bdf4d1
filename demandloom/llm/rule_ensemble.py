"""Quality classifier: rules from tree paths, lasso weights, one Spark expression.

Shallow boosted and bagged trees over text statistics give paths; each path is a
conjunction of limits, which is a 0/1 feature. A lasso logistic regression keeps few of
them, beside the statistics themselves, and the survivors become a column expression.
Scoring is therefore one projection over the texts, without a model in the tasks.
"""

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..session import shared_folder

#: Labelled rows that a fit reads at most, picked by a hash of the id.
FIT_ROWS = 20_000
#: Partitions of the sample during the fit; its many passes are short.
FIT_PARTITIONS = 4
TREES = 12
DEPTH = 3
LASSO = 0.002
SEED = 11

WORD_GAP = r"[\x20\x09-\x0D]+"
MARKS = "!#*$%&|<>[]{}=~^"
STOP_WORDS = (
    "the of and to in is that der die das und den von le la les de et el los y que en"
).split()


def statistics(docs, id_col="doc_id", text_col="text"):
    """doc_id and one double column per statistic of the whole text.

    Ratios of an empty or null text are 0. Only the id and text columns are read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("_text"),
        F.filter(F.split(F.lower(text), WORD_GAP), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line != "").alias("_lines"),
    )
    n, chars = F.size("_words"), F.length("_text")

    def ratio(part, whole):
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")

    pairs = F.arrays_zip(
        F.slice("_words", F.lit(1), F.greatest(n - 1, F.lit(0))).alias("a"),
        F.slice("_words", F.lit(2), F.greatest(n - 1, F.lit(0))).alias("b"),
    )
    own = {
        "words": F.log1p(n.cast("double")),
        "word_chars": ratio(F.length(F.array_join("_words", "")), n),
        "marks": ratio(chars - F.length(F.translate("_text", MARKS, "")), n),
        "digits": ratio(chars - F.length(F.translate("_text", "0123456789", "")), chars),
        "stops": ratio(chars - F.length(F.translate("_text", ".,;:?!", "")), n),
        "capitals": ratio(F.length(F.regexp_replace("_text", r"[^\p{Lu}]", "")), chars),
        "distinct": ratio(F.size(F.array_distinct("_words")), n),
        "stutter": ratio(F.size(F.filter(pairs, lambda p: p["a"] == p["b"])), n),
        "repeated_lines": ratio(F.size("_lines") - F.size(F.array_distinct("_lines")), F.size("_lines")),
        "line_words": F.log1p(ratio(n, F.size("_lines"))),
        "common": ratio(F.size(F.filter("_words", lambda w: w.isin(*STOP_WORDS))), n),
    }
    return base.select("doc_id", *[e.alias(name) for name, e in own.items()])


STATISTICS = (
    "words word_chars marks digits stops capitals distinct stutter repeated_lines line_words common"
).split()


@dataclass(frozen=True)
class Rule:
    """A conjunction of limits: (statistic, "<=" or ">", value)."""

    limits: tuple

    def column(self):
        test = F.lit(True)
        for name, op, value in self.limits:
            test = test & (F.col(name) <= value if op == "<=" else F.col(name) > value)
        return test.cast("double")


@dataclass
class RuleEnsemble:
    """Weights of rules and of scaled statistics, and the intercept of the log odds."""

    rules: list
    slopes: dict
    intercept: float

    def score(self):
        odds = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            odds = odds + rule.column() * F.lit(float(weight))
        for name, weight in self.slopes.items():
            odds = odds + F.col(name) * F.lit(float(weight))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


LIMIT = re.compile(r"\(feature (\d+) (<=|>) ([-0-9.eE]+)\)")


def tree_rules(described, names):
    """Every path from a root, at each depth, in a model's printed trees."""
    found, path = {}, []
    for line in described.splitlines():
        if line.strip().startswith("Tree "):
            path = []
        m = LIMIT.search(line)
        if not m:
            continue
        limit = (names[int(m[1])], m[2], float(m[3]))
        if line.strip().startswith("Else"):
            while path and path[-1][0] != len(line) - len(line.lstrip()):
                path.pop()
            path.pop()
        path.append((len(line) - len(line.lstrip()), limit))
        found[tuple(p[1] for p in path)] = None
    return [Rule(limits) for limits in found]


def fit(labelled, label="quality", names=tuple(STATISTICS), trees=TREES, depth=DEPTH, lasso=LASSO):
    """Fit on rows with the statistics and a 0/1 label; a single class gives a constant score.

    ``labelled`` is a bounded sample, as ``labelled_statistics`` gives it.
    """
    spark = labelled.sparkSession
    labelled = labelled.coalesce(FIT_PARTITIONS)
    known = {r[0]: r[1] for r in labelled.groupBy(F.col(label).cast("int")).count().collect() if r[0] is not None}
    if len(known) < 2:
        return RuleEnsemble([], {}, 20.0 if 1 in known else -20.0 if 0 in known else 0.0)
    data = VectorAssembler(inputCols=list(names), outputCol="_features").transform(
        labelled.withColumn("_label", F.col(label).cast("double"))
    )
    common = dict(featuresCol="_features", labelCol="_label", maxDepth=depth, seed=SEED)
    forest = RandomForestClassifier(numTrees=trees, featureSubsetStrategy="sqrt", **common).fit(data)
    boosted = GBTClassifier(maxIter=trees // 2, stepSize=0.3, **common).fit(data)
    rules = list(
        {r: None for m in (forest, boosted) for r in tree_rules(m.toDebugString, names)}
    )
    path = shared_folder(spark, "rule-ensemble")
    labelled.select(
        F.col(label).cast("double").alias("_label"),
        F.array(*[r.column() for r in rules], *[F.col(n) for n in names]).alias("_values"),
    ).write.parquet(path)
    inputs = (
        spark.read.parquet(path)
        .coalesce(FIT_PARTITIONS)
        .select("_label", array_to_vector("_values").alias("_features"))
    )
    lasso_fit = LogisticRegression(
        featuresCol="_features", labelCol="_label", regParam=lasso, elasticNetParam=1.0, maxIter=100
    ).fit(inputs)
    weights = lasso_fit.coefficients.toArray()
    return RuleEnsemble(
        [(r, w) for r, w in zip(rules, weights) if w],
        {n: w for n, w in zip(names, weights[len(rules) :]) if w},
        lasso_fit.intercept,
    )


def labelled_statistics(docs, labels, label="quality", id_col="doc_id", text_col="text", most=FIT_ROWS):
    """Statistics of labelled documents, of at most about ``most`` rows, stored for the fit.

    A document counts once, with the lowest of its labels. Documents are picked by a hash
    of the id with the share that their number allows, so the picked labels have a known
    bound and may be broadcast.
    """
    spark = docs.sparkSession
    marks = (
        labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(F.col(label).cast("int")).alias("_mark"))
    )
    n = marks.count()
    if n > most:
        draw = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("fit")), F.lit(1 << 20)) / (1 << 20)
        marks = marks.where(draw < most / n)
    picked = docs.select(F.col(id_col).alias("_own"), F.col(text_col).alias("_own_text")).join(
        F.broadcast(marks), F.col("_own") == F.col("_id")
    )
    with_label = picked.select(F.struct("_own", "_mark").alias("pair"), "_own_text")
    path = shared_folder(spark, "quality-labels")
    statistics(with_label, "pair", "_own_text").withColumns(
        {label: F.col("doc_id._mark"), "doc_id": F.col("doc_id._own")}
    ).write.parquet(path)
    return spark.read.parquet(path)


def score_quality(docs, model, threshold=0.3, id_col="doc_id", text_col="text"):
    """doc_id, score from 0 to 1 and predicted label of every row of ``docs``.

    A null text is scored like an empty one, by statistics that are all 0; a score equal to the
    threshold predicts 1; repeated rows are scored each for itself, null ids are kept, an empty
    table gives no rows, and other columns are not read.
    """
    return statistics(docs, id_col, text_col).select(
        "doc_id", model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
