"""The whole job: validation, layers, training and evaluation, from any stage on."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..columns import BASE_YEAR, TEST_YEAR, TRAIN_UNTIL
from ..operators.evaluation import compare_models
from ..sources.readers import read_layer
from .lake import LAYERS, build_lake, layer_paths
from .training import train_and_compare

STAGES = (*LAYERS, "train", "evaluate")


def _events(spark, root):
    """The job's log: what began and what was done, in order."""
    try:
        return spark.read.schema("seq long, stage string, event string").parquet(f"{root}/stages").orderBy("seq").collect()
    except AnalysisException:
        return []


def _note(spark, root, event, *stages):
    last = max((e["seq"] for e in _events(spark, root)), default=0)
    rows = [(last + k, s, event) for k, s in enumerate(stages, 1)]
    spark.createDataFrame(rows, "seq long, stage string, event string").coalesce(1).write.mode("append").parquet(f"{root}/stages")


def first_open_stage(spark, root):
    """The first stage that is not done, or was done before an earlier one began again."""
    state = {e["stage"]: e["event"] for e in _events(spark, root)}
    return next((s for s in STAGES if state.get(s) != "done"), STAGES[-1])


def run_all(
    spark,
    root,
    holidays,
    raw=None,
    checks=None,
    base_year=BASE_YEAR,
    train_until=TRAIN_UNTIL,
    test_year=TEST_YEAR,
    start="bronze",
    settings=None,
):
    """Run the stages from ``start`` on and return the metric table, lowest rmse first.

    Every stage reads what the one before it stored below ``root``. A log there says which
    stages are done; a stage that begins opens all after it. With ``start=None`` the job goes
    on from the first open stage, so a layer whose overwrite failed half way is written again
    before anything reads it, and training goes on with the first model not complete.
    """
    resume = start is None
    todo = STAGES[STAGES.index(first_open_stage(spark, root) if resume else start) :]
    _note(spark, root, "open", *todo)
    for number, stage in enumerate(todo):
        if stage in LAYERS:
            build_lake(spark, root, holidays, base_year, raw, stage, checks, train_until, stop=stage)
        elif stage == "train":
            gold = read_layer(spark, layer_paths(root)["gold"])
            # Models of an earlier run count only if gold was not built anew.
            train_and_compare(gold, f"{root}/training", train_until, test_year, settings, resume=resume and number == 0)
        _note(spark, root, "done", stage)
    return compare_models(spark.read.parquet(f"{root}/training/metrics"))


def stage_log(spark, root):
    """The log as a table, latest event last."""
    return spark.read.parquet(f"{root}/stages").orderBy(F.col("seq"))
