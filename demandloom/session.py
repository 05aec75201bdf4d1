"""Session helpers for local runs; a cluster brings its own session."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app="demandloom", cpus=None, memory="8g"):
    cpus = int(cpus or os.cpu_count() or 4)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .getOrCreate()
    )


def shared_folder(spark, purpose):
    """A fresh folder below ``spark.checkpoint.dir``, storage that every executor reaches.

    Only a local session, where driver and executors are one process, may do without
    that setting; its folders then lie in this machine's temporary folder. Nothing here
    deletes a folder, because lazy results still read it: whoever owns the checkpoint
    folder clears it when the application has ended.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master.startswith("local") and not master.startswith("local-cluster")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="demandloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
