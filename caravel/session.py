"""A session with the settings that the plans expect."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "caravel", **more: str) -> SparkSession:
    """Adaptive plans, UTC, Kryo-free defaults; a cluster's own settings win over these, as spark-submit sets them first."""
    builder = SparkSession.builder.appName(name)
    wanted = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    for k, v in {**wanted, **more}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder that driver and executors share, ``spark.checkpoint.dir``; a temporary
    one only where that is unset and the master is local, as in tests."""
    spark = df.sparkSession
    sc, folder = spark.sparkContext, spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="caravel-")
            atexit.register(shutil.rmtree, folder, True)
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
