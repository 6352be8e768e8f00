"""Where derived data may be written, and how small inputs are spread over the cores."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, visible to every executor.

    Outside local mode the setting must exist: a machine-local folder would be
    lost with its executor and is not readable from the others.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="vectrine-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/vectrine-{uuid.uuid4().hex}"


SPREAD_BYTES = 512 << 20


def spread(df: DataFrame) -> DataFrame:
    """One task per core for a small input that Spark would read as a single split.

    For work that costs far more than moving the rows. Inputs above
    ``SPREAD_BYTES`` (by the optimizer's estimate) come in many splits already
    and are left where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if cores > 1 and size <= SPREAD_BYTES else df
