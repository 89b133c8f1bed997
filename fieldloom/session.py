"""Session helpers shared by every operator."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "fieldloom", cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a private one only where none is set and all runs on one machine."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="fieldloom-ckpt-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
        context.setCheckpointDir(root)
        current = context.getCheckpointDir()
    return current


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    For a derived table that several passes read: later passes prune columns and push
    filters into the stored files instead of repeating the shuffle behind them.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/fieldloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
