"""Session for local work, and the shared folder for tables that cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "lodeworks", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session you are given."""
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", f"--driver-memory {memory} pyspark-shell")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tasks(df: DataFrame) -> int:
    """Number of tasks for work whose time its bytes do not show, such as Python's: a given number is not merged by size."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


@cache
def own_folder() -> str:
    """A folder of this process, for local masters only."""
    return tempfile.mkdtemp(prefix="lodeworks-")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` and changes no setting. Only a local master may fall back to a folder of its
    own: executors on other machines would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = own_folder()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
