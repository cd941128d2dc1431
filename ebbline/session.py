"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings the operators rely on; a cluster session normally has them already.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the bench; production code receives its session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ebbline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ebbline-")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder the session names in ``spark.checkpoint.dir``.

    Every executor must see it, so without that setting only a session that runs in one process
    (tests) gets a folder of this machine; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
