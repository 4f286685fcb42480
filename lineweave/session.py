"""Session helpers: a local session for tests/bench and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lineweave") -> SparkSession:
    """Local session used by tests and the bench; on a cluster the caller brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared folder (``spark.checkpoint.dir``).

    The setting is read from the session. Only a local master may do without it (tests, bench):
    driver and executors are one process there, so a temporary folder is shared. On any other
    master a missing setting is an error, because a folder of one machine would lose rows.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or _LOCAL.get(sc.applicationId)
    if not base:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _LOCAL[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="lineweave-shared-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: The temporary folder of each local application.
_LOCAL: dict[str, str] = {}
