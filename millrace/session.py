"""Session and checkpoint-folder helpers. The library itself never makes a session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "millrace", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster pass your own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster for checkpoints and scratch tables.

    It is what the session says in ``spark.checkpoint.dir`` (or was given with
    ``setCheckpointDir``). Only a local session that names none gets a fresh folder of
    this machine: on a cluster such a folder would be unreachable for other executors.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if current is None:
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="millrace-")
        context.setCheckpointDir(named)
    return named or os.path.dirname(current)


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new path under the shared folder, e.g. for a saved model."""
    return f"{checkpoint_root(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
