"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "tidemark") -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local master without that setting gets a fresh folder of its own
    (tests, bench); on a cluster the setting is required.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        found = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TIDEMARK_TMP", "/tmp"))
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique path below the shared folder (one per run)."""
    return "/".join([shared_dir(spark), "tidemark", *parts, uuid.uuid4().hex])
