"""Session helper for tests and the benchmark, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "clinlake", cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A local session. On a cluster the caller passes its own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to Python workers that can't import it from where they start.

    An installed package (``pip install``) on all machines makes this needless.
    """
    import shutil

    folder = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="clinlake-"), "clinlake"), "zip", os.path.dirname(folder), os.path.basename(folder))
    spark.sparkContext.addPyFile(archive)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder of the session.

    Every executor must be able to read it. Where the session names none, a
    machine-local folder serves a local master; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="clinlake-")
    return os.path.join(root, "clinlake", f"{name}-{uuid.uuid4().hex}")
