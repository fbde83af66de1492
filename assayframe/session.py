"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. A cluster may set more; these never depend on data size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


SHUFFLE_BYTES = 256 * 1024 * 1024  # what one shuffle partition should hold
SCAN_BYTES = 256 * 1024 * 1024


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Session settings for an input of a given size on a given number of cores.

    Shuffles start with enough partitions for all of the input; adaptive execution merges
    what turns out small. Scans get at least three tasks per core.
    """
    partitions = max(3 * cores, -(-input_bytes // SHUFFLE_BYTES))
    scan = min(SCAN_BYTES, max(1 << 22, input_bytes // (3 * cores)))
    return SETTINGS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan),
    }


def local_session(cpus: int | str = 8, app: str = "assayframe") -> SparkSession:
    """Session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in spark.checkpoint.dir. Only a local
    session, where all tasks share one disk, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="assayframe-")
    return f"{named.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
