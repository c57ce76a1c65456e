"""Session settings the operators expect, and the shared working folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# A setting that stored tables rely on, applied to sessions built elsewhere too. A bucket
# of epochs is one sorted file, and Spark then uses that order instead of sorting again
# (it checks that every bucket is a single file). Times need no setting: operators keep
# and report them in UTC whatever the session's zone is.
TABLE_SETTINGS = {
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "hypnolith",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the library's settings.

    ``master`` and ``shuffle_partitions`` are left to the cluster unless given;
    AQE coalesces small shuffle partitions, so a cluster sets a high count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **TABLE_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_table_settings(spark: SparkSession) -> None:
    """Set what the stored tables rely on in a running session."""
    for key, value in TABLE_SETTINGS.items():
        spark.conf.set(key, value)


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="hypnolith-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def working_folder(spark: SparkSession, purpose: str) -> str:
    """New, unique sub-folder of the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage that outlives an executor and that all of
    them see. A local session may do without: one temporary folder, removed when
    Python ends, stands in. Elsewhere a missing setting is an error, since executors
    would write to disks of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share"
            )
        root = _local_folder()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
