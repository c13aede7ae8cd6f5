"""Session defaults and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "letbook", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library counts on.

    On a cluster the master, memory and partition numbers come from spark-submit; only
    semantics (UTC) and adaptive execution are set here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="letbook-")


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only on a local master (tests, a laptop) may none be configured; it then lies on the local disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/letbook-{label}-{uuid.uuid4().hex}"


def keep(rows: DataFrame, label: str) -> DataFrame:
    """The rows written once to the working folder and read back.

    For a table that several later steps read: it is computed once, and a lost executor
    costs its own tasks only, not the whole lineage.
    """
    folder = work_folder(rows.sparkSession, label)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
