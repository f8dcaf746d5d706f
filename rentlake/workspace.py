"""Shared scratch space for written tables, checkpoints and staged files."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is used only by a local session that names none.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_root(spark.sparkContext.applicationId)
    raise ValueError(f"set {SETTING} to a folder shared by all executors")


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="rentlake-")


class Workspace:
    """One fresh folder per run, so that two runs never share files or tables."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.run = uuid.uuid4().hex
        self.root = f"{(root or shared_root(spark)).rstrip('/')}/rentlake/{self.run}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> str:
        return f"{name}_{self.run}"
