"""A folder that the whole cluster shares, for files that are written and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset, a local session gets one of this machine, and a cluster an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the whole cluster shares")
        root = f"file://{tempfile.mkdtemp(prefix='tallyfold-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/tallyfold/{name}-{uuid.uuid4().hex[:12]}"
