"""Lineage cuts: tables written to the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Whether Spark deletes the shuffle files of a query when it ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets one of this process; a cluster's
    executors wouldn't see that one, so there it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the whole cluster shares")
        path = f"file://{tempfile.mkdtemp(prefix='tallyfold-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def whole_row(docs: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """The columns of a table as one, in which no name of theirs can meet one of an operator's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without])


class Store:
    """Intermediate tables of one operator call, as Parquet in the shared folder.

    A written table survives the loss of any executor, and cuts the lineage of
    what is read from it.  ``drop`` frees a table that no later frame reads;
    those that the result reads stay until the folder is cleared.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/tallyfold/{name}-{uuid.uuid4().hex[:12]}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Writes a table and gives it back as read from there; the shuffle files behind it go once it is written."""
        path = f"{self.root}/{name}"
        before = self.spark.conf.get(_FREE_SHUFFLES, "false")
        self.spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(_FREE_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def free(self) -> None:
        """Broadcasts of finished jobs, and shuffles of jobs that wrote nothing, are deleted once the driver has collected what refers to them."""
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
