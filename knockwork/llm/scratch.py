"""Tables in the shared folder that cut lineage between the steps of an operator."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of whole texts that go to Python at once where the session has Spark's own default.
BATCH, BATCH_ROWS, BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "2000", "10000"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, or else the checkpoint folder that was set.

    Where neither is there, a temporary one in local mode; on a cluster that is refused, as
    executors couldn't read one another's files there.
    """
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="knockwork-"))
    return sc._jsc.sc().getCheckpointDir().get()


def by_bucket(df: DataFrame, buckets: int) -> DataFrame:
    """Dealt by ``bucket``, over a partition for every four buckets at least: where the session has fewer, tasks don't grow with the data."""
    least = -(-buckets // 4)
    return df.repartition(least, "bucket") if least > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


class Scratch:
    """Parquet tables of one run of an operator, below the shared folder.

    ``keep`` writes a frame and reads it again; the shuffle files of that write
    go as soon as it ends, and an executor that is lost later costs no work. What is
    not dropped before goes when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        if spark.conf.get(BATCH) == BATCH_DEFAULT:
            spark.conf.set(BATCH, BATCH_ROWS)
        self.paths: dict[int, str] = {}
        path, fs = self._file_system(self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _file_system(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:02d}-{name}"
        with self._clean_up():
            df.write.option("compression", "zstd").parquet(path)  # its buffers are on the heap, which the collector sees
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    @contextlib.contextmanager
    def _clean_up(self):
        before = self.spark.conf.get(CLEAN_UP, None)
        self.spark.conf.set(CLEAN_UP, "true")
        try:
            yield
        finally:
            if before is None:
                self.spark.conf.unset(CLEAN_UP)
            else:
                self.spark.conf.set(CLEAN_UP, before)

    def drop(self, *frames: DataFrame) -> None:
        """Remove what ``keep`` wrote for frames that are no longer read."""
        for df in frames:
            path, fs = self._file_system(self.paths.pop(id(df)))
            fs.delete(path, True)
