"""Steps that are written once and read more than once."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def held(frame: DataFrame) -> DataFrame:
    """Checkpointed for the steps that read it more than once: its plan is cut, which would grow with every step."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def shared_folder(spark: SparkSession) -> None:
    """Sets the checkpoint folder where none is: the one that spark.checkpoint.dir names, or in local mode a temporary one.

    A cluster without a folder that all its machines share is refused.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="knockwork-"))
