"""Tables written once to the cluster's shared scratch folder.

Used where a later step must see exactly the rows of an earlier one even if
executors are lost in between. The folder is the session's
``spark.checkpoint.dir``; only a local session without that setting gets a
temporary folder of its own.
"""

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="gridloom-")


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return _local_root()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the scratch root."""
    return f"{scratch_root(spark)}/gridloom/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """``df`` computed once, now, and kept by Spark's checkpoint.

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` its files go as soon as
    nothing refers to the result any more.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)
