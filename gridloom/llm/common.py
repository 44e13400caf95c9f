"""What the operators share: checkpoints, row identity, keeping chosen rows.

Every operator reads only the columns it needs, under names of its own, so
extra columns of the input can neither clash nor travel through a shuffle. Where whole rows
are kept, they travel as one column.
"""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: ASCII white space, as the contracts of the operators name it.
BLANKS = " \t\n\x0b\x0c\r"


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is ``spark.checkpoint.dir``. Only a session on one machine that does not
    set it gets a folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        root = spark.conf.get(CHECKPOINT_DIR, None)
        if root is None:
            master = context.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
            root = tempfile.mkdtemp(prefix="gridloom-llm-")
        context.setCheckpointDir(root)
        current = context.getCheckpointDir()
    return current.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, with its lineage cut."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(field.dataType) for field in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


ROW_KEY = ["__row_id", "__row_hash"]


def row_key(docs: DataFrame) -> list[Column]:
    """Columns that tell rows apart: the id and a hash of the other columns.

    Rows that agree in both are taken as repeats of one row.
    """
    rest = [F.col(f"`{f.name}`") for f in docs.schema.fields if _hashable(f.dataType)]
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias(ROW_KEY[0]),
        F.xxhash64(*rest).alias(ROW_KEY[1]),
    ]


def named_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as one column ``row`` beside their key, so that no name of theirs can clash."""
    return docs.select(F.struct("*").alias("row"), *row_key(docs))


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``keys``, each once however often it repeats."""
    chosen = named_rows(docs).join(keys.select(*ROW_KEY), ROW_KEY, "left_semi")
    repeat = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(ROW_KEY[1]))
    return chosen.withColumn("repeat", repeat).where("repeat = 1").select("row.*")
