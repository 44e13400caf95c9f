"""Names each query, keeps its oracle SQL next to it and plain-types its result."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.sql import with_views
from checks.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals and floats as double, integers as bigint."""
    targets = {
        T.DateType: "string",
        T.TimestampType: "string",
        T.TimestampNTZType: "string",
        T.DecimalType: "double",
        T.FloatType: "double",
        T.IntegerType: "bigint",
    }
    return df.withColumns(
        {
            field.name: F.col(f"`{field.name}`").cast(targets[type(field.dataType)])
            for field in df.schema.fields
            if type(field.dataType) in targets
        }
    )


def query(name: str, sql: str | None = None, *views: str):
    """Register ``build(tables) -> DataFrame`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(build(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = with_views(sql, *views)
        return build

    return register
