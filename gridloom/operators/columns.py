"""Projections, renames and schema-driven column edits."""

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def add_constant(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def project(df: DataFrame, *names: str) -> DataFrame:
    """Keep the named columns, in that order."""
    return df.select(*names)


def project_as(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Keep the columns named by the keys, under the names given as values."""
    return df.select(*(F.col(old).alias(new) for old, new in aliases.items()))


def replace_value(df: DataFrame, name: str, old: Any, new: Any) -> DataFrame:
    """Swap one value; every other value, and null, passes."""
    column = F.col(name)
    return df.withColumn(name, F.when(column == old, F.lit(new)).otherwise(column))


def uppercase_strings(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            field.name: F.upper(field.name)
            for field in df.schema.fields
            if isinstance(field.dataType, T.StringType)
        }
    )


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by name; a value that does not fit becomes null."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})


def fill_null_numbers(df: DataFrame) -> DataFrame:
    """Null and NaN become 0 in every numeric column."""
    return df.fillna(0)
