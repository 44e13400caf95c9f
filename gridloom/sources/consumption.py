"""The consumption source query over landed tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.constants import CONSUMPTION_KINDS, CONSUMPTION_STATE, CONSUMPTION_YEAR

# Columns of the consumption table.
COLUMNS = ("ano", "mes", "sigla_uf", "tipo_consumo", "numero_consumidores", "consumo")


def distinct_directory(directory: DataFrame) -> DataFrame:
    return directory.select("sigla", "nome").distinct()


def consumption_query(
    consumption: DataFrame,
    directory: DataFrame,
    year: int = CONSUMPTION_YEAR,
    state: str = CONSUMPTION_STATE,
    kinds: tuple[str, ...] = CONSUMPTION_KINDS,
) -> DataFrame:
    """Consumption of one year and state, for states listed in the directory.

    The condition on the right key makes the left join keep matches only; the
    optimizer turns it into an inner join and pushes the conditions into both
    scans.
    """
    return (
        consumption.join(
            distinct_directory(directory), F.col("sigla_uf") == F.col("sigla"), "left"
        )
        .where(
            (F.col("ano") == year)
            & (F.col("sigla_uf") == state)
            & (F.col("sigla") == state)
            & F.col("tipo_consumo").isin(*kinds)
        )
        .select(*COLUMNS)
    )
