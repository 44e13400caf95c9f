"""Explicit schemas of every landed source and the column lists of every fact."""

from pyspark.sql import types as T

TELEMETRY = T.StructType(
    [
        T.StructField("instant", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("valueType", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("scenery", T.StringType()),
    ]
)

VOLTAGE_RAW = T.StructType(
    [
        T.StructField("valor", T.DoubleType()),
        T.StructField("zona", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

WEATHER_DOCUMENT = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(T.StringType())),
                    T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
                    T.StructField("rain", T.ArrayType(T.DoubleType())),
                    T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
                ]
            ),
        )
    ]
)

COMPLAINTS_RAW = T.StructType(
    [
        T.StructField("Reclamação", T.StringType()),
        T.StructField("Data-hora", T.StringType()),
        T.StructField("Avaliação", T.StringType()),
    ]
)

CONSUMPTION = T.StructType(
    [
        T.StructField("ano", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
        T.StructField("sigla_uf", T.StringType()),
        T.StructField("tipo_consumo", T.StringType()),
        T.StructField("numero_consumidores", T.LongType()),
        T.StructField("consumo", T.DoubleType()),
    ]
)

STATE_DIRECTORY = T.StructType(
    [T.StructField("sigla", T.StringType()), T.StructField("nome", T.StringType())]
)

GENERATION = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("hydroeletric", T.StringType()),
        T.StructField("wind", T.StringType()),
        T.StructField("nuclear", T.StringType()),
        T.StructField("solar", T.StringType()),
        T.StructField("thermal", T.StringType()),
    ]
)

ZONE_POPULATION = T.StructType(
    [T.StructField("zona", T.StringType()), T.StructField("populacao", T.LongType())]
)

VOLTAGE_TRUSTED = T.StructType(
    [
        T.StructField("DATA_GERACAO", T.DateType()),
        T.StructField("HORA_MINUTO_GERACAO", T.StringType()),
        T.StructField("ANO_MES_GERACAO", T.StringType()),
        T.StructField("ZONA_GERACAO", T.StringType()),
        T.StructField("DATA_HORA_GERACAO", T.TimestampNTZType()),
        T.StructField("TENSAO_VALOR", T.DoubleType()),
    ]
)

WEATHER_TRUSTED = T.StructType(
    [
        T.StructField("DATA_HORA_CLIMA", T.TimestampNTZType()),
        T.StructField("CLIMA_TEMPERATURA", T.DoubleType()),
        T.StructField("CLIMA_CHUVA", T.DoubleType()),
        T.StructField("CLIMA_VENTO", T.DoubleType()),
    ]
)

COMPLAINTS_TRUSTED = T.StructType(
    [
        T.StructField("AVALIACAO", T.StringType()),
        T.StructField("DATA_HORA_RECLAMACAO", T.TimestampNTZType()),
        T.StructField("DATA_RECLAMACAO", T.DateType()),
        T.StructField("HORA_RECLAMACAO", T.StringType()),
    ]
)

CONSUMPTION_TRUSTED = T.StructType(
    [
        T.StructField("ANO", T.IntegerType()),
        T.StructField("MES", T.IntegerType()),
        T.StructField("SIGLA_UF", T.StringType()),
        T.StructField("TIPO_CONSUMO", T.StringType()),
        T.StructField("NUMERO_CONSUMIDORES", T.LongType()),
        T.StructField("CONSUMO", T.DoubleType()),
    ]
)

FACT_VOLTAGE_WEATHER = T.StructType(
    [
        T.StructField("DATA_GERACAO", T.DateType()),
        T.StructField("HORA_MINUTO_GERACAO", T.StringType()),
        T.StructField("ANO_MES_GERACAO", T.StringType()),
        T.StructField("ZONA_GERACAO", T.StringType()),
        T.StructField("DATA_HORA_GERACAO", T.TimestampNTZType()),
        T.StructField("TENSAO_VALOR", T.DoubleType()),
        T.StructField("TENSAO_SEVERIDADE", T.BooleanType()),
        T.StructField("CLIMA_TEMPERATURA", T.DoubleType()),
        T.StructField("CLIMA_CHUVA", T.DoubleType()),
        T.StructField("CLIMA_VENTO", T.DoubleType()),
        T.StructField("CLIMA_SEVERIDADE", T.BooleanType()),
        T.StructField("CLIMA_EVENTO", T.StringType()),
        T.StructField("INDICE_APROVACAO", T.StringType()),
    ]
)

FACT_CONSUMPTION = T.StructType(
    [
        T.StructField("TIPO_CONSUMO", T.StringType()),
        T.StructField("NUMERO_CONSUMIDORES", T.LongType()),
        T.StructField("CONSUMO", T.DoubleType()),
        T.StructField("ANO_MES_COLETA", T.StringType()),
    ]
)

FACT_COMPLAINTS = T.StructType(
    [
        T.StructField("DATA_RECLAMACAO", T.DateType()),
        T.StructField("HORA_RECLAMACAO", T.StringType()),
        T.StructField("DATA_HORA_RECLAMACAO", T.TimestampNTZType()),
        T.StructField("AVALIACAO", T.StringType()),
    ]
)

# Stored with the month its files are partitioned by.
STORED_COMPLAINTS = T.StructType(
    [*FACT_COMPLAINTS, T.StructField("ANO_MES_RECLAMACAO", T.StringType())]
)
