"""Joins and the composed jobs."""

from pyspark.sql import functions as F

from checks import sql
from checks.registry import query
from checks.tables import (
    CONSUMPTION_KINDS,
    CONSUMPTION_STATE,
    CONSUMPTION_YEAR,
    CUTOFF,
    EARLIER_CUTOFF,
    EARLIER_WEATHER,
    HIGHEST,
    LOWEST,
    Tables,
)
from gridloom import constants as c
from gridloom.functions.dates import wall_clock
from gridloom.operators import joins
from gridloom.operators.columns import replace_value
from gridloom.plans import external, facts, harmonics, sensors, voltage
from gridloom.sources.consumption import consumption_query
from gridloom.sources.weather import fitting, hourly_rows
from gridloom.staging import new_folder

TIE = ["event_id"]


def _voltage(t: Tables, cutoff=CUTOFF):
    return voltage.voltage_trusted(t.voltage_raw, cutoff)


def _weather(t: Tables):
    return external.weather_trusted(t.weather_documents)


def _complaints(t: Tables):
    return external.complaints_trusted(t.complaints_raw)


def _queried(t: Tables):
    return consumption_query(
        t.consumption, t.directory, CONSUMPTION_YEAR, CONSUMPTION_STATE, CONSUMPTION_KINDS
    )


@query("hourly_arrays_to_rows",
       "SELECT time, temperature_2m, rain, wind_speed_10m FROM weather_hours", "weather_hours")
def hourly_arrays_to_rows(t: Tables):
    return hourly_rows(t.weather_documents)


@query("consumption_source_query", "SELECT * FROM queried", "queried")
def consumption_source_query(t: Tables):
    return _queried(t)


@query("voltage_trusted", """SELECT CAST(day AS VARCHAR) AS "DATA_GERACAO",
       minute AS "HORA_MINUTO_GERACAO", month AS "ANO_MES_GERACAO", zone AS "ZONA_GERACAO",
       CAST(moment AS VARCHAR) AS "DATA_HORA_GERACAO", volts AS "TENSAO_VALOR"
       FROM voltage""", "voltage")
def voltage_trusted(t: Tables):
    return _voltage(t)


@query("weather_trusted", """SELECT CAST(moment AS VARCHAR) AS "DATA_HORA_CLIMA",
       temp AS "CLIMA_TEMPERATURA", rain AS "CLIMA_CHUVA", wind AS "CLIMA_VENTO"
       FROM weather""", "weather")
def weather_trusted(t: Tables):
    return _weather(t)


@query("weather_set_aside", """SELECT CAST(moment AS VARCHAR) AS "DATA_HORA_CLIMA",
       temp AS "CLIMA_TEMPERATURA", rain AS "CLIMA_CHUVA", wind AS "CLIMA_VENTO"
       FROM weather WHERE day(moment) % 3 > 0""", "weather")
def weather_set_aside(t: Tables):
    """Documents of every third day lack a measurement; they are stored apart and the others go on."""
    third = F.substring(F.col("hourly.time")[0], 9, 2).cast("int") % 3 == 0
    rain = F.when(third, F.slice("hourly.rain", 2, 100)).otherwise(F.col("hourly.rain"))
    landed = t.weather_documents.select(F.col("hourly").withField("rain", rain).alias("hourly"))
    good, _ = fitting(landed, new_folder(t.spark, "aside"), "weather")
    return external.weather_trusted(good)


COMPLAINTS_SQL = """rating AS "AVALIACAO", CAST(moment AS VARCHAR) AS "DATA_HORA_RECLAMACAO",
       CAST(day AS VARCHAR) AS "DATA_RECLAMACAO", time AS "HORA_RECLAMACAO"
       FROM complaints_trusted"""


@query("complaints_trusted", "SELECT " + COMPLAINTS_SQL, "complaints_trusted")
def complaints_trusted(t: Tables):
    return _complaints(t)


@query("left_join_daily_rating", """SELECT DISTINCT CAST(v.day AS VARCHAR) AS "DATA_GERACAO",
       zone AS "ZONA_GERACAO", CAST(v.moment AS VARCHAR) AS "DATA_HORA_GERACAO",
       volts AS "TENSAO_VALOR", volts <= 0 AS "TENSAO_SEVERIDADE",
       rating AS "INDICE_APROVACAO"
       FROM voltage v LEFT JOIN complaints_trusted r ON v.day = r.day""",
       "voltage", "complaints_trusted")
def left_join_daily_rating(t: Tables):
    rated = joins.with_daily_rating(_voltage(t), joins.daily_ratings(_complaints(t)))
    return rated.drop("HORA_MINUTO_GERACAO", "ANO_MES_GERACAO")


@query("left_join_hourly_weather", """SELECT CAST(v.moment AS VARCHAR) AS "DATA_HORA_GERACAO",
       zone AS "ZONA_GERACAO", volts AS "TENSAO_VALOR", temp AS "CLIMA_TEMPERATURA",
       rain AS "CLIMA_CHUVA", wind AS "CLIMA_VENTO",
       coalesce(rain >= 25, false) OR coalesce(wind >= 25, false) AS "CLIMA_SEVERIDADE",
       CASE WHEN rain >= 25 THEN 'CHUVA' WHEN wind >= 25 THEN 'VENTO'
            ELSE 'SEM EVENTO' END AS "CLIMA_EVENTO"
       FROM voltage v LEFT JOIN weather w
       ON strftime(v.moment, '%Y-%m-%d %H') = strftime(w.moment, '%Y-%m-%d %H')""",
       "voltage", "weather")
def left_join_hourly_weather(t: Tables):
    joined = joins.with_hourly_weather(_voltage(t), joins.hourly_weather(_weather(t)))
    return joined.drop("DATA_GERACAO", "HORA_MINUTO_GERACAO", "ANO_MES_GERACAO")


@query("fact_voltage_weather", f"""SELECT {sql.FACT_COLUMNS} FROM (
       {sql.fact('early_voltage', 'early_weather')} UNION {sql.fact('voltage', 'weather')})""",
       "voltage", "early_voltage", "weather", "early_weather", "complaints")
def fact_voltage_weather(t: Tables):
    """The history was written before the later weather had landed."""
    known = F.col("DATA_HORA_CLIMA") < wall_clock(EARLIER_WEATHER)
    weather, complaints = _weather(t), _complaints(t)
    history = facts.fact_voltage_weather(
        _voltage(t, EARLIER_CUTOFF), weather.where(known), complaints
    )
    return facts.fact_voltage_weather(_voltage(t), weather, complaints, history)


@query("consumption_trusted", "SELECT * FROM consumption_trusted", "consumption_trusted")
def consumption_trusted(t: Tables):
    return external.consumption_trusted(_queried(t))


_MONTH = """CAST("ANO" AS VARCHAR) || '-' || lpad(CAST("MES" AS VARCHAR), 2, '0')
       AS "ANO_MES_COLETA" FROM consumption_trusted"""


@query("fact_consumption", f"""SELECT "TIPO_CONSUMO", "NUMERO_CONSUMIDORES", "CONSUMO", {_MONTH}
       UNION SELECT "TIPO_CONSUMO",
       "NUMERO_CONSUMIDORES" + CASE WHEN "MES" < 4 THEN 1 ELSE 0 END, "CONSUMO", {_MONTH}
       WHERE "MES" < 7""", "consumption_trusted")
def fact_consumption(t: Tables):
    """The history ends in June; its figures up to March were revised since."""
    trusted = external.consumption_trusted(_queried(t))
    month = F.substring("ANO_MES_COLETA", 6, 2)
    revision = F.when(month < "04", 1).otherwise(0)
    history = (
        facts.consumption_rows(trusted)
        .where(month < "07")
        .withColumn("NUMERO_CONSUMIDORES", F.col("NUMERO_CONSUMIDORES") + revision)
    )
    return facts.fact_consumption(trusted, history)


@query("fact_complaints", "SELECT DISTINCT " + COMPLAINTS_SQL, "complaints_trusted")
def fact_complaints(t: Tables):
    trusted = _complaints(t)
    history = trusted.where(F.col("DATA_RECLAMACAO") < F.lit("2024-01-20").cast("date"))
    return facts.fact_complaints(trusted, history)


@query("temperature_trusted", sql.clean("telemetry", c.CELSIUS), "telemetry")
def temperature_trusted(t: Tables):
    return sensors.temperature_trusted(t.telemetry, TIE)


@query("power_factor_trusted", sql.clean("telemetry", c.POWER_FACTOR), "telemetry")
def power_factor_trusted(t: Tables):
    return sensors.power_factor_trusted(t.telemetry, TIE)


@query("positional_align", "SELECT * FROM current", "current")
def positional_align(t: Tables):
    return sensors.current_trusted(t.telemetry, TIE)


@query("current_client", """SELECT id, event_id, instant, scenery,
       round(value, 1) AS secundary_current, voltage, power_factor, temperature,
       CAST(trunc(CAST(round(value, 1) AS FLOAT) * CAST(160 AS FLOAT)) AS BIGINT)
           AS primary_current,
       CAST(trunc(CAST(CAST(voltage AS FLOAT) AS DOUBLE) / 40) AS BIGINT)
           AS short_circuit_current
       FROM current""", "current")
def current_client(t: Tables):
    return sensors.current_client(sensors.current_trusted(t.telemetry, TIE))


def _frequency(frequency: str) -> str:
    def ranked(kind: str) -> str:
        return f"""(SELECT *, TRY_CAST(value AS DOUBLE) AS x,
                    row_number() OVER (ORDER BY instant, event_id) - 1 AS i FROM telemetry
                    WHERE "valueType" = '{kind}' AND TRY_CAST(value AS DOUBLE) IS NOT NULL)"""

    return f"""SELECT f.event_id, f.instant, {sql.two(sql.single('f.x'))} AS value, 'Hz' AS "valueType",
        f.zone, f.scenery,
        round(v.x * sin(2 * pi() * f.x * (i * CAST(0.01 AS DOUBLE))), 6) + 0.0 AS tensao_senoidal
        FROM {ranked(frequency)} f LEFT JOIN {ranked(c.VOLTS)} v USING (i)"""


@query("frequency_trusted", _frequency(c.CELSIUS), "telemetry")
def frequency_trusted(t: Tables):
    telemetry = replace_value(t.telemetry, "valueType", c.CELSIUS, c.HERTZ)
    wave = sensors.frequency_trusted(telemetry, TIE)
    return wave.withColumn("tensao_senoidal", F.round("tensao_senoidal", 6))


_SECOND = "split_part(instant, '.', 1)"


@query("three_way_instant_join", f"""SELECT f.instant, value_fator, "valueType_fator",
       value_temperatura, "valueType_temperatura", value_corrente, "valueType_corrente"
       FROM (SELECT {_SECOND} AS instant, value AS value_fator, "valueType" AS "valueType_fator"
             FROM ({sql.clean('panel', c.POWER_FACTOR)})) f
       JOIN (SELECT {_SECOND} AS instant, value AS value_temperatura,
             "valueType" AS "valueType_temperatura"
             FROM ({sql.clean('panel', c.CELSIUS)})) USING (instant)
       JOIN (SELECT {_SECOND} AS instant, value AS value_corrente,
             "valueType" AS "valueType_corrente"
             FROM ({sql.clean('panel', c.AMPERE)})) USING (instant)""", "panel")
def three_way_instant_join(t: Tables):
    return sensors.power_factor_client(
        *(
            sensors.clean_sensor(t.panel, kind)
            for kind in (c.POWER_FACTOR, c.CELSIUS, c.AMPERE)
        )
    )


@query("power_factor_client", f"""SELECT f.instant, value_fator, "valueType_fator",
       value_temperatura, "valueType_temperatura", value_corrente, "valueType_corrente"
       FROM (SELECT {_SECOND} AS instant, value AS value_fator, "valueType" AS "valueType_fator"
             FROM ({sql.clean('panel', c.POWER_FACTOR)})) f
       JOIN (SELECT {_SECOND} AS instant, value AS value_temperatura,
             "valueType" AS "valueType_temperatura"
             FROM ({sql.clean('panel', c.CELSIUS)})) USING (instant)
       JOIN (SELECT {_SECOND} AS instant, value AS value_corrente,
             "valueType" AS "valueType_corrente" FROM panel_current) USING (instant)""",
       "panel", "panel_current")
def power_factor_client(t: Tables):
    return sensors.power_factor_client(
        sensors.power_factor_trusted(t.panel, TIE),
        sensors.temperature_trusted(t.panel, TIE),
        sensors.current_trusted(t.panel, TIE),
    )


@query("harmonics_trusted", "SELECT * FROM panel_harmonics", "panel_harmonics")
def harmonics_trusted(t: Tables):
    return harmonics.harmonics_trusted(t.panel, TIE)


def _versus(kind: str, label: str) -> str:
    return f"""SELECT h.instant, h.scenery, h.value AS value_harmonicas,
        h."valueType" AS "valueType_harmonicas", s.value AS value_{label},
        s."valueType" AS "valueType_{label}"
        FROM panel_harmonics h JOIN ({sql.clean('panel', kind)}) s
        ON h.instant = s.instant AND h.scenery = s.scenery"""


@query("harmonics_vs_voltage", _versus(c.VOLTS, "tensao"), "panel_harmonics")
def harmonics_vs_voltage(t: Tables):
    return harmonics.harmonics_vs_voltage(
        harmonics.harmonics_trusted(t.panel, TIE), t.panel
    )


@query("harmonics_vs_current", _versus(c.AMPERE, "corrente"), "panel_harmonics")
def harmonics_vs_current(t: Tables):
    return harmonics.harmonics_vs_current(
        harmonics.harmonics_trusted(t.panel, TIE), t.panel
    )


@query("harmonics_vs_power", _versus(c.POWER_FACTOR, "potencia"), "panel_harmonics")
def harmonics_vs_power(t: Tables):
    return harmonics.harmonics_vs_power(
        harmonics.harmonics_trusted(t.panel, TIE), t.panel
    )


@query("harmonics_over_time", """SELECT instant, value AS value_harmonicas,
       "valueType" AS "valueType_harmonicas" FROM harmonics""", "harmonics")
def harmonics_over_time(t: Tables):
    return harmonics.harmonics_over_time(harmonics.harmonics_trusted(t.telemetry, TIE))


@query("generation_trusted", "SELECT CAST(date AS VARCHAR) AS date, "
       + ", ".join(f"{sql.two(sql.single(name))} AS {name}" for name in c.GENERATION_SOURCES)
       + " FROM generation WHERE "
       + " AND ".join(f"{name} IS NOT NULL" for name in c.GENERATION_SOURCES), "generation")
def generation_trusted(t: Tables):
    return external.generation_trusted(t.generation)


LIMITS_SQL = """SELECT zone, "BaixaTensao", "AltaTensao", "PopulacaoTotal"
       FROM (SELECT zone, count(*) FILTER (TRY_CAST(value AS DOUBLE) < 5) AS "BaixaTensao",
                    count(*) FILTER (TRY_CAST(value AS DOUBLE) > 100) AS "AltaTensao"
             FROM telemetry WHERE "valueType" = 'volts' AND scenery = 'NORMAL' GROUP BY zone)
       JOIN (SELECT upper(zona) AS zone, CAST(sum(populacao) AS BIGINT) AS "PopulacaoTotal"
             FROM population GROUP BY 1) USING (zone)"""


@query("limits_by_zone", LIMITS_SQL, "telemetry", "population")
def limits_by_zone(t: Tables):
    return voltage.limits_by_zone(t.telemetry, t.population, LOWEST, HIGHEST)


@query("overvoltage_by_day_period", """SELECT CASE WHEN h < 5 THEN 'Madrugada'
       WHEN h < 11 THEN 'Manhã' WHEN h < 14 THEN 'Meio dia' WHEN h < 16 THEN 'Início da tarde'
       WHEN h < 18 THEN 'Fim da tarde' ELSE 'Noite' END AS "day-period", count(*) AS value
       FROM (SELECT hour(CAST(instant AS TIMESTAMP)) AS h FROM telemetry
             WHERE "valueType" = 'volts' AND scenery = 'NORMAL'
             AND TRY_CAST(value AS DOUBLE) > 100) GROUP BY 1""", "telemetry")
def overvoltage_by_day_period(t: Tables):
    return voltage.overvoltage_by_day_period(t.telemetry, HIGHEST)
