"""SQL twins of the views in ``checks.tables`` and of the jobs built on them."""

from gridloom import constants as c


def _case(names: tuple[str, ...], key: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE {key} % {len(names)} {whens} END"


ZONE = _case(c.ZONES, "user_id")
SCENERY = _case((c.NORMAL, c.EXCEPTIONAL, c.TERRIBLE), "user_id")
INSTANT = "replace(CAST(ts AS VARCHAR), ' ', 'T')"


def two(value: str) -> str:
    return f"CAST(printf('%.2f', {value}) AS DOUBLE)"


def single(value: str) -> str:
    return f"CAST(TRY_CAST({value} AS FLOAT) AS DOUBLE)"


def half_up(value: str) -> str:
    return f"round(CAST({value} AS DOUBLE), 1)"


def clean(source: str, kind: str) -> str:
    return f"""
        SELECT event_id, instant, {two(single('value'))} AS value,
               "valueType", zone, scenery
        FROM {source}
        WHERE "valueType" = '{kind}' AND TRY_CAST(value AS DOUBLE) IS NOT NULL"""


def _panel(kind: str, instant: str, value: str) -> str:
    return f"""
        SELECT event_id, {instant} AS instant, CAST({value} AS VARCHAR) AS value,
               '{kind}' AS "valueType", {ZONE} AS zone, {SCENERY} AS scenery FROM events"""


def current(source: str) -> str:
    def ranked(kind: str, order: str) -> str:
        return f"""(
            SELECT row_number() OVER (ORDER BY {order}) AS id, *
            FROM (SELECT event_id, instant, TRY_CAST(value AS DOUBLE) AS value,
                         {half_up('TRY_CAST(value AS DOUBLE)')} AS tenth, zone, scenery
                  FROM {source}
                  WHERE "valueType" = '{kind}' AND TRY_CAST(value AS DOUBLE) IS NOT NULL))"""

    arrival = "instant, event_id"
    return f"""
        SELECT id, a.event_id, a.instant, {single('a.value')} AS value, 'Ampere' AS "valueType", a.zone, a.scenery,
               v.tenth AS voltage, f.tenth AS power_factor, t.tenth AS temperature
        FROM {ranked(c.AMPERE, arrival)} a
        JOIN {ranked(c.VOLTS, 'tenth DESC, instant, event_id')} v USING (id)
        JOIN {ranked(c.POWER_FACTOR, arrival)} f USING (id)
        JOIN {ranked(c.CELSIUS, arrival)} t USING (id)"""


def harmonics(source: str) -> str:
    return f"""
        SELECT event_id, instant, value, "valueType", zone, scenery
        FROM (SELECT *, row_number() OVER (ORDER BY instant, event_id) - 1 AS i,
                     count(*) OVER () AS n
              FROM ({clean(source, c.PERCENT)}))
        WHERE scenery = CASE WHEN i <= (n * 2) // 5 THEN 'NORMAL'
                             WHEN i <= (n * 3) // 5 THEN 'EXCEPCIONAL'
                             WHEN i <= (n * 9) // 10 THEN 'TERRIVEL'
                             ELSE 'NORMAL' END"""


def voltage(cutoff: str) -> str:
    return f"""
        SELECT CAST(moment AS DATE) AS day, strftime(moment, '%H:%M') AS minute,
               strftime(moment, '%Y-%m') AS month, zone, moment,
               avg(CAST(round_even(valor, 1) AS DECIMAL(18, 1))) AS volts
        FROM (SELECT valor, zona AS zone, CAST(timestamp AS TIMESTAMP) AS moment FROM voltage_raw)
        WHERE moment <= TIMESTAMP '{cutoff}' AND zone IS NOT NULL
        GROUP BY ALL"""


def fact(voltages: str, weather: str) -> str:
    return f"""
        SELECT v.day, v.minute, v.month, v.zone, v.moment, v.volts, v.volts <= 0 AS low,
               w.temp, w.rain, w.wind,
               coalesce(w.rain >= 25, false) OR coalesce(w.wind >= 25, false) AS severe,
               CASE WHEN w.rain >= 25 THEN 'CHUVA' WHEN w.wind >= 25 THEN 'VENTO'
                    ELSE 'SEM EVENTO' END AS event,
               r.rating
        FROM {voltages} v
        LEFT JOIN complaints r ON v.day = r.day
        LEFT JOIN {weather} w ON date_trunc('hour', v.moment) = date_trunc('hour', w.moment)"""


FACT_COLUMNS = """
    CAST(day AS VARCHAR) AS "DATA_GERACAO", minute AS "HORA_MINUTO_GERACAO",
    month AS "ANO_MES_GERACAO", zone AS "ZONA_GERACAO",
    CAST(moment AS VARCHAR) AS "DATA_HORA_GERACAO", volts AS "TENSAO_VALOR",
    low AS "TENSAO_SEVERIDADE", temp AS "CLIMA_TEMPERATURA", rain AS "CLIMA_CHUVA",
    wind AS "CLIMA_VENTO", severe AS "CLIMA_SEVERIDADE", event AS "CLIMA_EVENTO",
    rating AS "INDICE_APROVACAO" """

VIEWS = {
    "telemetry": f"""
        SELECT event_id, {INSTANT} AS instant,
               CASE WHEN value < 1 THEN props WHEN value < 2 THEN NULL
                    ELSE CAST(value AS VARCHAR) END AS value,
               CASE event_type WHEN 'click' THEN 'volts' WHEN 'view' THEN 'ampére'
                    WHEN 'purchase' THEN 'fator' WHEN 'error' THEN 'Porcentagem'
                    ELSE '°C' END AS "valueType",
               {ZONE} AS zone, {SCENERY} AS scenery
        FROM events""",
    "panel": " UNION ALL ".join(
        [
            _panel(c.VOLTS, INSTANT, "value"),
            _panel(c.AMPERE, INSTANT, "user_id / 4"),
            _panel(c.POWER_FACTOR, INSTANT, "value / 8"),
            _panel(c.PERCENT, INSTANT, "value / 16"),
            _panel(c.CELSIUS, f"substr({INSTANT}, 1, 19)", "user_id / 8"),
        ]
    ),
    "voltage_raw": f"""
        SELECT value AS valor, CASE WHEN value >= 1 THEN {ZONE} END AS zona,
               substr(CAST(ts AS VARCHAR), 1, 17) || '00' AS timestamp
        FROM events WHERE event_type = 'click'""",
    "complaints_raw": """
        SELECT CASE WHEN value < 1 THEN substr(moment, 1, 10) ELSE moment || 'Z' END AS instant,
               CAST(user_id % 5 AS VARCHAR) AS rating, props
        FROM (SELECT *, replace(CAST(ts + INTERVAL 5 DAY AS VARCHAR), ' ', 'T') AS moment
              FROM events WHERE event_type = 'error')""",
    "complaints_trusted": """
        SELECT rating, CAST(substr(instant, 1, 10) AS DATE) AS day,
               nullif(substr(instant, 12, 8), '') AS time,
               CASE WHEN length(instant) > 10 THEN
                   CAST(substr(instant, 1, 10) || ' ' || substr(instant, 12, 8) AS TIMESTAMP)
               END AS moment
        FROM complaints_raw""",
    "complaints": "SELECT DISTINCT day, rating FROM complaints_trusted",
    "weather_hours": """
        SELECT time, user / 7 AS temperature_2m,
               CASE WHEN high >= 20 THEN high / 8 END AS rain, low AS wind_speed_10m
        FROM (SELECT strftime(ts + INTERVAL 3 DAY, '%Y-%m-%dT%H:00') AS time,
                     max(user_id) AS user, max(value) AS high, min(value) AS low
              FROM events WHERE event_type = 'view' GROUP BY 1)""",
    "weather": f"""
        SELECT CAST(time AS TIMESTAMP) AS moment, {two(single('temperature_2m'))} AS temp,
               {two(single('rain'))} AS rain,
               {two(single('wind_speed_10m'))} AS wind
        FROM weather_hours WHERE rain IS NOT NULL""",
    "early_weather": "SELECT * FROM weather WHERE moment < TIMESTAMP '2024-01-08'",
    "voltage": voltage("2024-01-20"),
    "early_voltage": voltage("2024-01-10"),
    "consumption": """
        SELECT year(o_orderdate) AS ano, month(o_orderdate) AS mes, n_name AS sigla_uf,
               o_orderpriority AS tipo_consumo,
               CAST(nullif(count(DISTINCT o_custkey), 1) AS DOUBLE) AS numero_consumidores,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS consumo
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
    "directory": """
        SELECT n_name AS sigla, lower(n_name) AS nome
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "queried": """
        SELECT ano, mes, sigla_uf, tipo_consumo, numero_consumidores, consumo
        FROM consumption
        LEFT JOIN (SELECT DISTINCT sigla, nome FROM directory) d ON sigla_uf = d.sigla
        WHERE ano = 1998 AND sigla_uf = 'NATION_1' AND d.sigla = 'NATION_1'
          AND tipo_consumo IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "consumption_trusted": """
        SELECT ano AS "ANO", mes AS "MES", upper(sigla_uf) AS "SIGLA_UF",
               upper(tipo_consumo) AS "TIPO_CONSUMO",
               coalesce(numero_consumidores, 0) AS "NUMERO_CONSUMIDORES",
               coalesce(consumo, 0) AS "CONSUMO"
        FROM queried""",
    "population": f"""
        SELECT lower({_case(c.ZONES, 'c_nationkey')}) AS zona, count(*) AS populacao
        FROM customer GROUP BY c_nationkey""",
    "generation": "SELECT CAST(l_shipdate AS DATE) AS date, "
    + ", ".join(
        f"sum(l_quantity) FILTER ((l_linenumber - 1) % 5 = {place}) / 8 AS {name}"
        for place, name in enumerate(c.GENERATION_SOURCES)
    )
    + " FROM lineitem GROUP BY 1",
    "current": current("telemetry"),
    "panel_current": current("panel"),
    "harmonics": harmonics("telemetry"),
    "panel_harmonics": harmonics("panel"),
}

USES = {
    "complaints_trusted": ("complaints_raw",),
    "complaints": ("complaints_trusted",),
    "weather": ("weather_hours",),
    "early_weather": ("weather",),
    "voltage": ("voltage_raw",),
    "early_voltage": ("voltage_raw",),
    "queried": ("consumption", "directory"),
    "consumption_trusted": ("queried",),
    "current": ("telemetry",),
    "panel_current": ("panel",),
    "harmonics": ("telemetry",),
    "panel_harmonics": ("panel",),
}


def with_views(sql: str, *views: str) -> str:
    """The statement preceded by the views it reads and what those read."""
    ordered: list[str] = []

    def add(view: str) -> None:
        for used in USES.get(view, ()):
            add(used)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        add(view)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in ordered) + "\n" + sql
