"""Scans, sinks and the incremental refresh: written to scratch and read back."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.job_queries import COMPLAINTS_SQL, LIMITS_SQL, consumption_trusted
from checks.registry import query
from checks.tables import CUTOFF, HIGHEST, LOWEST, Tables
from gridloom import schemas
from gridloom.plans import external, facts, voltage
from gridloom.sources import manifest, scans, sinks
from gridloom.staging import new_folder
from gridloom.streaming import means
from gridloom.streaming.refresh import landed_parquet, read_fact, refresh

# Stands for null in CSV files that also hold empty text.
NULL_TEXT = "\\N"

# Creating a file takes tens of milliseconds, so a landing zone has about this many files, and beyond
# so many records a file their number grows with the rows.
MANY_FILES, FEWEST_RECORDS, MOST_RECORDS, FILES_PER_TASK = 2000, 4, 400, 50

FACT_CONSUMPTION_SQL = """SELECT DISTINCT "TIPO_CONSUMO", "NUMERO_CONSUMIDORES", "CONSUMO",
       CAST("ANO" AS VARCHAR) || '-' || lpad(CAST("MES" AS VARCHAR), 2, '0') AS "ANO_MES_COLETA"
       FROM consumption_trusted"""
EVENTS_SQL = """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props
       FROM events"""
ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"""


@query("latest_file_scan", ORDERS_SQL + " WHERE o_orderstatus = 'O'")
def latest_file_scan(t: Tables):
    """Three runs are published; the newest whose name matches is read."""
    zone = new_folder(t.spark, "zone")
    runs = (("Pedidos_2024", "F"), ("Pedidos_2024", "O"), ("Outros_2024", "P"))
    for hour, (name, status) in enumerate(runs):
        rows = t.orders.where(F.col("o_orderstatus") == status)
        sinks.publish(rows, zone, f"entrada/{name}", datetime(2024, 1, 1, hour))
    path = scans.latest_table(t.spark, zone, "entrada/Pedidos_")
    return t.spark.read.schema(t.orders.schema).parquet(path)


def land_many(rows: DataFrame, path: str) -> None:
    """Write the rows to thousands of JSON files, some dozens by each task."""
    held = rows.count()
    each = min(max(held // MANY_FILES, FEWEST_RECORDS), MOST_RECORDS)
    tasks = max(1, -(-held // (each * FILES_PER_TASK)))
    many = rows.repartition(tasks).write.option("maxRecordsPerFile", each)
    many.option("timestampNTZFormat", scans.TIMESTAMP_FORMAT).json(path)


@query("latest_of_many_files", EVENTS_SQL + " WHERE event_type = 'click'")
def latest_of_many_files(t: Tables):
    """Thousands of files have landed and are noted; the newest by its key is read, without a listing."""
    zone = new_folder(t.spark, "zone")
    land_many(t.events.where("event_type <> 'click'"), f"{zone}/telemetry_old")
    manifest.feed(t.spark, zone)
    sinks.write_json(t.events.where("event_type = 'click'").repartition(1), f"{zone}/telemetry_new")
    sinks.write_json(t.events.limit(1), f"{zone}/other")
    manifest.feed(t.spark, zone)
    path = manifest.latest_file(t.spark, zone, "telemetry_")
    return scans.read_json_lines(t.spark, path, t.events.schema)


@query("scan_json_lines", EVENTS_SQL)
def scan_json_lines(t: Tables):
    path = new_folder(t.spark, "landing")
    sinks.write_json(t.events, path)
    return scans.read_json_lines(t.spark, path, t.events.schema)


@query("scan_json_array", EVENTS_SQL)
def scan_json_array(t: Tables):
    path = new_folder(t.spark, "landing")
    sinks.write_json_array(t.events, path)
    return scans.read_json_documents(t.spark, path, t.events.schema)


@query("scan_json_glob", EVENTS_SQL + " WHERE event_type IN ('click', 'view')")
def scan_json_glob(t: Tables):
    """Two of three landed folders match the pattern."""
    folder = new_folder(t.spark, "landing")
    folders = {"generation_1": ("click",), "generation_2": ("view",), "other": ("error", "purchase", "signup")}
    for name, kinds in folders.items():
        sinks.write_json(t.events.where(F.col("event_type").isin(*kinds)), f"{folder}/{name}")
    return scans.read_json_lines(t.spark, f"{folder}/generation*", t.events.schema)


@query("scan_csv_semicolon", """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value,
       CASE event_id % 4 WHEN 0 THEN props || chr(10) || ';"' || event_type || '", ' || chr(10)
            WHEN 1 THEN '' WHEN 2 THEN NULL ELSE props END AS props FROM events""")
def scan_csv_semicolon(t: Tables):
    """Text with line breaks, separators and quotes, empty text and null."""
    path = new_folder(t.spark, "landing")
    kind = F.col("event_id") % 4
    broken = F.concat("props", F.lit('\n;"'), "event_type", F.lit('", \n'))
    text = F.when(kind == 0, broken).when(kind == 1, "").when(kind == 3, F.col("props"))
    events = t.events.withColumn("props", text)
    sinks.write_csv(events, path, null_text=NULL_TEXT)
    return scans.read_csv(t.spark, path, events.schema, free_text=True, null_text=NULL_TEXT)


@query("scan_json_array_split", EVENTS_SQL)
def scan_json_array_split(t: Tables):
    """One array over many lines, whose parts several tasks can read."""
    path = new_folder(t.spark, "landing")
    sinks.write_json_array(t.events.coalesce(1), path, records_per_line=100)
    return scans.read_json_array(t.spark, path, t.events.schema)


@query("scan_csv_split", """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value,
       CASE event_id % 4 WHEN 0 THEN props || chr(10) || ';"' || event_type || '", ' || chr(10)
            WHEN 1 THEN '' WHEN 2 THEN NULL ELSE props END AS props FROM events
       WHERE event_type <> 'error'""")
def scan_csv_split(t: Tables):
    """Files of two column orders, with broken lines and with rows that do not fit, which are set aside."""
    path, aside = new_folder(t.spark, "landing"), new_folder(t.spark, "aside")
    kind, broken = F.col("event_id") % 4, F.col("event_type") == "error"
    text = F.when(kind == 0, F.concat("props", F.lit('\n;"'), "event_type", F.lit('", \n')))
    text = text.when(kind == 1, "").when(kind == 3, F.col("props"))
    events = t.events.withColumn("props", text)
    number = F.when(broken, "no number").otherwise(F.col("user_id").cast("string"))
    for part, columns in enumerate((events.columns, sorted(events.columns))):
        rows = events.where(F.col("event_id") % 2 == part).withColumn("user_id", number)
        sinks.write_csv(rows.select(*columns), f"{path}/{part}", null_text=NULL_TEXT)
    return scans.read_csv(
        t.spark, f"{path}/*", t.events.schema, free_text=True, null_text=NULL_TEXT, quarantine=aside
    )


@query("voltage_from_files", """SELECT CAST(day AS VARCHAR) AS "DATA_GERACAO",
       minute AS "HORA_MINUTO_GERACAO", month AS "ANO_MES_GERACAO", zone AS "ZONA_GERACAO",
       CAST(moment AS VARCHAR) AS "DATA_HORA_GERACAO", volts AS "TENSAO_VALOR"
       FROM voltage""", "voltage")
def voltage_from_files(t: Tables):
    """Voltage documents land as JSON arrays and are read from there."""
    path = new_folder(t.spark, "landing")
    sinks.write_json_array(t.voltage_raw, path)
    landed = scans.read_json_array(t.spark, path, schemas.VOLTAGE_RAW)
    return voltage.voltage_trusted(landed, CUTOFF)


@query("limits_from_files", LIMITS_SQL, "telemetry", "population")
def limits_from_files(t: Tables):
    """Telemetry lands as JSON lines and the zones' population as CSV."""
    telemetry, people = (new_folder(t.spark, "landing") for _ in range(2))
    sinks.write_json(t.telemetry, telemetry)
    sinks.write_csv(t.population, people, sep=",")
    return voltage.limits_by_zone(
        scans.read_json_lines(t.spark, telemetry, schemas.TELEMETRY),
        scans.read_csv(t.spark, people, schemas.ZONE_POPULATION, sep=","),
        LOWEST,
        HIGHEST,
    )


@query("fact_consumption_csv", FACT_CONSUMPTION_SQL, "consumption_trusted")
def fact_consumption_csv(t: Tables):
    """The fact is stored as CSV without a cap and read back as the next run's history."""
    trusted, zone = consumption_trusted(t), new_folder(t.spark, "zone")
    schema, name = facts.consumption_rows(trusted).schema, "consumo/Fato_Consumo"
    for run, rows in enumerate((trusted.where("MES < 7"), trusted, trusted), 1):
        stored = scans.latest_table(t.spark, zone, name)
        history = scans.read_table_or_empty(t.spark, stored, schema, sep=";")
        fact = facts.fact_consumption(rows, history)
        sinks.publish(fact, zone, name, datetime(2024, 1, run), fmt="csv")
    path = scans.latest_table(t.spark, zone, name)
    return scans.read_csv(t.spark, path, schema)


@query("scan_csv_header", """SELECT CAST(date AS VARCHAR) AS date, hydroeletric, wind, nuclear,
       solar, thermal FROM generation""", "generation")
def scan_csv_header(t: Tables):
    path = new_folder(t.spark, "landing")
    sinks.write_csv(t.generation, path, sep=",")
    return scans.read_csv(t.spark, path, t.generation.schema, sep=",")


@query("sink_json_roundtrip", ORDERS_SQL)
def sink_json_roundtrip(t: Tables):
    path = new_folder(t.spark, "sink")
    sinks.write_json_array(t.orders, path)
    return scans.read_json_documents(t.spark, path, t.orders.schema)


@query("sink_json_first_rows", ORDERS_SQL + """
       ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10000""")
def sink_json_first_rows(t: Tables):
    """The capped form of the sink: the highest rows only."""
    path = new_folder(t.spark, "sink")
    order = [F.desc("o_totalprice"), F.desc("o_orderkey")]
    sinks.write_json(t.orders, path, limit=10_000, order_by=order)
    return scans.read_json_lines(t.spark, path, t.orders.schema)


@query("sink_csv_roundtrip", ORDERS_SQL)
def sink_csv_roundtrip(t: Tables):
    path = new_folder(t.spark, "sink")
    sinks.write_csv(t.orders, path)
    return scans.read_csv(t.spark, path, t.orders.schema)


@query("sink_csv_pipe_roundtrip", ORDERS_SQL)
def sink_csv_pipe_roundtrip(t: Tables):
    path = new_folder(t.spark, "sink")
    sinks.write_csv(t.orders, path, sep="|")
    return scans.read_csv(t.spark, path, t.orders.schema, sep="|")


@query("publish_zone", """SELECT ano, mes, sigla_uf, tipo_consumo, numero_consumidores, consumo
       FROM consumption""", "consumption")
def publish_zone(t: Tables):
    zone = new_folder(t.spark, "zone")
    path = sinks.publish(t.consumption, zone, "consumo/Consumo", partition_by="ano")
    return t.spark.read.schema(t.consumption.schema).parquet(path)


@query("incremental_refresh", "SELECT DISTINCT " + COMPLAINTS_SQL, "complaints_trusted")
def incremental_refresh(t: Tables):
    """Complaints land in two overlapping loads; the second run appends the rest."""
    spark = t.spark
    landing, fact, checkpoint = (
        new_folder(spark, label) for label in ("landing", "fact", "checkpoint")
    )
    schema, month = schemas.STORED_COMPLAINTS, "ANO_MES_RECLAMACAO"
    raw = t.complaints_raw

    def rows(batch):
        return facts.complaints_rows(external.complaints_trusted(batch))

    for load in (raw.where(F.col("Avaliação") < "3"), raw.where(F.col("Avaliação") > "1")):
        load.write.mode("append").parquet(landing)
        landed = landed_parquet(spark, landing, raw.schema)
        refresh(landed, rows, fact, schema, month, checkpoint)
    return read_fact(spark, fact, schema).drop(month)


@query("refresh_with_state", "SELECT DISTINCT " + COMPLAINTS_SQL, "complaints_trusted")
def refresh_with_state(t: Tables):
    """Three loads, the last a replay of the first; repeats end at the stream's state or the fact's filter."""
    spark = t.spark
    landing, fact, checkpoint = (new_folder(spark, label) for label in ("landing", "fact", "checkpoint"))
    schema, month, raw = schemas.STORED_COMPLAINTS, "ANO_MES_RECLAMACAO", t.complaints_raw
    low, high = raw.where(F.col("Avaliação") < "3"), raw.where(F.col("Avaliação") > "1")
    for load in (low, high, low):
        load.write.mode("append").parquet(landing)
        landed = landed_parquet(spark, landing, raw.schema)
        refresh(
            landed,
            lambda batch: facts.complaints_rows(external.complaints_trusted(batch)),
            fact,
            schema,
            month,
            checkpoint,
            remembered="1 day",
        )
    return read_fact(spark, fact, schema).drop(month)


@query("voltage_from_partial_sums", """SELECT CAST(day AS VARCHAR) AS "DATA_GERACAO",
       minute AS "HORA_MINUTO_GERACAO", month AS "ANO_MES_GERACAO", zone AS "ZONA_GERACAO",
       CAST(moment AS VARCHAR) AS "DATA_HORA_GERACAO", volts AS "TENSAO_VALOR"
       FROM voltage""", "voltage")
def voltage_from_partial_sums(t: Tables):
    """Readings of the same minutes land in three loads, out of order; late ones amend the means."""
    path = new_folder(t.spark, "sums")
    for load in (2, 0, 1, 2):
        raw = t.voltage_raw.where(F.pmod(F.xxhash64("valor"), F.lit(3)) == load)
        means.store(voltage.voltage_sums(raw, CUTOFF), path, load)
    return voltage.voltage_from_sums(means.read(t.spark, path, voltage.VOLTAGE_KEYS))
