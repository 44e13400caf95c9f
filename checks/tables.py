"""The driver's tables dressed as the sources the library expects.

Each view here has an SQL twin in ``checks.sql``.
"""

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom import constants as c

CUTOFF = datetime(2024, 1, 20)
EARLIER_CUTOFF = datetime(2024, 1, 10)
EARLIER_WEATHER = datetime(2024, 1, 8)

CONSUMPTION_YEAR = 1998
CONSUMPTION_STATE = "NATION_1"
CONSUMPTION_KINDS = ("1-URGENT", "2-HIGH", "3-MEDIUM")

LOWEST, HIGHEST = 5.0, 100.0


def pick(names: tuple[str, ...], key: Column) -> Column:
    names = F.array(*(F.lit(name) for name in names))
    return F.get(names, (key % F.size(names)).cast("int"))


def zone() -> Column:
    return pick(c.ZONES, F.col("user_id"))


def scenery() -> Column:
    return pick((c.NORMAL, c.EXCEPTIONAL, c.TERRIBLE), F.col("user_id"))


def ts_text() -> Column:
    return F.col("ts").cast("string")


def instant_text() -> Column:
    return F.replace(ts_text(), F.lit(" "), F.lit("T"))


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")

    @cached_property
    def telemetry(self) -> DataFrame:
        """One reading per event; small values stand for junk and nulls."""
        value, kind = F.col("value"), F.col("event_type")
        return self.events.select(
            "event_id",
            instant_text().alias("instant"),
            F.when(value < 1, F.col("props"))
            .when(value < 2, F.lit(None))
            .otherwise(value.cast("string"))
            .alias("value"),
            F.when(kind == "click", c.VOLTS)
            .when(kind == "view", c.AMPERE)
            .when(kind == "purchase", c.POWER_FACTOR)
            .when(kind == "error", c.PERCENT)
            .otherwise(c.CELSIUS)
            .alias("valueType"),
            zone().alias("zone"),
            scenery().alias("scenery"),
        )

    @cached_property
    def panel(self) -> DataFrame:
        """Every event reports all five kinds at one instant."""
        value, user = F.col("value"), F.col("user_id")

        def readings(kind: str, instant: Column, reading: Column) -> DataFrame:
            return self.events.select(
                "event_id",
                instant.alias("instant"),
                reading.cast("string").alias("value"),
                F.lit(kind).alias("valueType"),
                zone().alias("zone"),
                scenery().alias("scenery"),
            )

        return (
            readings(c.VOLTS, instant_text(), value)
            .union(readings(c.AMPERE, instant_text(), user / 4))
            .union(readings(c.POWER_FACTOR, instant_text(), value / 8))
            .union(readings(c.PERCENT, instant_text(), value / 16))
            .union(readings(c.CELSIUS, F.substring(instant_text(), 1, 19), user / 8))
        )

    @cached_property
    def voltage_raw(self) -> DataFrame:
        """Clicks as voltages read every minute; low values have no zone."""
        return self.events.where(F.col("event_type") == "click").select(
            F.col("value").alias("valor"),
            F.when(F.col("value") >= 1, zone()).alias("zona"),
            F.concat(F.substring(ts_text(), 1, 17), F.lit("00")).alias("timestamp"),
        )

    @cached_property
    def complaints_raw(self) -> DataFrame:
        """Errors as complaints five days later; low values lost their time."""
        later = F.col("ts") + F.expr("INTERVAL 5 DAYS")
        text = F.replace(later.cast("string"), F.lit(" "), F.lit("T"))
        return self.events.where(F.col("event_type") == "error").select(
            F.col("props").alias("Reclamação"),
            F.when(F.col("value") < 1, F.substring(text, 1, 10))
            .otherwise(F.concat(text, F.lit("Z")))
            .alias("Data-hora"),
            (F.col("user_id") % 5).cast("string").alias("Avaliação"),
        )

    @cached_property
    def weather_hours(self) -> DataFrame:
        """Views as hourly weather three days later."""
        later = F.col("ts") + F.expr("INTERVAL 3 DAYS")
        text = F.replace(later.cast("string"), F.lit(" "), F.lit("T"))
        hours = (
            self.events.where(F.col("event_type") == "view")
            .groupBy(F.concat(F.substring(text, 1, 13), F.lit(":00")).alias("time"))
            .agg(
                F.max("user_id").alias("user"),
                F.max("value").alias("high"),
                F.min("value").alias("low"),
            )
        )
        return hours.select(
            "time",
            (F.col("user") / 7).alias("temperature_2m"),
            F.when(F.col("high") >= 20, F.col("high") / 8).alias("rain"),
            F.col("low").alias("wind_speed_10m"),
        )

    @cached_property
    def weather_documents(self) -> DataFrame:
        """One document per day; its arrays hold up to 24 hours."""
        names = ("time", "temperature_2m", "rain", "wind_speed_10m")
        days = self.weather_hours.groupBy(F.substring("time", 1, 10)).agg(
            F.collect_list(F.struct(*names)).alias("h")
        )
        return days.select(
            F.struct(*(F.col(f"h.{name}").alias(name) for name in names)).alias("hourly")
        )

    @cached_property
    def consumption(self) -> DataFrame:
        """Orders per month, nation and priority as energy consumption.

        Orders are first combined per customer, so a customer holding much of
        the table meets the join as a few rows, and distinct customers are then
        counted as rows.
        """
        per_customer = self.orders.groupBy(
            F.year("o_orderdate").alias("ano"),
            F.month("o_orderdate").alias("mes"),
            F.col("o_orderpriority").alias("tipo_consumo"),
            "o_custkey",
        ).agg(F.sum(F.rint(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
        nations = self.customer.join(
            self.nation, F.col("c_nationkey") == F.col("n_nationkey")
        ).select("c_custkey", F.col("n_name").alias("sigla_uf"))
        return (
            per_customer.join(nations, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("ano", "mes", "sigla_uf", "tipo_consumo")
            .agg(
                F.nullif(F.count(F.lit(1)), F.lit(1))
                .cast("double")
                .alias("numero_consumidores"),
                (F.sum("cents") / 100).alias("consumo"),
            )
        )

    @cached_property
    def directory(self) -> DataFrame:
        """States of the customers, so most rows repeat."""
        return self.customer.join(
            self.nation, F.col("c_nationkey") == F.col("n_nationkey")
        ).select(F.col("n_name").alias("sigla"), F.lower("n_name").alias("nome"))

    @cached_property
    def population(self) -> DataFrame:
        """Customers per nation, labelled with a lower-case zone."""
        per_nation = self.customer.groupBy("c_nationkey").agg(
            F.count(F.lit(1)).alias("populacao")
        )
        zone = F.lower(pick(c.ZONES, F.col("c_nationkey")))
        return per_nation.select(zone.alias("zona"), "populacao")

    @cached_property
    def generation(self) -> DataFrame:
        """Quantity shipped per day; line numbers go to the energy sources in turn."""
        sources = len(c.GENERATION_SOURCES)
        turn = (F.col("l_linenumber") - 1) % sources
        return self.lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(
            *(
                (
                    F.sum(F.when(turn == place, F.col("l_quantity"))) / 8
                ).alias(name)
                for place, name in enumerate(c.GENERATION_SOURCES)
            )
        )
