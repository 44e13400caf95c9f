"""Spellings, thresholds and ranges every result depends on."""

# Sensor kinds as they appear in ``valueType``.
VOLTS = "volts"
AMPERE = "ampére"
AMPERE_TRUSTED = "Ampere"
POWER_FACTOR = "fator"
CELSIUS = "°C"
HERTZ = "Hz"
PERCENT = "Porcentagem"

# Grid zones and operating scenarios.
ZONES = ("NORTE", "SUL", "LESTE", "OESTE", "CENTRO")
NORMAL = "NORMAL"
EXCEPTIONAL = "EXCEPCIONAL"
TERRIBLE = "TERRIVEL"

# Severity limits.
LOW_VOLTAGE_LIMIT = 0
RAIN_LIMIT = 25
WIND_LIMIT = 25
NO_EVENT = "SEM EVENTO"
WIND_EVENT = "VENTO"
RAIN_EVENT = "CHUVA"

# Voltage limits of the violation report.
VIOLATION_MIN = -23000
VIOLATION_MAX = 23000

# Currents: transformer ratio and line impedance.
CURRENT_RATIO = 160
LINE_IMPEDANCE = 40

# Seconds between two points of the reconstructed sine wave.
SINE_STEP = 0.01

# Hour at which each period of the day ends (exclusive), in order.
DAY_PERIODS = (
    (5, "Madrugada"),
    (11, "Manhã"),
    (14, "Meio dia"),
    (16, "Início da tarde"),
    (18, "Fim da tarde"),
    (24, "Noite"),
)

# Consumption source selection.
CONSUMPTION_YEAR = 2023
CONSUMPTION_STATE = "SP"
CONSUMPTION_KINDS = ("Comercial", "Residencial", "Industrial")

# Generation sources, spelled as in the landed file.
GENERATION_SOURCES = ("hydroeletric", "wind", "nuclear", "solar", "thermal")

# Substrings and prefixes that name objects in the zones.
RAW_VOLTAGE = "telemetry_"
RAW_COMPLAINTS = "ReclameAqui_Raw_"
QUARANTINE_COMPLAINTS = "quarantine/complaints"
QUARANTINE_WEATHER = "quarantine/weather"
TRUSTED_VOLTAGE = "Tensao_TRUSTED_"
TRUSTED_WEATHER = "TRUSTED_clima"
TRUSTED_COMPLAINTS = "ReclameAqui_TRUSTED_"
TRUSTED_CONSUMPTION = "trusted_generation"
FACT_VOLTAGE_WEATHER = "tensao_clima/Fato_Tensao_Clima"
FACT_CONSUMPTION = "consumo/Fato_Consumo"
FACT_COMPLAINTS = "reclamacao_cliente/Fato_Reclamacao"

# Names of the sensor tables.
TRUSTED_TEMPERATURE = "trusted_ºC"
TRUSTED_POWER_FACTOR = "trusted_fator"
TRUSTED_CURRENT = "trusted_Ampere"
TRUSTED_FREQUENCY = "trusted_Hz"
TRUSTED_HARMONICS = "trusted_all_sensors"
TRUSTED_GENERATION = "trusted_eletricity-generation"
CLIENT_CURRENT = "client_Ampere"
CLIENT_POWER_FACTOR = "client_correlacoes_fator"
CLIENT_HARMONICS_VOLTAGE = "client_tensao_x_harmonica"
CLIENT_HARMONICS_CURRENT = "client_corrente_x_harmonica"
CLIENT_HARMONICS_POWER = "client_potencia_x_harmonica"
CLIENT_HARMONICS_TIME = "client_harmonicas_x_tempo"
CLIENT_LATEST_HARMONIC = "client_ultimo_valor_harmonica_por_regiao"
CLIENT_LIMITS = "limits_by_zone"
CLIENT_PERIODS = "per_hour"
