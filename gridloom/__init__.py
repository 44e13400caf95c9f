"""Grid telemetry analytics as plain ``DataFrame -> DataFrame`` steps on Spark."""
