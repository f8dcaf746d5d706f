"""Session settings the jobs expect, for tests, the bench and notebooks."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks broadcast sides from measured sizes, merges small
# shuffle partitions and splits skewed ones; every job here counts on it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, app: str = "rentlake", **extra: str) -> SparkSession:
    """A local session with the settings above; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
