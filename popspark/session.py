"""SparkSession construction for tests, bench and local runs.

On a cluster the session is built by the platform; library code never
creates one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every session should carry. AQE re-plans joins from measured
# shuffle sizes (the runtime size check behind any broadcast), coalesces
# small post-shuffle partitions and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the runtime size check behind every broadcast (measured shuffle output)
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "popspark",
    extra: dict | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
