"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings: safe to set on a session somebody else created.
RUNTIME_CONF = {
    # Date/timestamp casts and point-in-time comparisons are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Hot join keys are split at run time; forced, because a split that costs one
    # more shuffle still beats one task holding a third of the rows.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "tierstone", memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark."""
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.extraJavaOptions", "-Duser.timezone=UTC")
    )
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for written tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. A private temporary folder
    is used only where that is unset *and* driver and executors share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="tierstone-")
