"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings, safe to set on a session somebody else built.
#  * UTC: time keys are text made from timestamps.
#  * no partition type inference: '01' must stay '01' in year/month/day/hour.
#  * dynamic overwrite: rewriting one run or batch leaves its neighbours alone.
#  * file packing: many small landing files are read in one task.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.files.openCostInBytes": "1m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "mention_pulse", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
