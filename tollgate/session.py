"""Spark session defaults for gate jobs.

On a cluster the session is created by the platform; ``tune`` only fills in
settings that are still unset, so cluster-level choices always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every gate job relies on. AQE re-plans joins/aggregations from
# runtime sizes (broadcast only when the measured side is small, skew splits,
# partition coalescing); UTC keeps timestamp arithmetic identical everywhere.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tollgate",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply DEFAULT_CONF keys that the session has not set yet."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    # Spark reads timestamps in the session zone; the gate's arithmetic is UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we only pick our own (e.g. in
    tests on local mode) when the setting is absent.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if fallback is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder")
        fallback = tempfile.mkdtemp(prefix="tollgate-ckpt-")
    os.makedirs(fallback, exist_ok=True) if "://" not in fallback else None
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have Hadoop remove ``path`` when the session's JVM ends, whoever still reads it until then."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    fs.deleteOnExit(p)


def cut_lineage(df, spark: SparkSession | None = None):
    """Cut lineage with a table written under the shared checkpoint folder.

    One path at every size: a Parquet write computes the plan exactly once,
    every consumer reads the written result, and the re-read frame survives
    executor loss without recomputation. Never a local checkpoint. The tables
    of a run are removed by ``release_tables`` once its results are stored, and
    what is left when the session's JVM ends goes then.
    """
    spark = spark or df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tollgate-tables/{uuid.uuid4().hex}"
    remove_at_end(spark, path)
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def release_tables(*frames) -> None:
    """Remove the tables behind frames that ``cut_lineage`` returned; others are left alone."""
    for f in frames:
        path = f.__dict__.get("_written_path")
        if path:
            p = f.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(f.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
