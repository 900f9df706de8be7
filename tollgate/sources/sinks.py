"""Sinks: JSON reports per bundle, expectation result store, defect log.

All writes are Spark writes (distributed, partitioned by bundle / suite /
run); nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_NAMES = ("validation_summary", "defect_summary", "release_decision")


def write_json_report(df: DataFrame, path: str, partition_by: Sequence[str] = ("bundle",),
                      generated_at: str | None = None, mode: str = "overwrite") -> None:
    """One JSON document per run; null fields are omitted by the JSON writer."""
    out = df
    if generated_at is not None:
        out = out.withColumn("generated_at", F.lit(generated_at))
    parts = [p for p in partition_by if p in out.columns]
    w = out.write.mode(mode).option("ignoreNullFields", True)
    if parts:
        w = w.partitionBy(*parts)
    w.json(path)


def write_reports(reports: dict[str, DataFrame], directory: str,
                  partition_by: Sequence[str] = ("bundle",), generated_at: str | None = None) -> str:
    """Write each named report frame under ``directory/<name>``.

    Summaries carry ``generated_at``; the release decision names it
    ``timestamp``.
    """
    base = directory.rstrip("/")
    for name, df in reports.items():
        if generated_at is not None and name == "release_decision":
            df = df.withColumn("timestamp", F.lit(generated_at))
            write_json_report(df, f"{base}/{name}", partition_by, None)
        else:
            write_json_report(df, f"{base}/{name}", partition_by, generated_at)
    return base


def store_results(results: DataFrame, path: str, run_name: str | None = None,
                  partition_by: Sequence[str] = ("suite", "run_name")) -> None:
    """Store expectation results, partitioned by suite and run.

    A run's partitions are replaced, so a retried job stores each result once.
    """
    out = results if run_name is None else results.withColumn("run_name", F.lit(run_name))
    out = out.withColumn("stored_at", F.current_timestamp())
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*[p for p in partition_by if p in out.columns]).parquet(path))


def write_csv_bundles(df: DataFrame, root: str, bundle: str, feed: str) -> str:
    """Write a frame as ``<root>/<bundle>/<feed>.csv``; returns the root.

    A bundle's file is written by one task, so the bundle key should follow the
    size of the data (see the callers). Bundle values must not be null; every
    value is quoted, with quotes doubled.
    """
    spark = df.sparkSession
    parts = f"{root}/_parts/{feed}"
    (df.repartition(bundle).write.partitionBy(bundle).option("header", True).option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(parts))
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    for st in fs.globStatus(path(f"{parts}/{bundle}=*/part-*.csv")):
        name = st.getPath().getParent().getName().split("=", 1)[1]
        if name == "__HIVE_DEFAULT_PARTITION__":
            raise ValueError(f"rows of {feed} have no {bundle}")
        target = path(f"{root}/{name}/{feed}.csv")
        fs.mkdirs(target.getParent())
        if not fs.rename(st.getPath(), target):
            raise OSError(f"cannot move {st.getPath()} to {target}: a bundle has one file of a feed")
    fs.delete(path(parts), True)
    return root


DEFECT_LOG_KEYS = ("bundle", "run_ts", "rule_id")


def append_defect_log(outcomes: DataFrame, path: str, run_ts: str, file_col: str | None = None) -> DataFrame:
    """Log failing rules (timestamp, rule, severity, file, description, status) of a run.

    Rows go to the run's own partitions (``run_ts``, ``bundle``), which a
    retried job replaces; entries of other runs and bundles stay. Returns the
    run's logged rows, read from the log.
    """
    rows = outcomes.where(~F.col("passed")).select(
        F.col("bundle") if "bundle" in outcomes.columns else F.lit(None).cast("string").alias("bundle"),
        F.lit(run_ts).alias("run_ts"), "rule_id", "severity",
        (F.col(file_col) if file_col else F.lit(None).cast("string")).alias("file"),
        "description", F.lit("open").alias("status"))
    rows = rows.dropDuplicates(list(DEFECT_LOG_KEYS))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_ts", "bundle").parquet(path))
    return rows.sparkSession.read.schema(rows.schema).parquet(path).where(F.col("run_ts") == run_ts)
