"""File listings: feed presence per bundle and file metadata.

Listings come from the ``binaryFile`` source with the ``content`` column
pruned, so only file-system metadata is read. The expected manifest is
built by exploding the feed list per bundle (no cross join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..outcome import CRITICAL, finish
from .csv_feeds import BUNDLE_COL, FILE_COL, MTIME_COL, SIZE_COL, bundle_of


def list_files(spark: SparkSession, data_root: str, pattern: str = "*") -> DataFrame:
    """path, bundle, file_name, length, modificationTime of ``<root>/*/<pattern>``."""
    root = data_root.rstrip("/")
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .load(f"{root}/*/").select("path", "length", "modificationTime"))
    return df.select("path", bundle_of(F.col("path")).alias(BUNDLE_COL),
                     F.element_at(F.split("path", "/"), -1).alias("file_name"),
                     "length", "modificationTime")


def expected_files(bundles: DataFrame, file_names: Sequence[str]) -> DataFrame:
    """(bundle, file_name) manifest: the feed list exploded per bundle."""
    return bundles.select(BUNDLE_COL).distinct().select(
        BUNDLE_COL, F.explode(F.array(*[F.lit(f) for f in file_names])).alias("file_name"))


def missing_feed_files(spark: SparkSession, data_root: str, file_names: Sequence[str],
                       bundles: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Expected (bundle, file_name) pairs without a file."""
    listing = list_files(spark, data_root)
    if bundles is None:
        bundles = listing.select(BUNDLE_COL)
    elif not isinstance(bundles, DataFrame):
        bundles = spark.createDataFrame([(b,) for b in bundles], f"{BUNDLE_COL} string")
    exp = expected_files(bundles, file_names)
    return exp.join(listing.select(BUNDLE_COL, "file_name"), [BUNDLE_COL, "file_name"], "left_anti")


def require_feed_files(spark: SparkSession, data_root: str, file_names: Sequence[str],
                       bundles: DataFrame | Sequence[str] | None = None, show: int = 50) -> None:
    """Raise FileNotFoundError naming the missing files (up to ``show``, plus a count)."""
    missing = missing_feed_files(spark, data_root, file_names, bundles)
    head = missing.orderBy(BUNDLE_COL, "file_name").limit(show).collect()
    if head:
        total = missing.count()
        names = ", ".join(f"{data_root.rstrip('/')}/{r[BUNDLE_COL]}/{r['file_name']}" for r in head)
        more = f" (+{total - len(head)} more)" if total > len(head) else ""
        raise FileNotFoundError(f"Missing ingest files: {names}{more}")


def presence_outcomes(spark: SparkSession, data_root: str, file_names: Sequence[str],
                      bundles: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Flat outcome per (bundle, feed): ``{feed}-schema-file-present`` (critical)."""
    listing = list_files(spark, data_root)
    if bundles is None:
        bundles = listing.select(BUNDLE_COL)
    elif not isinstance(bundles, DataFrame):
        bundles = spark.createDataFrame([(b,) for b in bundles], f"{BUNDLE_COL} string")
    exp = expected_files(bundles, file_names)
    have = listing.select(BUNDLE_COL, "file_name").distinct().withColumn("present", F.lit(True))
    m = exp.join(have, [BUNDLE_COL, "file_name"], "left").withColumn(
        "present", F.coalesce("present", F.lit(False)))
    feed = F.regexp_replace(F.col("file_name"), r"\.[^.]*$", "")
    return finish(m, rule_id=F.concat(feed, F.lit("-schema-file-present")),
                  passed=F.col("present"), severity_fail=CRITICAL,
                  description_pass="Feed file is present.", description_fail="Feed file is missing.",
                  keep=["file_name"], group_cols=[BUNDLE_COL])


def file_metadata(df: DataFrame, overrides: dict | None = None) -> DataFrame:
    """Per source file: bundle, source path, size, row count, mtime (UTC), load time.

    ``overrides`` adds caller metadata (e.g. ``file_received_ts``) as columns;
    entries whose value is None are skipped.
    """
    out = df.groupBy(BUNDLE_COL, FILE_COL).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max(SIZE_COL).alias("file_size"),
        F.max(MTIME_COL).alias("modified_at"),
    ).withColumnRenamed(FILE_COL, "source_path").withColumn("loaded_at", F.current_timestamp())
    for k, v in (overrides or {}).items():
        if v is not None:
            out = out.withColumn(k, F.lit(v))
    return out
