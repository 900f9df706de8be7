"""Bounded, deterministic training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold(doc_id: str, of: int) -> Column:
    """crc32 of the id's decimal text modulo ``of``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of


def bounded_sample(rows: DataFrame, by: str, key: str, per_class: int, seed: int = 17, total: int = 60_000) -> DataFrame:
    """About ``per_class`` rows of each large value of ``by``, all of a small one; never more than twice that.

    Every value takes part; with more than ``total / per_class`` of them each
    one's share shrinks, so that the sample stays at about ``total`` rows (one
    row a value at least). One counting pass sets the shares; rows are chosen
    by a hash of ``key`` and the row, never by the order they arrive in, so a
    rerun draws the same sample. Only chosen rows are shuffled.
    """
    sizes = [(r[by], r["n"]) for r in rows.groupBy(by).agg(F.count("*").alias("n")).collect()]  # a row a class, far less than a model holds of it
    per = max(1.0, min(per_class, total / max(1, len(sizes))))
    schema = T.StructType([T.StructField(by, rows.schema[by].dataType), T.StructField("_share", T.DoubleType())])
    shares = rows.sparkSession.createDataFrame([(value, min(1.0, per / n)) for value, n in sizes], schema)
    place = (F.xxhash64(F.lit(seed), F.col(key)).bitwiseAND(F.lit((1 << 30) - 1))) / float(1 << 30)
    drawn = rows.withColumn("_place", place).join(F.broadcast(shares), by).where(F.col("_place") < F.col("_share"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy("_place", F.xxhash64(*rows.columns)))
    return drawn.withColumn("_rank", rank).where(F.col("_rank") <= int(2 * per)).select(*rows.columns)
