"""The outcome table: one row per evaluated rule (per bundle / group).

Every check produces a *flat* frame first::

    [group cols..., rule_id, description, passed, severity, metric cols...]

Flat frames keep typed metric columns (counts, lags) so they can be compared
and aggregated directly. ``to_outcomes`` packs the metric columns into the
``details`` map, which gives every check the same schema so outcome frames of
different rules union into one table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Severities and outcome columns.
CRITICAL = "critical"
WARNING = "warning"
INFO = "info"
SEVERITIES = (CRITICAL, WARNING, INFO)

CORE_COLUMNS = ("rule_id", "description", "passed", "severity")

DETAILS_TYPE = T.MapType(T.StringType(), T.StringType())

OUTCOME_SCHEMA = T.StructType([
    T.StructField("rule_id", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("details", DETAILS_TYPE, True),
])


def json_list(c: Column) -> Column:
    """A list of texts in the one JSON form of ``details``: ``["a", "b"]``."""
    quoted = F.transform(c, lambda v: F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", ""))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def _as_detail_string(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
        return json_list(c)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    if isinstance(field.dataType, T.BooleanType):
        return F.lower(c.cast("string"))
    return c.cast("string")


def finish(metrics: DataFrame, *, rule_id: str | Column, passed: Column,
           severity_fail: str, severity_pass: str | None = None,
           description_pass: str, description_fail: str | Column | None = None,
           keep: Sequence[str | Column] = (), group_cols: Sequence[str] = ()) -> DataFrame:
    """Turn a metrics frame (one row per group) into a flat outcome frame.

    ``severity_pass`` defaults to ``severity_fail`` (schema rules keep their
    severity when they pass; business rules pass ``INFO``).
    """
    severity_pass = severity_pass or severity_fail
    if description_fail is None:
        description_fail = description_pass
    rid = rule_id if isinstance(rule_id, Column) else F.lit(rule_id)
    dfail = description_fail if isinstance(description_fail, Column) else F.lit(description_fail)
    return metrics.select(
        *[F.col(f"`{g}`") for g in group_cols],
        rid.alias("rule_id"),
        F.when(passed, F.lit(description_pass)).otherwise(dfail).alias("description"),
        passed.alias("passed"),
        F.when(passed, F.lit(severity_pass)).otherwise(F.lit(severity_fail)).alias("severity"),
        *[F.col(f"`{k}`") if isinstance(k, str) else k for k in keep],
    )


def to_outcomes(flat: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Pack every non-core, non-group column into ``details``."""
    skip = set(CORE_COLUMNS) | set(group_cols) | {"details"}
    extra = [f for f in flat.schema.fields if f.name not in skip]
    if extra:
        pairs: list[Column] = []
        for f in extra:
            pairs += [F.lit(f.name), _as_detail_string(f)]
        details = F.create_map(*pairs)
    elif "details" in flat.columns:
        details = F.col("details")
    else:
        details = F.create_map().cast(DETAILS_TYPE)
    if "details" in flat.columns and extra:
        details = F.map_concat(F.col("details"), details)
    return flat.select(
        *[F.col(f"`{g}`") for g in group_cols],
        F.col("rule_id").cast("string").alias("rule_id"),
        F.col("description").cast("string").alias("description"),
        F.col("passed").cast("boolean").alias("passed"),
        F.col("severity").cast("string").alias("severity"),
        details.cast(DETAILS_TYPE).alias("details"),
    )


def union_outcomes(frames: Iterable[DataFrame], group_cols: Sequence[str] = (),
                   with_seq: bool = True) -> DataFrame:
    """Union outcome frames in order; ``seq`` keeps the evaluation order."""
    out = None
    packed = set(CORE_COLUMNS) | set(group_cols) | {"details", "seq"}
    for i, fr in enumerate(frames):
        if "details" not in fr.columns or set(fr.columns) - packed:
            fr = to_outcomes(fr, group_cols)       # flat frame: pack its metrics
        if with_seq:
            fr = fr.withColumn("seq", F.lit(i))
        out = fr if out is None else out.unionByName(fr)
    if out is None:
        raise ValueError("no outcome frames given")
    return out


def literal_outcome(spark: SparkSession, rule_id: str, description: str, passed: bool,
                    severity: str, details: Mapping[str, Any] | None = None) -> DataFrame:
    """One outcome row from driver-side facts (schema/metadata checks)."""
    import json

    def enc(v: Any) -> str:
        if isinstance(v, (list, tuple, dict)):
            spaced = isinstance(v, (list, tuple)) and all(isinstance(x, str) for x in v)
            return json.dumps(v, ensure_ascii=False, separators=None if spaced else (",", ":"))
        if isinstance(v, bool):
            return "true" if v else "false"
        return str(v)

    row = (rule_id, description, bool(passed), severity,
           {k: enc(v) for k, v in (details or {}).items()})
    return spark.createDataFrame([row], OUTCOME_SCHEMA)


def empty_outcomes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], OUTCOME_SCHEMA)
