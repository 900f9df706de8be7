"""User rule hook: callables or SQL that return outcome rows.

A rule is either ``Callable[[dict[str, DataFrame]], DataFrame]`` or a SQL
string whose ``{name}`` placeholders are bound to the bundle's DataFrames
(``spark.sql(sql, **tables)``), so user rules run as Spark plans like the
built-in ones. The result must carry ``rule_id``, ``passed`` and
``severity``; ``description`` is optional.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..outcome import SEVERITIES

Rule = Callable[[Mapping[str, DataFrame]], DataFrame] | str


def _validate(df: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    missing = [c for c in ("rule_id", "passed", "severity", *group_cols) if c not in df.columns]
    if missing:
        raise ValueError(f"custom rule result lacks columns {missing}")
    if "description" not in df.columns:
        df = df.withColumn("description", F.lit(None).cast("string"))
    sev = F.lower(F.col("severity").cast("string"))
    return df.withColumn("severity", F.when(sev.isin(list(SEVERITIES)), sev).otherwise(
        F.raise_error(F.concat(F.lit("invalid severity: "), sev))))


def sql_rule(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame],
             group_cols: Sequence[str] = ()) -> DataFrame:
    """Run a SQL rule with ``{table}`` placeholders bound to DataFrames."""
    return _validate(spark.sql(sql, **dict(tables)), group_cols)


def run_rule(rule: Rule, tables: Mapping[str, DataFrame], spark: SparkSession | None = None,
             group_cols: Sequence[str] = ()) -> DataFrame:
    if isinstance(rule, str):
        if spark is None:
            spark = next(iter(tables.values())).sparkSession
        return sql_rule(spark, rule, tables, group_cols)
    return _validate(rule(tables), group_cols)
