"""Scan sharing: many single-pass checks of one table in ONE aggregation.

A single-pass check is an ``AggCheck``: aggregate expressions (named under a
prefix the evaluator assigns) plus outcome rows computed from the aggregated
columns. ``run_flat`` evaluates one check and returns its flat frame (typed
metric columns); ``fused`` evaluates any number of checks of the same table
with one ``groupBy(...).agg(...)`` — one scan, one partial/final aggregate —
and returns outcome rows (metrics packed into ``details``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..functions.coerce import coerce_timestamp
from ..outcome import DETAILS_TYPE


@dataclass
class Row:
    """One outcome row of a check, as expressions over the aggregated columns."""

    rule_id: Column
    description: Column
    passed: Column
    severity: Column
    metrics: dict[str, Column] = field(default_factory=dict)
    json_metrics: frozenset[str] = frozenset()
    # Rows whose ``emit`` is false are dropped (e.g. passing dtype columns).
    emit: Column | None = None


@dataclass
class AggCheck:
    """``build(prefix) -> (aggregates, rows)``; names must start with prefix.

    ``group_defaults``: aggregates (name without prefix) that a group without
    rows takes from a column of the group list, e.g. its file time.
    """

    build: Callable[[str], tuple[list[Column], list[Row]]]
    group_defaults: dict[str, str] = field(default_factory=dict)


def _emit(r: Row) -> Column:
    return (r.emit if r.emit is not None else F.lit(True)).alias("__emit")


def _flat_struct(r: Row) -> Column:
    return F.struct(r.rule_id.alias("rule_id"), r.description.alias("description"),
                    r.passed.alias("passed"), r.severity.alias("severity"),
                    *[v.alias(k) for k, v in r.metrics.items()], _emit(r))


def _outcome_struct(r: Row) -> Column:
    pairs: list[Column] = []
    for k, v in r.metrics.items():
        pairs += [F.lit(k), F.to_json(v) if k in r.json_metrics else v.cast("string")]
    details = F.create_map(*pairs) if pairs else F.create_map().cast(DETAILS_TYPE)
    return F.struct(r.rule_id.cast("string").alias("rule_id"),
                    r.description.cast("string").alias("description"),
                    r.passed.cast("boolean").alias("passed"),
                    r.severity.cast("string").alias("severity"),
                    details.cast(DETAILS_TYPE).alias("details"), _emit(r))


def _aggregate(df: DataFrame, aggs: list[Column], group_cols: Sequence[str]) -> DataFrame:
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("__rows")]
    return df.groupBy(*group_cols).agg(*aggs)


def run_flat(df: DataFrame, check: AggCheck, group_cols: Sequence[str] = ()) -> DataFrame:
    """One check, flat output: [group..., rule_id, description, passed, severity, metrics...]."""
    aggs, rows = check.build("c0_")
    m = _aggregate(df, aggs, group_cols)
    out = m.select(*group_cols, F.inline(F.array(*[_flat_struct(r) for r in rows])))
    return out.where(F.col("__emit")).drop("__emit")


def fused(df: DataFrame, checks: Sequence[AggCheck], group_cols: Sequence[str] = (),
          seqs: Sequence[int] | None = None, groups: DataFrame | None = None) -> DataFrame:
    """All checks in one aggregation pass; outcome rows with ``details``.

    ``seqs`` gives each check's position in the evaluation order (``seq``
    column), so fused rows keep the order of an unfused run. ``groups`` (one
    row per group) makes every group report: one without rows gets what the
    aggregates say about an empty table.
    """
    all_aggs: list[Column] = []
    structs: list[Column] = []
    for i, c in enumerate(checks):
        aggs, rows = c.build(f"c{i}_")
        all_aggs += aggs
        for r in rows:
            st = _outcome_struct(r)
            if seqs is not None:
                st = st.withField("seq", F.lit(int(seqs[i])))
            structs.append(st)
    m = _aggregate(df, all_aggs, group_cols)
    if groups is not None:
        defaults = {f"c{i}_{k}": v for i, c in enumerate(checks) for k, v in c.group_defaults.items()
                    if v in groups.columns}
        m = _every_group(m, _aggregate(df.where(F.lit(False)), all_aggs, ()), groups, group_cols, defaults)
    out = m.select(*group_cols, F.inline(F.array(*structs)))
    return out.where(F.col("__emit")).drop("__emit")


def _every_group(m: DataFrame, empty: DataFrame, groups: DataFrame, group_cols: Sequence[str],
                 defaults: dict[str, str]) -> DataFrame:
    names = [c for c in m.columns if c not in set(group_cols)]
    j = (groups.join(m.withColumn("__has", F.lit(True)), list(group_cols), "left")
         .withColumn("__empty", empty.select(F.struct(*names)).scalar()))
    def value(n):
        none = F.col(f"__empty.{n}")
        if n in defaults:
            given = groups.schema[defaults[n]].dataType
            none = F.coalesce(none, coerce_timestamp(F.col(defaults[n]), given) if isinstance(m.schema[n].dataType, TimestampType)
                              else F.col(defaults[n]).cast(m.schema[n].dataType))
        return F.when(F.col("__has"), F.col(f"`{n}`")).otherwise(none).alias(n)
    return j.select(*group_cols, *[value(n) for n in names])


def fill_groups(flat: DataFrame, empty: DataFrame, groups: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """``flat``, and for each group every rule that it lacks, as ``empty`` has it.

    ``empty``: the same check over an empty table, ungrouped (a handful of
    rows, read as one scalar and repeated for each group).
    """
    names = [c for c in flat.columns if c not in set(group_cols)]
    rows = flat.select(*group_cols, "rule_id", F.struct(*[F.col(f"`{n}`") for n in names]).alias("__row"))
    none = empty.select(F.struct(*[F.col(f"`{n}`").cast(flat.schema[n].dataType).alias(n) for n in names]).alias("r")).agg(F.collect_list("r")).scalar()
    default = (groups.select(*group_cols).distinct().withColumn("__none", none)
               .select(*group_cols, F.explode("__none").alias("__default")).withColumn("rule_id", F.col("__default.rule_id")))
    j = default.join(rows, [*group_cols, "rule_id"], "full").select(*group_cols, F.coalesce("__row", "__default").alias("__each"))
    return j.select(*group_cols, *[F.col(f"__each.{n}").alias(n) for n in names])
