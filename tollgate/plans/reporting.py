"""Gate reporting over an outcome table covering many runs at once.

Input: an outcome table ``[keys..., rule_id, description, passed, severity,
details, seq]`` where ``keys`` identify a run (e.g. ``bundle``, ``run_ts``)
and ``seq`` is the evaluation order inside a run. Every report is one
``groupBy(keys)`` aggregation; arrays hold a run's rules (tens of rows),
never data rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import (STATUS_BLOCKED, STATUS_READY, STATUS_WARNING_ONLY,
                               remediation_link, root_cause, rule_family)
from ..outcome import CRITICAL

# Decision reasons.
REASON_BLOCKED = "Critical failure {rule} blocks release."
REASON_BLOCKED_GENERIC = "Critical data quality failures block release."
REASON_WARNING = "Warnings or info-level defects were raised; release may proceed with caution."
REASON_READY = "All validations passed; release is ready."

# The rule severity matrix (rule family, dimension, severity).
SEVERITY_MATRIX = (
    ("BR-01", "Completeness / Uniqueness", "Critical"),
    ("BR-02", "Uniqueness", "Critical"),
    ("BR-03", "Uniqueness", "Critical"),
    ("BR-04", "Validity", "Warning"),
    ("BR-05", "Consistency", "Critical / Warning (depends on mismatch)"),
    ("BR-06", "Validity", "Warning"),
    ("BR-07", "Consistency", "Critical"),
    ("BR-08", "Timeliness", "Critical / Warning"),
    ("BR-09", "Consistency / Uniqueness", "Critical"),
    ("BR-10", "Info", "Info"),
)


def with_payload(outcomes: DataFrame) -> DataFrame:
    """Add root_cause and remediation_link (the per-rule payload)."""
    return outcomes.withColumn("root_cause", root_cause("rule_id")).withColumn(
        "remediation_link", remediation_link("rule_id"))


def _status(failing_critical: Column, failing: Column) -> Column:
    return (F.when(failing_critical > 0, F.lit(STATUS_BLOCKED))
            .when(failing > 0, F.lit(STATUS_WARNING_ONLY)).otherwise(F.lit(STATUS_READY)))


def _order(outcomes: DataFrame) -> Column:
    return F.col("seq") if "seq" in outcomes.columns else F.lit(0)


def _by_seq(arr: Column) -> Column:
    """Sort payload structs by (seq, rule_id) and drop ``seq``.

    Payloads hold the ``details`` map, which has no ordering, so the sort
    uses an explicit comparator on the two order fields only.
    """
    def cmp(a, b):
        return (F.when(a["seq"] < b["seq"], -1).when(a["seq"] > b["seq"], 1)
                .when(a["rule_id"] < b["rule_id"], -1).when(a["rule_id"] > b["rule_id"], 1)
                .otherwise(0))
    return F.transform(F.array_sort(arr, cmp), lambda s: s.dropFields("seq"))


def gate_status(outcomes: DataFrame, keys: Sequence[str] = (),
                runs: DataFrame | None = None) -> DataFrame:
    """Blocked / Warning only / Ready per run. ``runs`` lists runs that must
    appear even without outcomes (they are Ready)."""
    failing = ~F.col("passed")
    crit = failing & (F.col("severity") == CRITICAL)
    agg = outcomes.groupBy(*keys).agg(F.count(F.lit(1)).alias("rule_count"),
                                      F.count_if(failing).alias("failed_count"),
                                      F.count_if(crit).alias("critical_failed_count"))
    if runs is not None:
        agg = runs.select(*keys).distinct().join(agg, list(keys), "left").na.fill(
            0, ["rule_count", "failed_count", "critical_failed_count"])
    return agg.withColumn("status", _status(F.col("critical_failed_count"), F.col("failed_count")))


def validation_summary(outcomes: DataFrame, keys: Sequence[str] = (),
                       include_rules: bool = True) -> DataFrame:
    """rule_count, failed_count and every rule's payload in evaluation order."""
    p = with_payload(outcomes)
    aggs = [F.count(F.lit(1)).alias("rule_count"), F.count_if(~F.col("passed")).alias("failed_count")]
    if include_rules:
        payload = F.struct(_order(p).alias("seq"), "rule_id", "description", "passed", "severity",
                           "root_cause", "remediation_link", "details")
        aggs.append(_by_seq(F.collect_list(payload)).alias("rules"))
    return p.groupBy(*keys).agg(*aggs)


def defect_counts(outcomes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Flat: one row per (run, root cause) with the number of failing rules."""
    p = with_payload(outcomes).where(~F.col("passed"))
    return p.groupBy(*keys, "root_cause").agg(F.count(F.lit(1)).alias("defect_count"))


def defect_summary(outcomes: DataFrame, keys: Sequence[str] = (), runs: DataFrame | None = None) -> DataFrame:
    """defect_count, defects (failing payloads in order), root_cause_counts map.

    A run without failing rules has a row with no defects; ``runs`` lists runs
    that must appear even without outcomes.
    """
    p = with_payload(outcomes)
    failing = ~F.col("passed")
    payload = F.struct(_order(p).alias("seq"), "rule_id", "description", "passed", "severity",
                       "root_cause", "remediation_link", "details")
    per_run = p.groupBy(*keys).agg(
        F.count_if(failing).alias("defect_count"),
        _by_seq(F.collect_list(F.when(failing, payload))).alias("defects"))
    counts = defect_counts(outcomes, keys).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("root_cause", "defect_count"))).alias("root_cause_counts"))
    if not keys:
        return per_run.select("*", counts.scalar().alias("root_cause_counts"))
    if runs is not None:
        per_run = runs.select(*keys).distinct().join(per_run, list(keys), "left").na.fill(0, ["defect_count"])
        per_run = per_run.withColumn("defects", F.coalesce("defects", F.array().cast(per_run.schema["defects"].dataType)))
    none = F.create_map().cast("map<string,bigint>")
    return per_run.join(counts, list(keys), "left").withColumn("root_cause_counts", F.coalesce("root_cause_counts", none))


def release_decision(outcomes: DataFrame, keys: Sequence[str] = (), runs: DataFrame | None = None,
                     reason_rule: str = "first_critical") -> DataFrame:
    """status, decision_reason, failed_rules, blocking_root_causes (Blocked only).

    ``reason_rule``: "first_critical" names the first failing critical rule;
    "first_failing" names the first failing rule of any severity.
    """
    p = with_payload(outcomes)
    failing = ~F.col("passed")
    crit = failing & (F.col("severity") == CRITICAL)
    order = _order(p)
    named = crit if reason_rule == "first_critical" else failing
    failed_payload = F.struct(order.alias("seq"), "rule_id", "severity", "root_cause", "details")
    agg = p.groupBy(*keys).agg(
        F.count_if(failing).alias("failed_count"),
        F.count_if(crit).alias("critical_failed_count"),
        F.min_by(F.col("rule_id"), F.when(named, F.struct(order, F.col("rule_id"))))
        .alias("reason_rule_id"),
        _by_seq(F.collect_list(F.when(failing, failed_payload))).alias("failed_rules"),
        F.array_sort(F.collect_set(F.when(crit, F.col("root_cause")))).alias("critical_root_causes"),
    )
    if runs is not None:
        agg = runs.select(*keys).distinct().join(agg, list(keys), "left").na.fill(
            0, ["failed_count", "critical_failed_count"])
    status = _status(F.col("critical_failed_count"), F.col("failed_count"))
    reason = (F.when(status == STATUS_BLOCKED,
                     F.when(F.col("reason_rule_id").isNotNull(),
                            F.concat(F.lit("Critical failure "), F.col("reason_rule_id"),
                                     F.lit(" blocks release.")))
                     .otherwise(F.lit(REASON_BLOCKED_GENERIC)))
              .when(status == STATUS_WARNING_ONLY, F.lit(REASON_WARNING))
              .otherwise(F.lit(REASON_READY)))
    blocking = F.when((status == STATUS_BLOCKED) & (F.size("critical_root_causes") > 0),
                      F.col("critical_root_causes"))
    return agg.select(*keys, status.alias("status"), reason.alias("decision_reason"),
                      F.coalesce("failed_rules", F.array().cast(agg.schema["failed_rules"].dataType))
                      .alias("failed_rules"),
                      blocking.alias("blocking_root_causes"), "failed_count")


def severity_matrix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SEVERITY_MATRIX),
                                 "rule_family string, dimension string, matrix_severity string")


def severity_enrich(outcomes: DataFrame, matrix: DataFrame | None = None) -> DataFrame:
    """Join the severity matrix on the rule family (first two '-' parts).

    The matrix has one row per rule family (ten rows), a proven bound, so it
    is broadcast and the outcome side is never shuffled.
    """
    matrix = matrix if matrix is not None else severity_matrix(outcomes.sparkSession)
    o = outcomes.withColumn("rule_family", rule_family("rule_id"))
    return o.join(F.broadcast(matrix), "rule_family", "left")
