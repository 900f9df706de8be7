"""Rule-id expressions: root cause, slug, remediation link, rule family."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gate statuses, root-cause labels and the remediation base.
STATUS_READY = "Ready"
STATUS_WARNING_ONLY = "Warning only"
STATUS_BLOCKED = "Blocked"

ROOT_CAUSE_SCHEMA = "schema_issue"
ROOT_CAUSE_INTEGRITY = "integrity_issue"
ROOT_CAUSE_STALE_DATA = "stale_data"
ROOT_CAUSE_DUPLICATE = "duplicate_record"
ROOT_CAUSE_INVALID_BUSINESS_RULE = "invalid_business_rule_state"

REMEDIATION_BASE = "docs/rule-severity-matrix.md"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def root_cause(rule_id: str | Column = "rule_id") -> Column:
    """Classify a rule id; the first matching test wins, business is the default."""
    r = F.lower(_c(rule_id))
    return (
        F.when(r.contains("required-columns") | r.contains("-dtype") | r.contains("schema"),
               F.lit(ROOT_CAUSE_SCHEMA))
        .when(r.contains("-uniqueness") | r.contains("duplicate") | r.startswith("br-09"),
              F.lit(ROOT_CAUSE_DUPLICATE))
        .when(r.startswith("br-07") | r.contains("fk") | r.contains("integrity"),
              F.lit(ROOT_CAUSE_INTEGRITY))
        .when(r.startswith("br-08") | r.contains("freshness"), F.lit(ROOT_CAUSE_STALE_DATA))
        .otherwise(F.lit(ROOT_CAUSE_INVALID_BUSINESS_RULE))
    )


def slugify_rule_id(rule_id: str | Column = "rule_id") -> Column:
    """trim, lower, '_'/' ' -> '-', drop chars outside [a-z0-9-], strip '-'.

    An empty slug falls back to lower(rule_id).
    """
    raw = _c(rule_id)
    s = F.translate(F.lower(F.regexp_replace(raw, r"^\s+|\s+$", "")), "_ ", "--")
    s = F.regexp_replace(s, r"[^a-z0-9-]+", "")
    s = F.regexp_replace(s, r"^-+|-+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lower(raw))


def remediation_link(rule_id: str | Column = "rule_id", base: str = REMEDIATION_BASE) -> Column:
    return F.concat(F.lit(base + "#"), slugify_rule_id(rule_id))


def rule_family(rule_id: str | Column = "rule_id") -> Column:
    """First two '-' separated parts (``BR-05-pass`` -> ``BR-05``)."""
    parts = F.split(_c(rule_id), "-")
    return F.when(F.size(parts) > 1,
                  F.concat_ws("-", F.slice(parts, 1, 2))).otherwise(_c(rule_id))
