"""Column-level helpers: all built-in Spark expressions, no Python UDFs."""

from .coerce import (NA_TOKENS, coerce_timestamp, hours_between, na_to_null,
                     strict_double, strict_long, try_cast_typed)
from .rules import (REMEDIATION_BASE, ROOT_CAUSE_DUPLICATE, ROOT_CAUSE_INTEGRITY,
                    ROOT_CAUSE_INVALID_BUSINESS_RULE, ROOT_CAUSE_SCHEMA,
                    ROOT_CAUSE_STALE_DATA, STATUS_BLOCKED, STATUS_READY,
                    STATUS_WARNING_ONLY, remediation_link, root_cause, rule_family,
                    slugify_rule_id)

__all__ = [
    "NA_TOKENS", "coerce_timestamp", "hours_between", "na_to_null", "strict_double",
    "strict_long", "try_cast_typed", "REMEDIATION_BASE", "ROOT_CAUSE_DUPLICATE",
    "ROOT_CAUSE_INTEGRITY", "ROOT_CAUSE_INVALID_BUSINESS_RULE", "ROOT_CAUSE_SCHEMA",
    "ROOT_CAUSE_STALE_DATA", "STATUS_BLOCKED", "STATUS_READY", "STATUS_WARNING_ONLY",
    "remediation_link", "root_cause", "rule_family", "slugify_rule_id",
]
