"""tollgate: data-quality checks and release gating as Spark plans.

Public entry points; see README.md for the design.
"""

from .operators.business import (check_exam_date_window, check_pass_fail_certification,
                                 check_score_range, evaluate_freshness)
from .operators.duplicates import detect_duplicates, duplicate_rows, validate_uniqueness_constraints
from .operators.expectations import Expectation, Param, run_checkpoint, run_suite, suite_statistics
from .operators.fusion import AggCheck, fused
from .operators.integrity import (check_cert_candidate_fk, check_exam_candidate_fk,
                                  foreign_key_reference, latest_per_key, orphan_keys)
from .operators.schema import (SCHEMA_DEFINITIONS, SchemaDefinition, apply_schema_definition,
                               check_required_columns, dtype_audit, get_schema_definition)
from .outcome import CRITICAL, INFO, OUTCOME_SCHEMA, WARNING, to_outcomes, union_outcomes
from .plans.gate import CONTRACTS, GateConfig, GateReport, ReleaseGate, RuleSet
from .plans.reporting import (defect_summary, gate_status, release_decision, severity_enrich,
                              validation_summary)
from .session import build_session

__all__ = [
    "AggCheck", "CONTRACTS", "CRITICAL", "Expectation", "GateConfig",
    "GateReport", "INFO", "OUTCOME_SCHEMA", "Param", "ReleaseGate", "RuleSet", "SCHEMA_DEFINITIONS",
    "SchemaDefinition", "WARNING", "apply_schema_definition",
    "build_session", "check_cert_candidate_fk", "check_exam_candidate_fk",
    "check_exam_date_window", "check_pass_fail_certification", "check_required_columns",
    "check_score_range", "defect_summary", "detect_duplicates", "dtype_audit",
    "duplicate_rows", "evaluate_freshness", "foreign_key_reference", "fused", "gate_status",
    "get_schema_definition", "latest_per_key", "orphan_keys", "release_decision",
    "run_checkpoint", "run_suite", "severity_enrich", "suite_statistics", "to_outcomes",
    "union_outcomes", "validate_uniqueness_constraints", "validation_summary",
]
