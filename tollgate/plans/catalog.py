"""Registered gate queries over the driver's tables, with DuckDB oracles.

Each query runs a library operator over whole tables (no id subsets, no row
caps) and returns flat, typed columns whose names match the oracle SQL.
Timestamps of the reference clock are literals, never the wall clock.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import remediation_link, root_cause, rule_family, slugify_rule_id
from ..operators import business, contract, custom, duplicates, expectations as ex, fusion, integrity, schema
from ..outcome import INFO, to_outcomes, union_outcomes
from ..session import checkpoint_dir, remove_at_end
from ..sources import csv_feeds, files, sinks
from . import reporting
from .gate import GateConfig, ReleaseGate, RuleSet
from .rules import DateWindow, ForeignKey, Freshness, NumberRange, StatusMapping, ValueSet

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

CORE = ["rule_id", "description", "passed", "severity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------
# individual checks (flat frames)
# --------------------------------------------------------------------------

def q_dup_lineitem_key(spark, d):
    r = duplicates.detect_duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                                     "lineitem-uniqueness-unique-1")
    return r.select(*CORE, "duplicate_count", "duplicate_groups")


SQL_DUP_LINEITEM_KEY = """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber),
m AS (SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_count,
             count(*) FILTER (WHERE n > 1) AS duplicate_groups FROM g)
SELECT 'lineitem-uniqueness-unique-1' AS rule_id,
       CASE WHEN duplicate_count = 0 THEN 'No duplicate rows detected for subset.' ELSE 'Duplicate rows detected.' END AS description,
       duplicate_count = 0 AS passed, 'critical' AS severity, duplicate_count, duplicate_groups FROM m
"""


def q_dup_document_text(spark, d):
    r = duplicates.detect_duplicates(table(spark, d, "documents"), ["text"],
                                     "documents-uniqueness-unique-1", hashed=["text"])
    return r.select(*CORE, "duplicate_count", "duplicate_groups")


SQL_DUP_DOCUMENT_TEXT = """
WITH g AS (SELECT text, count(*) AS n FROM documents GROUP BY text),
m AS (SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_count,
             count(*) FILTER (WHERE n > 1) AS duplicate_groups FROM g)
SELECT 'documents-uniqueness-unique-1' AS rule_id,
       CASE WHEN duplicate_count = 0 THEN 'No duplicate rows detected for subset.' ELSE 'Duplicate rows detected.' END AS description,
       duplicate_count = 0 AS passed, 'critical' AS severity, duplicate_count, duplicate_groups FROM m
"""


def q_uniqueness_multi(spark, d):
    return duplicates.check_uniqueness(table(spark, d, "orders"), [("o_orderkey",), ("o_custkey", "o_orderdate")],
                                       "orders-uniqueness").select(*CORE, "duplicate_count", "duplicate_groups")


def _dup_sql(rule_id: str, keys: str, tbl: str) -> str:
    return f"""SELECT '{rule_id}' AS rule_id,
       CASE WHEN duplicate_count = 0 THEN 'No duplicate rows detected for subset.' ELSE 'Duplicate rows detected.' END AS description,
       duplicate_count = 0 AS passed, 'critical' AS severity, duplicate_count, duplicate_groups
FROM (SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_count,
             count(*) FILTER (WHERE n > 1) AS duplicate_groups
      FROM (SELECT {keys}, count(*) AS n FROM {tbl} GROUP BY {keys}) g) m"""


SQL_UNIQUENESS_MULTI = (_dup_sql("orders-uniqueness-unique-1", "o_orderkey", "orders")
                        + "\nUNION ALL\n"
                        + _dup_sql("orders-uniqueness-unique-2", "o_custkey, o_orderdate", "orders"))


def q_required_keys_events(spark, d):
    ev = table(spark, d, "events").select(F.json_object_keys("props").alias("keys"))
    r = schema.required_keys(ev, "keys", ["k", "v"], "events-schema-required-keys")
    return r.select(*CORE, "required_key", "missing_rows", "row_count")


SQL_REQUIRED_KEYS_EVENTS = """
WITH k AS (SELECT json_keys(props) AS keys FROM events),
m AS (SELECT count(*) AS row_count,
             count(*) FILTER (WHERE NOT coalesce(list_contains(keys, 'k'), false)) AS missing_k,
             count(*) FILTER (WHERE NOT coalesce(list_contains(keys, 'v'), false)) AS missing_v FROM k),
r AS (SELECT 'k' AS required_key, missing_k AS missing_rows, row_count FROM m
      UNION ALL SELECT 'v', missing_v, row_count FROM m)
SELECT 'events-schema-required-keys' AS rule_id,
       CASE WHEN missing_rows = 0 THEN 'Required key present in every row.' ELSE 'Rows lack a required key.' END AS description,
       missing_rows = 0 AS passed, 'critical' AS severity, required_key, missing_rows, row_count FROM r
"""


def _events_typed_source(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("props_k"), "event_type")


EVENTS_DTYPES = {"props_k": "Int64", "event_type": "float64"}


def q_dtype_audit_events(spark, d):
    r = schema.dtype_audit(_events_typed_source(spark, d), EVENTS_DTYPES, "events-dtype")
    return r.select(*CORE, "column", "target_dtype", "failed_count")


SQL_DTYPE_AUDIT_EVENTS = """
WITH s AS (SELECT json_extract_string(props, '$.k') AS props_k, event_type FROM events),
m AS (SELECT count(*) FILTER (WHERE props_k IS NOT NULL AND TRY_CAST(props_k AS BIGINT) IS NULL) AS b0,
             count(*) FILTER (WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS DOUBLE) IS NULL) AS b1 FROM s),
r AS (SELECT 'props_k' AS "column", 'Int64' AS target_dtype, b0 AS failed_count FROM m
      UNION ALL SELECT 'event_type', 'float64', b1 FROM m)
SELECT 'events-dtype-' || "column" AS rule_id,
       CASE WHEN failed_count = 0 THEN 'Column values coerce to the declared type.'
            ELSE 'Could not coerce ' || "column" || ' to ' || target_dtype || '.' END AS description,
       failed_count = 0 AS passed, 'warning' AS severity, "column", target_dtype, failed_count FROM r
"""


def q_dtype_normalize_events(spark, d):
    return schema.normalize(_events_typed_source(spark, d), EVENTS_DTYPES)


SQL_DTYPE_NORMALIZE_EVENTS = """
SELECT event_id,
       CASE WHEN regexp_matches(json_extract_string(props, '$.k'), '^\\s*[+-]?\\d+\\s*$')
            THEN TRY_CAST(trim(json_extract_string(props, '$.k')) AS BIGINT) END AS props_k,
       CASE WHEN regexp_matches(event_type, '(?i)^\\s*[+-]?((\\d+(\\.\\d*)?|\\.\\d+)(e[+-]?\\d+)?|inf|infinity)\\s*$')
            THEN TRY_CAST(trim(event_type) AS DOUBLE) END AS event_type
FROM events
"""

FK_ORDERS_DESC = "Every order customer exists."


def _fk_orders(spark, d):
    return table(spark, d, "orders"), table(spark, d, "customer")


def q_fk_orders_customer(spark, d):
    o, c = _fk_orders(spark, d)
    r = integrity.foreign_key_reference(o, c, "o_custkey", "c_custkey", "BR-07-orders-customer",
                                        FK_ORDERS_DESC)
    return r.select(*CORE, "missing_count")


SQL_FK_ORDERS_CUSTOMER = f"""
WITH o AS (SELECT DISTINCT o_custkey FROM orders
           WHERE o_custkey IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)),
m AS (SELECT count(*) AS missing_count FROM o)
SELECT 'BR-07-orders-customer' AS rule_id,
       CASE WHEN missing_count = 0 THEN '{FK_ORDERS_DESC}' ELSE '{FK_ORDERS_DESC} Mismatched candidates found.' END AS description,
       missing_count = 0 AS passed, CASE WHEN missing_count = 0 THEN 'info' ELSE 'critical' END AS severity,
       missing_count FROM m
"""


def q_fk_orders_customer_orphans(spark, d):
    o, c = _fk_orders(spark, d)
    return integrity.orphan_keys(o, c, "o_custkey", "c_custkey", key_alias="o_custkey")


SQL_FK_ORDERS_CUSTOMER_ORPHANS = """
SELECT DISTINCT o_custkey FROM orders
WHERE o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
"""

FK_EVENTS_DESC = "Every event user is a customer."


def q_fk_events_customer(spark, d):
    """A foreign key over a fact table and its whole parent, with the sample of its first orphans."""
    r = integrity.foreign_key_reference(table(spark, d, "events"), table(spark, d, "customer"), "user_id",
                                        "c_custkey", "BR-07-events-customer", FK_EVENTS_DESC)
    return r.select(*CORE, "missing_count", F.array_join("sample_values", ",").alias("sample_values"))


SQL_FK_EVENTS_CUSTOMER = f"""
WITH o AS (SELECT DISTINCT user_id AS k FROM events
           WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id)),
m AS (SELECT count(*) AS missing_count FROM o),
v AS (SELECT coalesce(string_agg(CAST(k AS VARCHAR), ',' ORDER BY k), '') AS sample_values FROM (SELECT k FROM o ORDER BY k LIMIT 20))
SELECT 'BR-07-events-customer' AS rule_id,
       CASE WHEN missing_count = 0 THEN '{FK_EVENTS_DESC}' ELSE '{FK_EVENTS_DESC} Mismatched candidates found.' END AS description,
       missing_count = 0 AS passed, CASE WHEN missing_count = 0 THEN 'info' ELSE 'critical' END AS severity,
       missing_count, sample_values FROM m, v
"""


def q_fk_events_customer_orphans(spark, d):
    """The complete orphan list, as the gate writes it for each foreign key rule."""
    keys = integrity.orphan_keys(table(spark, d, "events"), table(spark, d, "customer"), "user_id", "c_custkey")
    return integrity.orphan_details(keys, "BR-07-events-customer")


SQL_FK_EVENTS_CUSTOMER_ORPHANS = """
SELECT DISTINCT 'BR-07-events-customer' AS rule_id, CAST(user_id AS VARCHAR) AS missing_value FROM events
WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id)
"""

FK_DOCS_DESC = "Every document has a quality label."


def q_fk_documents_labels(spark, d):
    r = integrity.foreign_key_reference(table(spark, d, "documents"), table(spark, d, "labels"),
                                        "doc_id", "doc_id", "documents-labels-fk", FK_DOCS_DESC,
                                        severity=INFO)
    return r.select(*CORE, "missing_count")


SQL_FK_DOCUMENTS_LABELS = f"""
WITH o AS (SELECT DISTINCT doc_id FROM documents d
           WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)),
m AS (SELECT count(*) AS missing_count FROM o)
SELECT 'documents-labels-fk' AS rule_id,
       CASE WHEN missing_count = 0 THEN '{FK_DOCS_DESC}' ELSE '{FK_DOCS_DESC} Mismatched candidates found.' END AS description,
       missing_count = 0 AS passed, 'info' AS severity, missing_count FROM m
"""

SUITE_COLS = ["suite", "expectation_type", "column_name", "success", "element_count",
              "missing_count", "unexpected_count", "unexpected_percent"]


def _docs_labeled(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "text").join(
        table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")


def q_not_null_quality(spark, d):
    r = ex.run_suite(_docs_labeled(spark, d), "documents_suite", [ex.not_null("quality")])
    return r.select(*SUITE_COLS)


def _pct_sql(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) * 100 / CAST({den} AS DOUBLE) END"


SQL_NOT_NULL_QUALITY = f"""
WITH j AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
m AS (SELECT count(*) AS el, count(*) FILTER (WHERE quality IS NULL) AS un FROM j)
SELECT 'documents_suite' AS suite, 'expect_column_values_to_not_be_null' AS expectation_type,
       'quality' AS column_name, un = 0 AS success, el AS element_count,
       CAST(NULL AS BIGINT) AS missing_count, un AS unexpected_count,
       {_pct_sql('un', 'el')} AS unexpected_percent FROM m
"""


def _scalar_exp_sql(suite: str, etype: str, column: str, tbl: str, bad: str) -> str:
    return f"""SELECT '{suite}' AS suite, '{etype}' AS expectation_type, '{column}' AS column_name,
       un = 0 AS success, el AS element_count, mi AS missing_count, un AS unexpected_count,
       {_pct_sql('un', 'el - mi')} AS unexpected_percent
FROM (SELECT count(*) AS el, count(*) FILTER (WHERE {column} IS NULL) AS mi,
             count(*) FILTER (WHERE {column} IS NOT NULL AND ({bad})) AS un FROM {tbl}) m"""


def q_range_discount(spark, d):
    r = ex.run_suite(table(spark, d, "lineitem"), "lineitem_suite",
                     [ex.between("l_discount", 0.01, 0.05)])
    return r.select(*SUITE_COLS)


SQL_RANGE_DISCOUNT = _scalar_exp_sql(
    "lineitem_suite", "expect_column_values_to_be_between", "l_discount", "lineitem",
    "l_discount < CAST(0.01 AS DOUBLE) OR l_discount > CAST(0.05 AS DOUBLE)")

PRIORITIES = ["1-URGENT", "2-HIGH"]


def q_in_set_priority(spark, d):
    r = ex.run_suite(table(spark, d, "orders"), "orders_suite",
                     [ex.in_set("o_orderpriority", PRIORITIES)])
    return r.select(*SUITE_COLS)


SQL_IN_SET_PRIORITY = _scalar_exp_sql(
    "orders_suite", "expect_column_values_to_be_in_set", "o_orderpriority", "orders",
    "o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")


def _order_date_params(spark, d):
    o = table(spark, d, "orders")
    return ex.parameters(o, {"min_order_date": F.min("o_orderdate"),
                             "max_order_date": F.max("o_orderdate")})


def q_param_range_shipdate(spark, d):
    r = ex.run_suite(table(spark, d, "lineitem"), "lineitem_suite",
                     [ex.between("l_shipdate", ex.Param("min_order_date"), ex.Param("max_order_date"))],
                     params=_order_date_params(spark, d))
    return r.select(*SUITE_COLS)


SQL_PARAM_RANGE_SHIPDATE = _scalar_exp_sql(
    "lineitem_suite", "expect_column_values_to_be_between", "l_shipdate", "lineitem",
    "l_shipdate < (SELECT min(o_orderdate) FROM orders) OR l_shipdate > (SELECT max(o_orderdate) FROM orders)")


def q_score_range_props(spark, d):
    ev = table(spark, d, "events")
    r = business.check_score_range(ev, "props.k", "BR-04-props-k", 0, 50,
                                   value=F.get_json_object("props", "$.k"))
    return r.select(*CORE, "invalid_format_count", "out_of_range_count")


_NUM_RE = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"

SQL_SCORE_RANGE_PROPS = f"""
WITH s AS (SELECT json_extract_string(props, '$.k') AS raw FROM events),
n AS (SELECT raw, CASE WHEN regexp_matches(raw, '{_NUM_RE}') THEN TRY_CAST(trim(raw) AS DOUBLE) END AS v FROM s),
m AS (SELECT count(*) FILTER (WHERE raw IS NOT NULL AND (v IS NULL OR isnan(v))) AS invalid_format_count,
             count(*) FILTER (WHERE NOT isnan(v) AND (v < 0 OR v > 50)) AS out_of_range_count FROM n)
SELECT 'BR-04-props-k' AS rule_id,
       CASE WHEN invalid_format_count = 0 AND out_of_range_count = 0 THEN 'Column ''props.k'' stays within 0.0-50.0.'
            ELSE 'Score range violation.' END AS description,
       invalid_format_count = 0 AND out_of_range_count = 0 AS passed,
       CASE WHEN invalid_format_count = 0 AND out_of_range_count = 0 THEN 'info' ELSE 'warning' END AS severity,
       invalid_format_count, out_of_range_count FROM m
"""


def q_date_window_orders(spark, d):
    r = business.check_exam_date_window(table(spark, d, "orders"), "1998-01-01", 12,
                                        "BR-06-orders", "o_orderdate")
    return r.select(*CORE, "window_days", "out_of_window")


SQL_DATE_WINDOW_ORDERS = """
WITH m AS (SELECT count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01' - INTERVAL 366 DAY
                                      OR o_orderdate > TIMESTAMP '1998-01-01') AS out_of_window FROM orders)
SELECT 'BR-06-orders' AS rule_id,
       CASE WHEN out_of_window = 0 THEN 'Exam dates fall within the rolling 12-month window.'
            ELSE 'Exam dates are outside the allowed window.' END AS description,
       out_of_window = 0 AS passed, CASE WHEN out_of_window = 0 THEN 'info' ELSE 'warning' END AS severity,
       366 AS window_days, out_of_window FROM m
"""


def q_latest_event_per_user(spark, d):
    r = integrity.latest_per_key(table(spark, d, "events"), ["user_id"], "ts", ["event_id"])
    return r.select("user_id", "event_id", "event_type", "value")


SQL_LATEST_EVENT_PER_USER = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
  FROM events) WHERE rn = 1
"""

STATUS_KW = dict(key="o_custkey", cert_key="user_id", outcome_col="o_orderstatus",
                 status_col="event_type", ts_col="ts", tie_cols=("event_id",),
                 order_col="o_orderkey", passing=("F",), failing=("O",),
                 certified=("purchase", "signup"))


def q_status_mapping(spark, d):
    r = business.check_pass_fail_certification(table(spark, d, "orders"), table(spark, d, "events"),
                                               "BR-05", **STATUS_KW)
    return r.select(*CORE, "mismatch_count", "missing_count")


_LATEST_STATUS_CTE = """latest AS (
  SELECT user_id, event_type AS status FROM (
    SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
    FROM events) WHERE rn = 1),
j AS (SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, l.status FROM orders o
      LEFT JOIN latest l ON o.o_custkey IS NOT DISTINCT FROM l.user_id)"""

SQL_STATUS_MAPPING = f"""
WITH {_LATEST_STATUS_CTE},
m AS (SELECT
  count(*) FILTER (WHERE o_orderstatus = 'F' AND coalesce(status, '') NOT IN ('purchase', 'signup')) AS pm,
  count(*) FILTER (WHERE o_orderstatus = 'F' AND status IS NULL) AS pmi,
  count(*) FILTER (WHERE o_orderstatus = 'O' AND coalesce(status, '') IN ('purchase', 'signup')) AS fm FROM j)
SELECT 'BR-05-pass' AS rule_id, 'Pass exams should map to Certified statuses.' AS description,
       NOT (pm > 0 OR pmi > 0) AS passed, CASE WHEN pm > 0 OR pmi > 0 THEN 'critical' ELSE 'info' END AS severity,
       pm AS mismatch_count, pmi AS missing_count FROM m
UNION ALL
SELECT 'BR-05-fail', 'Fail attempts should not result in Certified statuses.', fm = 0,
       CASE WHEN fm > 0 THEN 'warning' ELSE 'info' END, fm, CAST(NULL AS BIGINT) FROM m
"""


def q_status_mapping_sample(spark, d):
    keys = business.status_mapping_keys(table(spark, d, "orders"), table(spark, d, "events"),
                                        **STATUS_KW)
    return business.offender_sample(keys, 5)


SQL_STATUS_MAPPING_SAMPLE = f"""
WITH {_LATEST_STATUS_CTE},
p AS (SELECT 'BR-05-pass' AS rule_id, o_custkey, min(o_orderkey) AS first_row FROM j
      WHERE o_orderstatus = 'F' AND coalesce(status, '') NOT IN ('purchase', 'signup') GROUP BY o_custkey),
f AS (SELECT 'BR-05-fail' AS rule_id, o_custkey, min(o_orderkey) AS first_row FROM j
      WHERE o_orderstatus = 'O' AND coalesce(status, '') IN ('purchase', 'signup') GROUP BY o_custkey),
r AS (SELECT rule_id, CAST(o_custkey AS VARCHAR) AS candidate, first_row,
             CAST(row_number() OVER (PARTITION BY rule_id ORDER BY first_row, o_custkey) AS INTEGER) AS sample_rank
      FROM (SELECT * FROM p UNION ALL SELECT * FROM f))
SELECT rule_id, sample_rank, candidate, first_row FROM r WHERE sample_rank <= 5
"""

# Fixed values for the per-type freshness contract (max, warning) in hours.
EVENT_THRESHOLDS = {"click": (24.0, 48.0), "error": (6.0, 12.0), "purchase": (12.0, 13.0),
                    "signup": (12.5, 24.0), "view": (12.0, 24.0)}
FRESHNESS_REF = "2024-01-31 12:00:00"


def q_freshness_by_type(spark, d):
    r = business.evaluate_freshness(table(spark, d, "events"), reference_ts=FRESHNESS_REF,
                                    timestamp_column="ts", group_cols=["event_type"],
                                    thresholds=EVENT_THRESHOLDS, rule_id="BR-08-events")
    return r.select("event_type", *CORE, "lag_hours_exact", "max_allowed_hours", "warning_hours",
                    "timestamp_source")


def _thresholds_sql() -> str:
    rows = ", ".join(f"('{k}', CAST({v[0]} AS DOUBLE), CAST({v[1]} AS DOUBLE))"
                     for k, v in EVENT_THRESHOLDS.items())
    return f"(VALUES {rows}) AS t(event_type, max_allowed_hours, warning_hours)"


SQL_FRESHNESS_BY_TYPE = f"""
WITH m AS (SELECT event_type, max(ts) AS latest FROM events GROUP BY event_type),
l AS (SELECT m.event_type, greatest(0.0, CAST(epoch_us(TIMESTAMP '{FRESHNESS_REF}') - epoch_us(latest) AS DOUBLE) / 3600000000.0) AS lag_hours_exact,
             coalesce(t.max_allowed_hours, 24.0) AS max_allowed_hours, coalesce(t.warning_hours, 48.0) AS warning_hours
      FROM m LEFT JOIN {_thresholds_sql()} ON m.event_type = t.event_type)
SELECT event_type, 'BR-08-events' AS rule_id,
       CASE WHEN lag_hours_exact <= max_allowed_hours THEN 'Freshness is within allowed lag.'
            WHEN lag_hours_exact <= warning_hours THEN 'Freshness crosses warning threshold.'
            ELSE 'Freshness exceeds the critical lag threshold.' END AS description,
       lag_hours_exact <= max_allowed_hours AS passed,
       CASE WHEN lag_hours_exact <= max_allowed_hours THEN 'info'
            WHEN lag_hours_exact <= warning_hours THEN 'warning' ELSE 'critical' END AS severity,
       lag_hours_exact, max_allowed_hours, warning_hours, 'ts' AS timestamp_source FROM l
"""



# --------------------------------------------------------------------------
# checkpoint: several suites in one plan
# --------------------------------------------------------------------------

CHECKPOINT_COLS = ["batch_identifier", "suite", "expectation_index", "expectation_type",
                   "column_name", "success", "element_count", "missing_count",
                   "unexpected_count", "unexpected_percent"]


def _validations(spark, d):
    return [
        ("orders", table(spark, d, "orders"), "orders_suite", [
            ex.not_null("o_orderkey"), ex.unique("o_orderkey"),
            ex.compound_unique(["o_custkey", "o_orderdate"]),
            ex.in_set("o_orderpriority", PRIORITIES), ex.between("o_totalprice", 0, None)]),
        ("lineitem", table(spark, d, "lineitem"), "lineitem_suite", [
            ex.between("l_discount", 0.01, 0.05),
            ex.between("l_shipdate", ex.Param("min_order_date"), ex.Param("max_order_date")),
            ex.compound_unique(["l_orderkey", "l_linenumber"]), ex.not_null("l_returnflag"),
            ex.in_set("l_linestatus", ["O", "F"])]),
        ("documents", _docs_labeled(spark, d), "documents_suite", [
            ex.not_null("quality"), ex.in_set("lang", ["en", "de", "fr", "es"]),
            ex.unique("doc_id")]),
    ]


def checkpoint_results(spark, d) -> DataFrame:
    return ex.run_checkpoint(_validations(spark, d), _order_date_params(spark, d))


def q_expectation_results(spark, d):
    return checkpoint_results(spark, d).select(*CHECKPOINT_COLS)


def q_suite_stats(spark, d):
    return ex.suite_statistics(checkpoint_results(spark, d))


_CHECKPOINT_TABLES = {
    "orders": "orders", "lineitem": "lineitem",
    "documents": "(SELECT d.doc_id, d.lang, d.text, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)",
}
_CHECKPOINT_SPECS = [
    ("orders", "orders_suite", [
        ("not_null", "o_orderkey", None), ("unique", "o_orderkey", None),
        ("compound", "o_custkey, o_orderdate", None),
        ("in_set", "o_orderpriority", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"),
        ("between", "o_totalprice", "o_totalprice < 0")]),
    ("lineitem", "lineitem_suite", [
        ("between", "l_discount", "l_discount < CAST(0.01 AS DOUBLE) OR l_discount > CAST(0.05 AS DOUBLE)"),
        ("between", "l_shipdate", "l_shipdate < (SELECT min(o_orderdate) FROM orders) OR l_shipdate > (SELECT max(o_orderdate) FROM orders)"),
        ("compound", "l_orderkey, l_linenumber", None), ("not_null", "l_returnflag", None),
        ("in_set", "l_linestatus", "l_linestatus NOT IN ('O', 'F')")]),
    ("documents", "documents_suite", [
        ("not_null", "quality", None), ("in_set", "lang", "lang NOT IN ('en', 'de', 'fr', 'es')"),
        ("unique", "doc_id", None)]),
]
_ETYPE = {"not_null": "expect_column_values_to_not_be_null", "unique": "expect_column_values_to_be_unique",
          "compound": "expect_compound_columns_to_be_unique", "in_set": "expect_column_values_to_be_in_set",
          "between": "expect_column_values_to_be_between"}


def _expectation_sql(batch: str, suite: str, idx: int, kind: str, column: str, bad: str | None) -> str:
    t = _CHECKPOINT_TABLES[batch]
    head = f"SELECT '{batch}' AS batch_identifier, '{suite}' AS suite, {idx} AS expectation_index, " \
           f"'{_ETYPE[kind]}' AS expectation_type, '{column.replace(' ', '')}' AS column_name, "
    if kind == "not_null":
        return head + f"""un = 0 AS success, el AS element_count, CAST(NULL AS BIGINT) AS missing_count,
  un AS unexpected_count, {_pct_sql('un', 'el')} AS unexpected_percent
FROM (SELECT count(*) AS el, count(*) FILTER (WHERE {column} IS NULL) AS un FROM {t}) m"""
    if kind in ("unique", "compound"):
        keys = [k.strip() for k in column.split(",")]
        miss = (" AND " if kind == "compound" else " OR ").join(f"{k} IS NULL" for k in keys)
        return head + f"""un = 0 AS success, el AS element_count, mi AS missing_count,
  un AS unexpected_count, {_pct_sql('un', 'el - mi')} AS unexpected_percent
FROM (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS el,
             CAST(coalesce(sum(n) FILTER (WHERE {miss}), 0) AS BIGINT) AS mi,
             CAST(coalesce(sum(n) FILTER (WHERE NOT ({miss}) AND n > 1), 0) AS BIGINT) AS un
      FROM (SELECT {column}, count(*) AS n FROM {t} GROUP BY {column}) g) m"""
    return head + f"""un = 0 AS success, el AS element_count, mi AS missing_count,
  un AS unexpected_count, {_pct_sql('un', 'el - mi')} AS unexpected_percent
FROM (SELECT count(*) AS el, count(*) FILTER (WHERE {column} IS NULL) AS mi,
             count(*) FILTER (WHERE {column} IS NOT NULL AND ({bad})) AS un FROM {t}) m"""


SQL_EXPECTATION_RESULTS = "\nUNION ALL\n".join(
    _expectation_sql(batch, suite, i, kind, col, bad)
    for batch, suite, specs in _CHECKPOINT_SPECS for i, (kind, col, bad) in enumerate(specs))

SQL_SUITE_STATS = f"""
WITH r AS ({SQL_EXPECTATION_RESULTS})
SELECT suite, count(*) AS evaluated_expectations,
       count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
       {_pct_sql('count(*) FILTER (WHERE success)', 'count(*)')} AS success_percent,
       bool_and(success) AS success
FROM r GROUP BY suite
"""


def q_partial_unexpected_priority(spark, d):
    e = ex.in_set("o_orderpriority", PRIORITIES)
    pl = ex.partial_unexpected(table(spark, d, "orders"), [(0, e)], {}, ())
    return pl.select(F.posexplode("partial_unexpected_counts").alias("pos", "x")).select(
        (F.col("pos") + 1).alias("rank"), F.col("x.value").alias("value"), F.col("x.count").alias("count"))


SQL_PARTIAL_UNEXPECTED_PRIORITY = """
SELECT CAST(row_number() OVER (ORDER BY count DESC, value ASC NULLS FIRST) AS INTEGER) AS rank, value, count
FROM (SELECT o_orderpriority AS value, count(*) AS count FROM orders
      WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
      GROUP BY o_orderpriority) v
QUALIFY rank <= 20
"""


# --------------------------------------------------------------------------
# outcome table of one gate run over the driver tables
# --------------------------------------------------------------------------

def q_freshness_events(spark, d):
    r = business.evaluate_freshness(table(spark, d, "events"), reference_ts=FRESHNESS_REF,
                                    timestamp_column="ts", rule_id="BR-08")
    return r.select(*CORE, "lag_hours_exact")


SQL_FRESHNESS_EVENTS = f"""
WITH l AS (SELECT greatest(0.0, CAST(epoch_us(TIMESTAMP '{FRESHNESS_REF}') - epoch_us(max(ts)) AS DOUBLE) / 3600000000.0) AS lag_hours_exact FROM events)
SELECT 'BR-08' AS rule_id,
       CASE WHEN lag_hours_exact <= 24 THEN 'Freshness is within allowed lag.'
            WHEN lag_hours_exact <= 48 THEN 'Freshness crosses warning threshold.'
            ELSE 'Freshness exceeds the critical lag threshold.' END AS description,
       lag_hours_exact <= 24 AS passed,
       CASE WHEN lag_hours_exact <= 24 THEN 'info' WHEN lag_hours_exact <= 48 THEN 'warning' ELSE 'critical' END AS severity,
       lag_hours_exact FROM l
"""

def q_events_fused(spark, d):
    """The four events checks (JSON keys, dtypes, score range, freshness) in ONE scan."""
    src = table(spark, d, "events").select(
        "props", "event_type", "ts", F.get_json_object("props", "$.k").alias("props_k"))
    return fusion.fused(src, [
        schema.required_keys_check(F.json_object_keys("props"), ["k", "v"], "events-schema-required-keys"),
        schema.dtype_audit_check(src, EVENTS_DTYPES, "events-dtype"),
        business.score_range_check(src, "props.k", "BR-04-props-k", 0, 50, value=F.col("props_k")),
        business.freshness_check(src, reference_ts=FRESHNESS_REF, timestamp_column="ts", rule_id="BR-08"),
    ])


# (spark frames, oracle SQL pieces) per evaluation step; a step's rows share a seq.
_GATE_PARTS = [
    ([q_dup_lineitem_key], [SQL_DUP_LINEITEM_KEY]),
    ([q_uniqueness_multi], [SQL_UNIQUENESS_MULTI]),
    ([q_events_fused], [SQL_REQUIRED_KEYS_EVENTS, SQL_DTYPE_AUDIT_EVENTS, SQL_SCORE_RANGE_PROPS,
                        SQL_FRESHNESS_EVENTS]),
    ([q_fk_orders_customer], [SQL_FK_ORDERS_CUSTOMER]),
    ([q_fk_documents_labels], [SQL_FK_DOCUMENTS_LABELS]),
    ([q_date_window_orders], [SQL_DATE_WINDOW_ORDERS]),
    ([q_status_mapping], [SQL_STATUS_MAPPING]),
]


def gate_outcomes(spark, d) -> DataFrame:
    """Outcome table of one gate run: every check above, in evaluation order."""
    return union_outcomes([fns[0](spark, d) for fns, _ in _GATE_PARTS])


SQL_GATE_OUTCOMES = "\nUNION ALL\n".join(
    f"SELECT {i} AS seq, rule_id, description, passed, severity FROM ({sql}) s{i}_{j}"
    for i, (_, sqls) in enumerate(_GATE_PARTS) for j, sql in enumerate(sqls))

_SLUG_SQL = ("coalesce(nullif(regexp_replace(regexp_replace(replace(replace(lower(trim(rule_id)), '_', '-'), ' ', '-'), "
             "'[^a-z0-9-]+', '', 'g'), '^-+|-+$', '', 'g'), ''), lower(rule_id))")
_ROOT_CAUSE_SQL = """CASE
  WHEN lower(rule_id) LIKE '%required-columns%' OR lower(rule_id) LIKE '%-dtype%' OR lower(rule_id) LIKE '%schema%' THEN 'schema_issue'
  WHEN lower(rule_id) LIKE '%-uniqueness%' OR lower(rule_id) LIKE '%duplicate%' OR starts_with(lower(rule_id), 'br-09') THEN 'duplicate_record'
  WHEN starts_with(lower(rule_id), 'br-07') OR lower(rule_id) LIKE '%fk%' OR lower(rule_id) LIKE '%integrity%' THEN 'integrity_issue'
  WHEN starts_with(lower(rule_id), 'br-08') OR lower(rule_id) LIKE '%freshness%' THEN 'stale_data'
  ELSE 'invalid_business_rule_state' END"""


def q_outcome_payload(spark, d):
    o = gate_outcomes(spark, d)
    return o.select("seq", "rule_id", "passed", "severity", root_cause("rule_id").alias("root_cause"),
                    slugify_rule_id("rule_id").alias("slug"),
                    remediation_link("rule_id").alias("remediation_link"))


SQL_OUTCOME_PAYLOAD = f"""
WITH o AS ({SQL_GATE_OUTCOMES})
SELECT seq, rule_id, passed, severity, {_ROOT_CAUSE_SQL} AS root_cause, {_SLUG_SQL} AS slug,
       'docs/rule-severity-matrix.md#' || {_SLUG_SQL} AS remediation_link FROM o
"""


def q_validation_summary(spark, d):
    return reporting.validation_summary(gate_outcomes(spark, d), include_rules=False)


SQL_VALIDATION_SUMMARY = f"""
WITH o AS ({SQL_GATE_OUTCOMES})
SELECT count(*) AS rule_count, count(*) FILTER (WHERE NOT passed) AS failed_count FROM o
"""


def q_defect_counts(spark, d):
    return reporting.defect_counts(gate_outcomes(spark, d))


SQL_DEFECT_COUNTS = f"""
WITH o AS ({SQL_GATE_OUTCOMES})
SELECT {_ROOT_CAUSE_SQL} AS root_cause, count(*) AS defect_count FROM o WHERE NOT passed GROUP BY 1
"""


def q_release_decision(spark, d):
    r = reporting.release_decision(gate_outcomes(spark, d))
    return r.select("status", "decision_reason",
                    F.concat_ws(",", "blocking_root_causes").alias("blocking_root_causes"),
                    "failed_count", F.size("failed_rules").alias("failed_rule_entries"))


SQL_RELEASE_DECISION = f"""
WITH o AS ({SQL_GATE_OUTCOMES}),
p AS (SELECT *, {_ROOT_CAUSE_SQL} AS root_cause FROM o),
a AS (SELECT count(*) FILTER (WHERE NOT passed) AS failed_count,
             count(*) FILTER (WHERE NOT passed AND severity = 'critical') AS crit,
             (SELECT rule_id FROM p WHERE NOT passed AND severity = 'critical' ORDER BY seq, rule_id LIMIT 1) AS first_crit,
             coalesce(string_agg(DISTINCT root_cause, ',' ORDER BY root_cause) FILTER (WHERE NOT passed AND severity = 'critical'), '') AS causes
      FROM p)
SELECT CASE WHEN crit > 0 THEN 'Blocked' WHEN failed_count > 0 THEN 'Warning only' ELSE 'Ready' END AS status,
       CASE WHEN crit > 0 THEN 'Critical failure ' || first_crit || ' blocks release.'
            WHEN failed_count > 0 THEN 'Warnings or info-level defects were raised; release may proceed with caution.'
            ELSE 'All validations passed; release is ready.' END AS decision_reason,
       CASE WHEN crit > 0 THEN causes ELSE '' END AS blocking_root_causes,
       failed_count, CAST(failed_count AS INTEGER) AS failed_rule_entries FROM a
"""


def q_severity_enrich(spark, d):
    r = reporting.severity_enrich(gate_outcomes(spark, d))
    return r.select("seq", "rule_id", "rule_family", "dimension", "matrix_severity")


def _matrix_sql() -> str:
    rows = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in reporting.SEVERITY_MATRIX)
    return f"(VALUES {rows}) AS m(rule_family, dimension, matrix_severity)"


SQL_SEVERITY_ENRICH = f"""
WITH o AS ({SQL_GATE_OUTCOMES}),
f AS (SELECT seq, rule_id, CASE WHEN len(string_split(rule_id, '-')) > 1
                                THEN array_to_string(string_split(rule_id, '-')[1:2], '-') ELSE rule_id END AS rule_family FROM o)
SELECT f.seq, f.rule_id, f.rule_family, m.dimension, m.matrix_severity
FROM f LEFT JOIN {_matrix_sql()} ON f.rule_family = m.rule_family
"""


# --------------------------------------------------------------------------
# many bundles in one job: each customer segment is a bundle
# --------------------------------------------------------------------------

SEGMENT = "c_mktsegment"


def segment_outcomes(spark, d) -> DataFrame:
    return _segment_outcomes(spark, d)


def _segment_outcomes(spark, d) -> DataFrame:
    cust = table(spark, d, "customer")
    g = [SEGMENT]
    dup = duplicates.detect_duplicates(cust, ["c_name"], "customer-uniqueness-unique-1", group_cols=g)
    rng = business.check_score_range(cust, "c_acctbal", "BR-04-acctbal", -999.99, 9950.0, group_cols=g)
    suite = ex.run_suite(cust, "customer_suite", [ex.between("c_acctbal", 0, None, mostly=0.92)],
                         group_cols=g)
    exp = ex.expectation_outcomes(suite, group_cols=g)
    return union_outcomes([dup, rng, exp], group_cols=g)


def q_gate_status_by_segment(spark, d):
    runs = table(spark, d, "customer").select(SEGMENT)
    return reporting.gate_status(segment_outcomes(spark, d), [SEGMENT], runs=runs)


SQL_GATE_STATUS_BY_SEGMENT = """
WITH dup AS (SELECT c_mktsegment, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS dc
             FROM (SELECT c_mktsegment, c_name, count(*) AS n FROM customer GROUP BY 1, 2) g GROUP BY 1),
rng AS (SELECT c_mktsegment, count(*) FILTER (WHERE c_acctbal < -999.99 OR c_acctbal > 9950.0) AS oor FROM customer GROUP BY 1),
mo AS (SELECT c_mktsegment, count(*) FILTER (WHERE c_acctbal IS NOT NULL) AS nm,
              count(*) FILTER (WHERE c_acctbal IS NOT NULL AND c_acctbal < 0) AS un FROM customer GROUP BY 1),
o AS (SELECT c_mktsegment, dc = 0 AS passed, 'critical' AS severity FROM dup
      UNION ALL SELECT c_mktsegment, oor = 0, CASE WHEN oor = 0 THEN 'info' ELSE 'warning' END FROM rng
      UNION ALL SELECT c_mktsegment,
             CASE WHEN nm > 0 THEN CAST(nm - un AS DOUBLE) / CAST(nm AS DOUBLE) ELSE 1.0 END >= 0.92, 'critical' FROM mo)
SELECT c_mktsegment, count(*) AS rule_count, count(*) FILTER (WHERE NOT passed) AS failed_count,
       count(*) FILTER (WHERE NOT passed AND severity = 'critical') AS critical_failed_count,
       CASE WHEN count(*) FILTER (WHERE NOT passed AND severity = 'critical') > 0 THEN 'Blocked'
            WHEN count(*) FILTER (WHERE NOT passed) > 0 THEN 'Warning only' ELSE 'Ready' END AS status
FROM o GROUP BY c_mktsegment
"""


# --------------------------------------------------------------------------
# contract operators (C1-C10) and the user rule hook
# --------------------------------------------------------------------------

def q_ship_before_order(spark, d):
    r = contract.check_late_master(table(spark, d, "lineitem"), table(spark, d, "orders"),
                                   key="l_orderkey", master_key="o_orderkey",
                                   fact_time="l_shipdate", master_time="o_orderdate",
                                   rule_id="BR-07-late-order")
    return r.select(*CORE, "late_count", "matched_rows")


SQL_SHIP_BEFORE_ORDER = """
WITH m AS (SELECT count(*) FILTER (WHERE o.o_orderdate > l.l_shipdate) AS late_count, count(*) AS matched_rows
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT 'BR-07-late-order' AS rule_id,
       CASE WHEN late_count = 0 THEN 'Master records precede their facts.' ELSE 'Master records were created after their facts.' END AS description,
       late_count = 0 AS passed, CASE WHEN late_count = 0 THEN 'info' ELSE 'warning' END AS severity,
       late_count, matched_rows FROM m
"""


def q_arrival_lag(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    r = contract.check_arrival_lag(j, received_col="l_shipdate", event_col="o_orderdate",
                                   max_hours=24.0, rule_id="BR-08-arrival")
    return r.select(*CORE, "late_rows", "row_count")


SQL_ARRIVAL_LAG = """
WITH m AS (SELECT count(*) FILTER (WHERE CAST(epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate) AS DOUBLE) / 3600000000.0 > 24.0) AS late_rows,
                  count(*) AS row_count
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT 'BR-08-arrival' AS rule_id,
       CASE WHEN late_rows = 0 THEN 'Rows arrive within the allowed lag.' ELSE 'Rows arrive later than the allowed lag.' END AS description,
       late_rows = 0 AS passed, CASE WHEN late_rows = 0 THEN 'info' ELSE 'warning' END AS severity,
       late_rows, row_count FROM m
"""


def _order_intervals(spark, d):
    last_ship = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return o.join(last_ship, o["o_orderkey"] == last_ship["l_orderkey"], "left").drop("l_orderkey")


def q_overlapping_intervals(spark, d):
    r = contract.check_overlapping_intervals(_order_intervals(spark, d), ["o_custkey"], "o_orderdate",
                                             "last_ship", ["o_orderkey"], rule_id="BR-09-orders")
    return r.select(*CORE, "overlap_count", "keys_with_overlap")


SQL_OVERLAPPING_INTERVALS = """
WITH iv AS (SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, l.last_ship FROM orders o
            LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) l
            ON o.o_orderkey = l.l_orderkey WHERE o.o_orderdate IS NOT NULL),
w AS (SELECT o_custkey, o_orderdate,
             max(last_ship) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max_end FROM iv),
k AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderdate < prev_max_end) AS n FROM w GROUP BY o_custkey),
m AS (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS overlap_count, count(*) FILTER (WHERE n > 0) AS keys_with_overlap FROM k)
SELECT 'BR-09-orders' AS rule_id,
       CASE WHEN overlap_count = 0 THEN 'No overlapping status intervals.' ELSE 'Overlapping status intervals found.' END AS description,
       overlap_count = 0 AS passed, 'critical' AS severity, overlap_count, keys_with_overlap FROM m
"""


def q_overlap_partners(spark, d):
    """Every overlapping order with the earlier order of its customer that it overlaps."""
    ov = contract.interval_overlaps(_order_intervals(spark, d), ["o_custkey"], "o_orderdate", "last_ship", ["o_orderkey"])
    return ov.where("overlaps").select("o_custkey", "o_orderkey", F.col("partner.o_orderkey").alias("partner_orderkey"))


SQL_OVERLAP_PARTNERS = """
WITH iv AS (SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, l.last_ship FROM orders o
            LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) l
            ON o.o_orderkey = l.l_orderkey WHERE o.o_orderdate IS NOT NULL),
w AS (SELECT o_custkey, o_orderkey, o_orderdate, max({'e': last_ship, 'k': o_orderkey}) FILTER (WHERE last_ship IS NOT NULL) OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM iv)
SELECT o_custkey, o_orderkey, prev.k AS partner_orderkey FROM w WHERE o_orderdate < prev.e
"""

QUARANTINE_RULES_SQL = [
    ("discount_range", "l_discount < 0.01 OR l_discount > 0.05"),
    ("quantity_range", "l_quantity > 45"),
    ("tax_missing", "l_tax IS NULL"),
    ("return_flag_set", "l_returnflag NOT IN ('A', 'N', 'R')"),
]


def q_quarantine_lineitem(spark, d):
    rules = {name: F.expr(cond) for name, cond in QUARANTINE_RULES_SQL}
    _good, bad = contract.split_quarantine(table(spark, d, "lineitem"), rules)
    return bad.select("l_orderkey", "l_linenumber", F.concat_ws(",", "violations").alias("violations"))


SQL_QUARANTINE_LINEITEM = "SELECT l_orderkey, l_linenumber, violations FROM (SELECT l_orderkey, l_linenumber, concat_ws(',', " + ", ".join(
    f"CASE WHEN coalesce({cond}, false) THEN '{name}' END" for name, cond in QUARANTINE_RULES_SQL) + \
    ") AS violations FROM lineitem) q WHERE violations <> ''"

CUSTOM_RULE_SQL = """
SELECT 'EXTRA-01' AS rule_id, 'Every line item has a positive quantity.' AS description,
       count_if(l_quantity <= 0) = 0 AS passed,
       CASE WHEN count_if(l_quantity <= 0) = 0 THEN 'info' ELSE 'warning' END AS severity,
       CAST(count_if(l_quantity <= 0) AS BIGINT) AS bad_rows
FROM {lineitem}
"""


def q_custom_rule_sql(spark, d):
    r = custom.run_rule(CUSTOM_RULE_SQL, {"lineitem": table(spark, d, "lineitem")}, spark)
    return r.select(*CORE, "bad_rows")


SQL_CUSTOM_RULE_SQL = CUSTOM_RULE_SQL.replace("{lineitem}", "lineitem")

ORDERS_DEFINITION = schema.SchemaDefinition(
    name="orders", file_name="orders.parquet",
    required_columns=("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"),
    dtype_map={"o_orderkey": "Int64", "o_custkey": "Int64", "o_orderstatus": "string",
               "o_totalprice": "float64", "o_orderdate": "datetime64[ns]"},
    parse_dates=("o_orderdate",),
    uniqueness_constraints=(("o_orderkey",), ("o_custkey", "o_orderdate")))


def q_schema_definition_orders(spark, d):
    _typed, outs = schema.apply_schema_definition(table(spark, d, "orders"), ORDERS_DEFINITION)
    return union_outcomes(outs, with_seq=False).select(*CORE)


SQL_SCHEMA_DEFINITION_ORDERS = """
SELECT 'orders-required-columns' AS rule_id, 'All required columns are present.' AS description, true AS passed, 'critical' AS severity
UNION ALL
SELECT rule_id, description, passed, severity FROM (""" + _dup_sql("orders-uniqueness-unique-1", "o_orderkey", "orders") + """) a
UNION ALL
SELECT rule_id, description, passed, severity FROM (""" + _dup_sql("orders-uniqueness-unique-2", "o_custkey, o_orderdate", "orders") + """) b
"""


def q_optional_metadata_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source").join(
        table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    r = contract.check_optional_metadata(docs, ["lang", "quality", "source", "reviewer"])
    return r.select(*CORE, "column", "present", "non_null_count", "row_count", "non_null_ratio")


SQL_OPTIONAL_METADATA_DOCUMENTS = """
WITH j AS (SELECT d.doc_id, d.lang, d.source, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
m AS (SELECT count(*) AS row_count, count(lang) AS nl, count(quality) AS nq, count(source) AS ns FROM j),
r AS (SELECT 'lang' AS "column", true AS present, nl AS non_null_count, row_count FROM m
      UNION ALL SELECT 'quality', true, nq, row_count FROM m
      UNION ALL SELECT 'source', true, ns, row_count FROM m
      UNION ALL SELECT 'reviewer', false, CAST(NULL AS BIGINT), row_count FROM m)
SELECT 'BR-10-' || "column" AS rule_id,
       CASE WHEN coalesce(present AND non_null_count = row_count, false) THEN 'Optional metadata is present.'
            ELSE 'Optional metadata is missing or incomplete.' END AS description,
       coalesce(present AND non_null_count = row_count, false) AS passed, 'info' AS severity,
       "column", present, non_null_count, row_count,
       CASE WHEN row_count > 0 THEN CAST(non_null_count AS DOUBLE) / CAST(row_count AS DOUBLE) END AS non_null_ratio
FROM r
"""


def q_value_set_role(spark, d):
    r = contract.check_value_set(table(spark, d, "conversations"), "role", ["user", "assistant"],
                                 "BR-05-role-set")
    return r.select(*CORE, "unexpected_count")


SQL_VALUE_SET_ROLE = """
WITH m AS (SELECT count(*) FILTER (WHERE role IS NOT NULL AND role NOT IN ('user', 'assistant')) AS unexpected_count FROM conversations)
SELECT 'BR-05-role-set' AS rule_id,
       CASE WHEN unexpected_count = 0 THEN 'All role values are in the allowed set.' ELSE 'role has values outside the allowed set.' END AS description,
       unexpected_count = 0 AS passed, CASE WHEN unexpected_count = 0 THEN 'info' ELSE 'warning' END AS severity,
       unexpected_count FROM m
"""


def q_latest_turn_per_role(spark, d):
    r = contract.keep_latest_per_level(table(spark, d, "conversations"), ["conv_id", "role"], "turn", [])
    return r.select("conv_id", "role", "turn")


SQL_LATEST_TURN_PER_ROLE = """
SELECT conv_id, role, turn FROM (
  SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC NULLS FIRST) AS rn
  FROM conversations) WHERE rn = 1
"""


def q_enrich_latest_status(spark, d):
    latest = integrity.latest_per_key(table(spark, d, "events"), ["user_id"], "ts", ["event_id"])
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    r = integrity.enrich_latest(o, latest, "o_custkey", ["event_type"], latest_key="user_id")
    return r.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("event_type").alias("latest_status"))


SQL_ENRICH_LATEST_STATUS = """
WITH latest AS (
  SELECT user_id, event_type FROM (
    SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
    FROM events) WHERE rn = 1)
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, l.event_type AS latest_status
FROM orders o LEFT JOIN latest l ON o.o_custkey IS NOT DISTINCT FROM l.user_id
"""


def q_dup_document_rows(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return duplicates.duplicate_rows(docs, ["text"], hashed=["text"]).select("doc_id", "source", "dup_count")


SQL_DUP_DOCUMENT_ROWS = """
SELECT d.doc_id, d.source, g.n AS dup_count
FROM documents d JOIN (SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1) g
  ON d.text IS NOT DISTINCT FROM g.text
"""

_SEGMENT_OUTCOMES_SQL = """
WITH dup AS (SELECT c_mktsegment, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS dc
             FROM (SELECT c_mktsegment, c_name, count(*) AS n FROM customer GROUP BY 1, 2) g GROUP BY 1),
rng AS (SELECT c_mktsegment, count(*) FILTER (WHERE c_acctbal < -999.99 OR c_acctbal > 9950.0) AS oor FROM customer GROUP BY 1),
mo AS (SELECT c_mktsegment, count(*) FILTER (WHERE c_acctbal IS NOT NULL) AS nm,
              count(*) FILTER (WHERE c_acctbal IS NOT NULL AND c_acctbal < 0) AS un FROM customer GROUP BY 1),
o AS (SELECT c_mktsegment, 0 AS seq, 'customer-uniqueness-unique-1' AS rule_id, dc = 0 AS passed, 'critical' AS severity FROM dup
      UNION ALL SELECT c_mktsegment, 1, 'BR-04-acctbal', oor = 0, CASE WHEN oor = 0 THEN 'info' ELSE 'warning' END FROM rng
      UNION ALL SELECT c_mktsegment, 2, 'customer_suite-expect_column_values_to_be_between-c_acctbal',
             CASE WHEN nm > 0 THEN CAST(nm - un AS DOUBLE) / CAST(nm AS DOUBLE) ELSE 1.0 END >= 0.92, 'critical' FROM mo),
p AS (SELECT *, """ + _ROOT_CAUSE_SQL + """ AS root_cause FROM o)"""


def q_defect_counts_by_segment(spark, d):
    return reporting.defect_counts(segment_outcomes(spark, d), [SEGMENT])


SQL_DEFECT_COUNTS_BY_SEGMENT = _SEGMENT_OUTCOMES_SQL + """
SELECT c_mktsegment, root_cause, count(*) AS defect_count FROM p WHERE NOT passed GROUP BY 1, 2
"""


def q_release_decision_by_segment(spark, d):
    runs = table(spark, d, "customer").select(SEGMENT)
    r = reporting.release_decision(segment_outcomes(spark, d), [SEGMENT], runs=runs)
    return r.select(SEGMENT, "status", "decision_reason",
                    F.concat_ws(",", "blocking_root_causes").alias("blocking_root_causes"),
                    "failed_count")


SQL_RELEASE_DECISION_BY_SEGMENT = _SEGMENT_OUTCOMES_SQL + """,
a AS (SELECT c_mktsegment, count(*) FILTER (WHERE NOT passed) AS failed_count,
             count(*) FILTER (WHERE NOT passed AND severity = 'critical') AS crit,
             arg_min(rule_id, seq) FILTER (WHERE NOT passed AND severity = 'critical') AS first_crit,
             coalesce(string_agg(DISTINCT root_cause, ',' ORDER BY root_cause)
                      FILTER (WHERE NOT passed AND severity = 'critical'), '') AS causes
      FROM p GROUP BY c_mktsegment)
SELECT c_mktsegment,
       CASE WHEN crit > 0 THEN 'Blocked' WHEN failed_count > 0 THEN 'Warning only' ELSE 'Ready' END AS status,
       CASE WHEN crit > 0 THEN 'Critical failure ' || first_crit || ' blocks release.'
            WHEN failed_count > 0 THEN 'Warnings or info-level defects were raised; release may proceed with caution.'
            ELSE 'All validations passed; release is ready.' END AS decision_reason,
       CASE WHEN crit > 0 THEN causes ELSE '' END AS blocking_root_causes, failed_count
FROM a
"""


def q_root_cause(spark, d):
    return gate_outcomes(spark, d).select("seq", "rule_id", root_cause("rule_id").alias("root_cause"))


SQL_ROOT_CAUSE = f"""
WITH o AS ({SQL_GATE_OUTCOMES})
SELECT seq, rule_id, {_ROOT_CAUSE_SQL} AS root_cause FROM o
"""


def q_slug(spark, d):
    return gate_outcomes(spark, d).select("seq", "rule_id", slugify_rule_id("rule_id").alias("slug"))


SQL_SLUG = f"""
WITH o AS ({SQL_GATE_OUTCOMES})
SELECT seq, rule_id, {_SLUG_SQL} AS slug FROM o
"""


def q_link(spark, d):
    return gate_outcomes(spark, d).select("seq", "rule_id",
                                          remediation_link("rule_id").alias("remediation_link"))


SQL_LINK = f"""
WITH o AS ({SQL_GATE_OUTCOMES})
SELECT seq, rule_id, 'docs/rule-severity-matrix.md#' || {_SLUG_SQL} AS remediation_link FROM o
"""


def q_events_checks_fused(spark, d):
    return q_events_fused(spark, d).select(*CORE)


SQL_EVENTS_CHECKS_FUSED = "\nUNION ALL\n".join(
    f"SELECT rule_id, description, passed, severity FROM ({q}) f{i}"
    for i, q in enumerate([SQL_REQUIRED_KEYS_EVENTS, SQL_DTYPE_AUDIT_EVENTS, SQL_SCORE_RANGE_PROPS,
                           SQL_FRESHNESS_EVENTS]))


# --------------------------------------------------------------------------
# CSV bundles made from given tables
# --------------------------------------------------------------------------

#: Documents of one bundle at most, so that no file outgrows a task.
BUNDLE_IDS = 20_000
_BUNDLE_SQL = f"coalesce(lang, 'und') || '-' || CAST(coalesce(doc_id, 0) // {BUNDLE_IDS} AS VARCHAR)"


def _bundles_root(spark: SparkSession) -> str:
    """A fresh folder for bundles under the checkpoint folder, removed when the session's JVM ends."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/tollgate-bundles/{uuid.uuid4().hex}"
    remove_at_end(spark, root)
    return root


def _document_bundles(spark, d, *columns: str) -> str:
    """Documents as CSV bundles by language and id range: many bounded files, however large a language is."""
    bundle = F.concat_ws("-", F.coalesce("lang", F.lit("und")), F.floor(F.coalesce("doc_id", F.lit(0)) / BUNDLE_IDS).cast("string"))
    rows = table(spark, d, "documents").select(bundle.alias("bundle"), *columns)
    return sinks.write_csv_bundles(rows, _bundles_root(spark), "bundle", "documents")


def q_csv_roundtrip_documents(spark, d):
    """Texts with quotes, commas and line breaks through the CSV source, typed as declared."""
    raw = csv_feeds.read_feed(spark, [f"{_document_bundles(spark, d, 'doc_id', 'source', 'n_chars', 'text')}/*/documents.csv"])
    definition = schema.SchemaDefinition(name="documents", file_name="documents.csv", required_columns=("doc_id", "source", "n_chars", "text"),
                                         dtype_map={"doc_id": "Int64", "source": "string", "n_chars": "Int64", "text": "string"})
    return csv_feeds.typed_view(raw, definition).select("bundle", "doc_id", "source", "n_chars", F.md5(F.col("text")).alias("text_md5"),
                                                        F.col(csv_feeds.SURPLUS_COL).isNotNull().alias("malformed"))


SQL_CSV_ROUNDTRIP_DOCUMENTS = f"""
SELECT {_BUNDLE_SQL} AS bundle, doc_id, source, n_chars, md5(text) AS text_md5, false AS malformed FROM documents
"""


def q_feed_presence_documents(spark, d):
    """Presence of two feeds in every bundle folder, from the listing."""
    root = _document_bundles(spark, d, "doc_id")
    return files.presence_outcomes(spark, root, ["documents.csv", "labels.csv"]).select("bundle", *CORE, "file_name")


SQL_FEED_PRESENCE_DOCUMENTS = f"""
SELECT DISTINCT {_BUNDLE_SQL} AS bundle, f || '-schema-file-present' AS rule_id,
       CASE WHEN f = 'documents' THEN 'Feed file is present.' ELSE 'Feed file is missing.' END AS description,
       f = 'documents' AS passed, 'critical' AS severity, f || '.csv' AS file_name
FROM documents, (SELECT unnest(['documents', 'labels']) AS f)
"""


def q_file_metadata_documents(spark, d):
    """Row count and caller metadata of every bundle's file."""
    raw = csv_feeds.read_feed(spark, [f"{_document_bundles(spark, d, 'doc_id', 'source')}/*/documents.csv"])
    m = files.file_metadata(raw, {"feed": "documents"})
    return m.select("bundle", "feed", "row_count", (F.col("file_size") > 0).alias("has_size"), F.col("modified_at").isNotNull().alias("has_time"))


SQL_FILE_METADATA_DOCUMENTS = f"""
SELECT {_BUNDLE_SQL} AS bundle, 'documents' AS feed, count(*) AS row_count, true AS has_size, true AS has_time FROM documents GROUP BY 1
"""


def q_gate_empty_group(spark, d):
    """Every run reports every rule: runs are documents, checked rows are labels, which many lack."""
    runs = table(spark, d, "documents").select("doc_id").distinct()
    labels = table(spark, d, "labels")
    ranges = fusion.fused(labels, [business.score_range_check(labels, "quality", "BR-04-quality", 0, 0),
                                   business.score_range_check(labels, "toxic", "BR-04-toxic", 0, 1)], ["doc_id"], groups=runs)
    unique = fusion.fill_groups(duplicates.detect_duplicates(labels, ["doc_id", "quality"], "labels-unique", group_cols=["doc_id"]),
                                duplicates.detect_duplicates(labels.where(F.lit(False)), ["doc_id", "quality"], "labels-unique"), runs, ["doc_id"])
    return ranges.select("doc_id", "rule_id", "passed").unionByName(unique.select("doc_id", "rule_id", "passed"))


SQL_GATE_EMPTY_GROUP = """
WITH g AS (SELECT DISTINCT doc_id FROM documents),
m AS (SELECT g.doc_id, count(*) FILTER (WHERE quality <> 0) AS q, count(*) FILTER (WHERE toxic NOT IN (0, 1)) AS t,
             count(l.doc_id) - count(DISTINCT (l.doc_id, quality)) FILTER (WHERE l.doc_id IS NOT NULL) AS dup
      FROM g LEFT JOIN labels l USING (doc_id) GROUP BY g.doc_id)
SELECT doc_id, 'BR-04-quality' AS rule_id, q = 0 AS passed FROM m
UNION ALL SELECT doc_id, 'BR-04-toxic', t = 0 FROM m
UNION ALL SELECT doc_id, 'labels-unique', dup = 0 FROM m
"""


def q_timestamp_text_orders(spark, d):
    """Freshness by timestamps given as text, and the fallback for a group without any."""
    o = table(spark, d, "orders").select("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("received"),
                                         F.lit("2030-01-01 00:00:00").alias("file_time"))
    dated = o.withColumn("received", F.when(F.col("o_orderpriority").startswith("1"), F.lit(None)).otherwise(F.col("received")))
    r = business.evaluate_freshness(dated, reference_ts="2030-01-02T00:00:00Z", timestamp_column="received", file_time_column="file_time", group_cols=["o_orderpriority"])
    return r.select("o_orderpriority", "passed", "severity", "lag_hours", "timestamp_source")


SQL_TIMESTAMP_TEXT_ORDERS = """
WITH m AS (SELECT o_orderpriority, CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE max(date_trunc('second', o_orderdate)) END AS ts FROM orders GROUP BY 1),
l AS (SELECT o_orderpriority, ts, CAST(epoch(TIMESTAMP '2030-01-02 00:00:00' - coalesce(ts, TIMESTAMP '2030-01-01 00:00:00')) AS DOUBLE) / 3600 AS lag FROM m)
SELECT o_orderpriority, lag <= 24 AS passed, CASE WHEN lag <= 24 THEN 'info' WHEN lag <= 48 THEN 'warning' ELSE 'critical' END AS severity,
       round(lag, 2) AS lag_hours, CASE WHEN ts IS NULL THEN 'filesystem' ELSE 'received' END AS timestamp_source FROM l
"""


# --------------------------------------------------------------------------
# the gate over feeds of one's own: documents and labels as bundles
# --------------------------------------------------------------------------

GATE_REFERENCE = "2026-02-10T00:00:00Z"
GATE_FEEDS = (
    schema.SchemaDefinition(
        name="documents", file_name="documents.csv", required_columns=("doc_id", "source", "n_chars", "received"),
        dtype_map={"doc_id": "Int64", "source": "string", "n_chars": "Int64"}, parse_dates=("received",),
        uniqueness_constraints=(("doc_id",), ("source", "n_chars"))),
    # the files have quality before toxic
    schema.SchemaDefinition(
        name="labels", file_name="labels.csv", required_columns=("doc_id", "toxic", "quality"),
        dtype_map={"doc_id": "Int64", "toxic": "Int64", "quality": "Int64"}, uniqueness_constraints=(("doc_id",),)),
)
_GOOD_SOURCES = ("src0", "src1", "src2", "src3", "src4", "src5", "src6", "src7", "src8", "src9")
GATE_RULES = (
    ForeignKey("labels", "documents", "doc_id", "BR-07-labels", "Every label has a document."),
    ForeignKey("documents", "labels", "doc_id", "BR-07b-documents", "Every document has a label."),
    StatusMapping("labels", "documents", "BR-05", {"key": "doc_id", "outcome_col": "quality", "passing": (1,), "failing": (0,), "status_col": "source",
                                                   "ts_col": "received", "tie_cols": ("n_chars",), "certified": _GOOD_SOURCES}),
    Freshness("documents", "received", hours=24, warning_hours=72),
    NumberRange("documents", "n_chars", "BR-04-chars", 0, 5000),
    NumberRange("labels", "toxic", "BR-04-toxic", 0, 0),
    DateWindow("documents", "received", 1, "BR-06"),
    ValueSet("documents", "source", _GOOD_SOURCES, "BR-10-source"),
)
_METRICS = ("mismatch_count", "missing_count", "duplicate_count", "failed_count", "out_of_range_count", "out_of_window", "unexpected_count", "malformed_rows")


def _gate_bundles(spark, d):
    """The gate's report over bundles of up to 5,000 ids each; every 97th receipt date is no date."""
    key = F.concat_ws("-", F.floor(F.col("doc_id") / BUNDLE_IDS).cast("string"), (F.col("doc_id") % 4).cast("string"))
    day = F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 40).cast("int")), "yyyy-MM-dd")
    docs = table(spark, d, "documents").select(key.alias("bundle"), "doc_id", "source", "n_chars",
                                               F.when(F.col("doc_id") % 97 == 0, "no date").otherwise(day).alias("received"))
    root = _bundles_root(spark)
    sinks.write_csv_bundles(docs, root, "bundle", "documents")
    sinks.write_csv_bundles(table(spark, d, "labels").select(key.alias("bundle"), "doc_id", "quality", "toxic"), root, "bundle", "labels")
    rules = RuleSet(definitions=GATE_FEEDS, declared=GATE_RULES, ordered_columns=True)
    return ReleaseGate(spark, GateConfig(data_root=root, reference_ts=GATE_REFERENCE, rules=rules)).run()


def q_gate_bundles(spark, d):
    """Every outcome of the gate, with the count that decided it."""
    detail = lambda k: F.try_element_at("details", F.lit(k)).cast("long")
    return _gate_bundles(spark, d).outcomes.select("bundle", *CORE, F.coalesce(*[detail(k) for k in _METRICS]).alias("metric"))


def q_gate_bundle_orphans(spark, d):
    """The complete orphan list of each foreign key of the gate."""
    return _gate_bundles(spark, d).orphans


def _report_root(spark, d) -> str:
    return _gate_bundles(spark, d).write(_bundles_root(spark))


def q_gate_bundle_decisions(spark, d):
    """Decision and defect reports, read back from their JSON files."""
    root = _report_root(spark, d)
    decided = spark.read.json(f"{root}/release_decision")
    defects = spark.read.json(f"{root}/defect_summary").select("bundle", "defect_count", F.size("defects").cast("long").alias("listed"))
    return decided.join(defects, "bundle").select("bundle", "status", "decision_reason", F.size("failed_rules").cast("long").alias("failed_rules"),
                                                  F.coalesce(F.array_join("blocking_root_causes", ","), F.lit("")).alias("causes"), "defect_count", "listed")


def q_gate_bundle_payload(spark, d):
    """Every rule's payload of the validation report, read back from its JSON files."""
    rows = spark.read.json(f"{_report_root(spark, d)}/validation_summary").select("bundle", "rule_count", "failed_count", F.posexplode("rules").alias("place", "r"))
    return rows.select("bundle", "rule_count", "failed_count", F.col("place").cast("long").alias("place"), "r.rule_id", "r.description", "r.passed", "r.severity",
                       "r.root_cause", "r.remediation_link")


def _gate_rows(rule: str, good: str, bad: str, severity_fail: str, severity_pass: str, metric: str, source: str) -> str:
    """One rule's row of each bundle, from a count that is 0 where it passes."""
    return (f"SELECT bundle, '{rule}' AS rule_id, CASE WHEN {metric} = 0 THEN '{good}' ELSE '{bad}' END AS description, {metric} = 0 AS passed, "
            f"CASE WHEN {metric} = 0 THEN '{severity_pass}' ELSE '{severity_fail}' END AS severity, CAST({metric} AS BIGINT) AS metric FROM {source}")


_SOURCES_SQL = ", ".join(f"'{x}'" for x in _GOOD_SOURCES)
_UNIQUE_TEXT = ("No duplicate rows detected for subset.", "Duplicate rows detected.", "critical", "critical")


def _repeats_sql(tbl: str, keys: str) -> str:
    return (f"(SELECT bundle, coalesce(sum(n) FILTER (WHERE n > 1), 0) AS n FROM (SELECT bundle, {keys}, count(*) AS n FROM {tbl} GROUP BY ALL) GROUP BY bundle) x")


def _orphans_sql(child: str, parent: str) -> str:
    return f"(SELECT DISTINCT c.bundle, c.doc_id FROM {child} c WHERE c.doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.doc_id = c.doc_id AND p.bundle = c.bundle))"


_GATE_CTE = f"""
WITH d0 AS (SELECT CAST(doc_id // {BUNDLE_IDS} AS VARCHAR) || '-' || CAST(doc_id % 4 AS VARCHAR) AS bundle, doc_id, source, n_chars,
    CASE WHEN doc_id % 97 <> 0 THEN DATE '2026-01-01' + CAST(doc_id % 40 AS INTEGER) END AS received FROM documents),
l0 AS (SELECT CAST(doc_id // {BUNDLE_IDS} AS VARCHAR) || '-' || CAST(doc_id % 4 AS VARCHAR) AS bundle, doc_id, quality, toxic FROM labels),
runs AS (SELECT bundle FROM d0 UNION SELECT bundle FROM l0),
hd AS (SELECT DISTINCT bundle FROM d0), hl AS (SELECT DISTINCT bundle FROM l0),
s AS (SELECT bundle, doc_id, source FROM d0 QUALIFY row_number() OVER (PARTITION BY bundle, doc_id ORDER BY received DESC NULLS FIRST, n_chars DESC NULLS FIRST) = 1),
o1 AS {_orphans_sql("l0", "d0")}, o2 AS {_orphans_sql("d0", "l0")},
m AS (SELECT l0.bundle, count(*) FILTER (WHERE quality = 1 AND coalesce(source, '') NOT IN ({_SOURCES_SQL})) AS p,
             count(*) FILTER (WHERE quality = 0 AND coalesce(source, '') IN ({_SOURCES_SQL})) AS f
      FROM l0 LEFT JOIN s ON s.bundle = l0.bundle AND s.doc_id = l0.doc_id GROUP BY l0.bundle),
dm AS (SELECT bundle, count(*) FILTER (WHERE received IS NULL) AS no_date, count(*) FILTER (WHERE n_chars < 0 OR n_chars > 5000) AS chars,
              count(*) FILTER (WHERE received < DATE '2026-01-11' OR received > DATE '2026-02-10') AS late,
              count(*) FILTER (WHERE source NOT IN ({_SOURCES_SQL})) AS src, date_diff('hour', max(received)::TIMESTAMP, TIMESTAMP '2026-02-10') AS lag FROM d0 GROUP BY bundle),
lm AS (SELECT bundle, count(*) FILTER (WHERE toxic <> 0) AS toxic FROM l0 GROUP BY bundle),
o AS (
SELECT bundle, f || '-schema-file-present' AS rule_id, CASE WHEN has THEN 'Feed file is present.' ELSE 'Missing ingest file ' || f || '.csv.' END AS description, has AS passed,
  'critical' AS severity, CAST(NULL AS BIGINT) AS metric
  FROM (SELECT bundle, f, CASE WHEN f = 'documents' THEN bundle IN (SELECT bundle FROM hd) ELSE bundle IN (SELECT bundle FROM hl) END AS has FROM runs, (SELECT unnest(['documents', 'labels']) AS f))
UNION ALL SELECT bundle, f || '-required-columns', 'All required columns are present.', true, 'critical', NULL FROM (SELECT bundle, 'documents' AS f FROM hd UNION ALL SELECT bundle, 'labels' FROM hl)
UNION ALL SELECT bundle, 'documents-schema-ordered-columns', 'Columns match the ordered list.', true, 'critical', NULL FROM hd
UNION ALL SELECT bundle, 'labels-schema-ordered-columns', 'Columns do not match the ordered list.', false, 'critical', NULL FROM hl
UNION ALL SELECT bundle, f || '-schema-malformed-rows', 'Every record fits its header.', true, 'critical', 0 FROM runs, (SELECT unnest(['documents', 'labels']) AS f)
UNION ALL SELECT bundle, 'documents-dtype-received', 'Could not coerce received to datetime64[ns].', false, 'warning', no_date FROM dm WHERE no_date > 0
UNION ALL {_gate_rows("documents-uniqueness-unique-1", *_UNIQUE_TEXT, "coalesce(n, 0)", "runs LEFT JOIN " + _repeats_sql("d0", "doc_id") + " USING (bundle)")}
UNION ALL {_gate_rows("documents-uniqueness-unique-2", *_UNIQUE_TEXT, "coalesce(n, 0)", "runs LEFT JOIN " + _repeats_sql("d0", "source, n_chars") + " USING (bundle)")}
UNION ALL {_gate_rows("labels-uniqueness-unique-1", *_UNIQUE_TEXT, "coalesce(n, 0)", "runs LEFT JOIN " + _repeats_sql("l0", "doc_id") + " USING (bundle)")}
UNION ALL {_gate_rows("BR-07-labels", "Every label has a document.", "Every label has a document. Mismatched candidates found.", "critical", "info", "coalesce(n, 0)",
                      "runs LEFT JOIN (SELECT bundle, count(*) AS n FROM o1 GROUP BY bundle) x USING (bundle)")}
UNION ALL {_gate_rows("BR-07b-documents", "Every document has a label.", "Every document has a label. Mismatched candidates found.", "critical", "info", "coalesce(n, 0)",
                      "runs LEFT JOIN (SELECT bundle, count(*) AS n FROM o2 GROUP BY bundle) x USING (bundle)")}
UNION ALL {_gate_rows("BR-05-pass", "Pass exams should map to Certified statuses.", "Pass exams should map to Certified statuses.", "critical", "info", "coalesce(p, 0)", "runs LEFT JOIN m USING (bundle)")}
UNION ALL {_gate_rows("BR-05-fail", "Fail attempts should not result in Certified statuses.", "Fail attempts should not result in Certified statuses.", "warning", "info", "coalesce(f, 0)", "runs LEFT JOIN m USING (bundle)")}
UNION ALL SELECT bundle, 'BR-08', CASE WHEN lag <= 24 THEN 'Freshness is within allowed lag.' WHEN lag <= 72 THEN 'Freshness crosses warning threshold.' ELSE 'Freshness exceeds the critical lag threshold.' END,
  lag <= 24, CASE WHEN lag <= 24 THEN 'info' WHEN lag <= 72 THEN 'warning' ELSE 'critical' END, NULL FROM dm
UNION ALL {_gate_rows("BR-04-chars", "Column ''n_chars'' stays within 0.0-5000.0.", "Score range violation.", "warning", "info", "coalesce(chars, 0)", "runs LEFT JOIN dm USING (bundle)")}
UNION ALL {_gate_rows("BR-04-toxic", "Column ''toxic'' stays within 0.0-0.0.", "Score range violation.", "warning", "info", "coalesce(toxic, 0)", "runs LEFT JOIN lm USING (bundle)")}
UNION ALL {_gate_rows("BR-06", "Exam dates fall within the rolling 12-month window.", "Exam dates are outside the allowed window.", "warning", "info", "coalesce(late, 0)", "runs LEFT JOIN dm USING (bundle)")}
UNION ALL {_gate_rows("BR-10-source", "All source values are in the allowed set.", "source has values outside the allowed set.", "warning", "info", "coalesce(src, 0)", "runs LEFT JOIN dm USING (bundle)")})
"""
#: Order of evaluation.
_GATE_ORDER = ["documents-schema-file-present", "labels-schema-file-present", "documents-required-columns", "documents-schema-ordered-columns",
               "documents-schema-malformed-rows", "documents-dtype-received", "documents-uniqueness-unique-1", "documents-uniqueness-unique-2",
               "labels-required-columns", "labels-schema-ordered-columns", "labels-schema-malformed-rows", "labels-uniqueness-unique-1", "BR-07-labels",
               "BR-07b-documents", "BR-05-fail", "BR-05-pass", "BR-08", "BR-04-chars", "BR-04-toxic", "BR-06", "BR-10-source"]
_PLACE_SQL = "list_position([" + ", ".join(f"'{r}'" for r in _GATE_ORDER) + "], rule_id)"
SQL_GATE_BUNDLES = _GATE_CTE + "SELECT * FROM o"
SQL_GATE_BUNDLE_ORPHANS = _GATE_CTE + """
SELECT bundle, 'BR-07-labels' AS rule_id, CAST(doc_id AS VARCHAR) AS missing_value FROM o1
UNION ALL SELECT bundle, 'BR-07b-documents', CAST(doc_id AS VARCHAR) FROM o2
"""
SQL_GATE_BUNDLE_DECISIONS = _GATE_CTE + f"""
, p AS (SELECT *, {_ROOT_CAUSE_SQL} AS cause, {_PLACE_SQL} AS place FROM o),
a AS (SELECT bundle, count(*) FILTER (WHERE NOT passed) AS bad, count(*) FILTER (WHERE NOT passed AND severity = 'critical') AS crit,
             arg_min(rule_id, place) FILTER (WHERE NOT passed AND severity = 'critical') AS reason,
             string_agg(DISTINCT cause, ',' ORDER BY cause) FILTER (WHERE NOT passed AND severity = 'critical') AS causes FROM p GROUP BY bundle)
SELECT bundle, CASE WHEN crit > 0 THEN 'Blocked' WHEN bad > 0 THEN 'Warning only' ELSE 'Ready' END AS status,
  CASE WHEN crit > 0 THEN 'Critical failure ' || reason || ' blocks release.' WHEN bad > 0 THEN '{reporting.REASON_WARNING}' ELSE '{reporting.REASON_READY}' END AS decision_reason,
  bad AS failed_rules, coalesce(causes, '') AS causes, bad AS defect_count, bad AS listed FROM a
"""
SQL_GATE_BUNDLE_PAYLOAD = _GATE_CTE + f"""
SELECT bundle, count(*) OVER w AS rule_count, count(*) FILTER (WHERE NOT passed) OVER w AS failed_count,
  row_number() OVER (PARTITION BY bundle ORDER BY {_PLACE_SQL}) - 1 AS place, rule_id, description, passed, severity, {_ROOT_CAUSE_SQL} AS root_cause,
  'docs/rule-severity-matrix.md#' || {_SLUG_SQL} AS remediation_link FROM o WINDOW w AS (PARTITION BY bundle)
"""


def q_repeated_texts_documents(spark, d):
    """The most repeated texts of each source, exactly, by a summary and a recount of what can be among them."""
    docs = table(spark, d, "documents").select("source", F.md5(F.col("text")).alias("text_md5"))
    got = ex.partial_repeats(docs, 0, ex.unique("text_md5"), ["source"])
    return got.select("source", F.posexplode("partial_unexpected_counts").alias("place", "x")).select(
        "source", F.col("place").cast("long").alias("place"), F.col("x.value").alias("text_md5"), F.col("x.count").alias("n"))


SQL_REPEATED_TEXTS_DOCUMENTS = f"""
WITH c AS (SELECT source, md5(text) AS text_md5, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, text_md5) - 1 AS place FROM c)
SELECT source, place, text_md5, n FROM r WHERE place < {ex.PARTIAL_LIST_SIZE}
"""


def q_frequent_prices_lineitem(spark, d):
    """The most frequent unexpected values of a column with many distinct ones."""
    low = ex.between("l_extendedprice", None, 0)
    got = ex.partial_unexpected(table(spark, d, "lineitem"), [(0, low)], {}, ["l_returnflag"])
    return got.select("l_returnflag", F.posexplode("partial_unexpected_counts").alias("place", "x")).select(
        "l_returnflag", F.col("place").cast("long").alias("place"), F.col("x.value").cast("double").alias("price"), F.col("x.count").alias("n"))


SQL_FREQUENT_PRICES_LINEITEM = f"""
WITH c AS (SELECT l_returnflag, l_extendedprice AS price, count(*) AS n FROM lineitem WHERE l_extendedprice > 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, CAST(price AS VARCHAR)) - 1 AS place FROM c)
SELECT l_returnflag, place, price, n FROM r WHERE place < {ex.PARTIAL_LIST_SIZE}
"""


def q_fk_presets(spark, d):
    """The three foreign key presets over data with orphans: documents against labels."""
    docs, labels = (table(spark, d, n).select(F.col("doc_id").alias("candidate_id")) for n in ("documents", "labels"))
    return union_outcomes([integrity.check_exam_candidate_fk(docs, labels), integrity.check_cert_candidate_fk(docs, labels),
                           contract.check_flag_candidate_fk(docs, labels)]).select(
        "seq", *CORE, F.col("details")["missing_count"].cast("long").alias("missing_count"), F.col("details")["sample_values"].alias("sample_values"))


_PRESETS = (("BR-07", "Every exam candidate_id exists in the master list."), ("BR-07b", "Every certification row references a known candidate."),
            ("BR-07c", "Every disciplinary flag references a known candidate."))
SQL_FK_PRESETS = f"""
WITH o AS (SELECT DISTINCT doc_id FROM documents d WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)),
m AS (SELECT count(*) AS missing_count FROM o),
v AS (SELECT '[' || coalesce(string_agg('"' || doc_id || '"', ', ' ORDER BY doc_id), '') || ']' AS sample_values FROM (SELECT doc_id FROM o ORDER BY doc_id LIMIT 20)),
r AS (SELECT unnest([{", ".join(f"{{'seq': {i}, 'rule_id': '{r}', 'text': '{t}'}}" for i, (r, t) in enumerate(_PRESETS))}], recursive := true))
SELECT seq, rule_id, text || CASE WHEN missing_count = 0 THEN '' ELSE ' Mismatched candidates found.' END AS description, missing_count = 0 AS passed,
  CASE WHEN missing_count = 0 THEN 'info' ELSE 'critical' END AS severity, missing_count, sample_values FROM r, m, v
"""


def q_fk_documents_labels_orphans(spark, d):
    """The complete list of documents without a label."""
    return integrity.orphan_details(integrity.orphan_keys(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id"), "documents-labels-fk")


SQL_FK_DOCUMENTS_LABELS_ORPHANS = """
SELECT DISTINCT 'documents-labels-fk' AS rule_id, CAST(doc_id AS VARCHAR) AS missing_value FROM documents d
WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""


# --------------------------------------------------------------------------
# registry: name -> (spark query, oracle SQL or None)
# --------------------------------------------------------------------------

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "dup_lineitem_key": (q_dup_lineitem_key, SQL_DUP_LINEITEM_KEY),
    "dup_document_text": (q_dup_document_text, SQL_DUP_DOCUMENT_TEXT),
    "uniqueness_multi": (q_uniqueness_multi, SQL_UNIQUENESS_MULTI),
    "required_keys_events": (q_required_keys_events, SQL_REQUIRED_KEYS_EVENTS),
    "dtype_audit_events": (q_dtype_audit_events, SQL_DTYPE_AUDIT_EVENTS),
    "dtype_normalize_events": (q_dtype_normalize_events, SQL_DTYPE_NORMALIZE_EVENTS),
    "fk_orders_customer": (q_fk_orders_customer, SQL_FK_ORDERS_CUSTOMER),
    "fk_orders_customer_orphans": (q_fk_orders_customer_orphans, SQL_FK_ORDERS_CUSTOMER_ORPHANS),
    "fk_documents_labels": (q_fk_documents_labels, SQL_FK_DOCUMENTS_LABELS),
    "not_null_quality": (q_not_null_quality, SQL_NOT_NULL_QUALITY),
    "range_discount": (q_range_discount, SQL_RANGE_DISCOUNT),
    "in_set_priority": (q_in_set_priority, SQL_IN_SET_PRIORITY),
    "param_range_shipdate": (q_param_range_shipdate, SQL_PARAM_RANGE_SHIPDATE),
    "score_range_props": (q_score_range_props, SQL_SCORE_RANGE_PROPS),
    "date_window_orders": (q_date_window_orders, SQL_DATE_WINDOW_ORDERS),
    "latest_event_per_user": (q_latest_event_per_user, SQL_LATEST_EVENT_PER_USER),
    "status_mapping": (q_status_mapping, SQL_STATUS_MAPPING),
    "status_mapping_sample": (q_status_mapping_sample, SQL_STATUS_MAPPING_SAMPLE),
    "freshness_by_type": (q_freshness_by_type, SQL_FRESHNESS_BY_TYPE),
    "freshness_events": (q_freshness_events, SQL_FRESHNESS_EVENTS),
    "expectation_results": (q_expectation_results, SQL_EXPECTATION_RESULTS),
    "suite_stats": (q_suite_stats, SQL_SUITE_STATS),
    "partial_unexpected_priority": (q_partial_unexpected_priority, SQL_PARTIAL_UNEXPECTED_PRIORITY),
    "outcome_payload": (q_outcome_payload, SQL_OUTCOME_PAYLOAD),
    "validation_summary": (q_validation_summary, SQL_VALIDATION_SUMMARY),
    "defect_counts": (q_defect_counts, SQL_DEFECT_COUNTS),
    "release_decision": (q_release_decision, SQL_RELEASE_DECISION),
    "severity_enrich": (q_severity_enrich, SQL_SEVERITY_ENRICH),
    "gate_status_by_segment": (q_gate_status_by_segment, SQL_GATE_STATUS_BY_SEGMENT),
    "ship_before_order": (q_ship_before_order, SQL_SHIP_BEFORE_ORDER),
    "arrival_lag": (q_arrival_lag, SQL_ARRIVAL_LAG),
    "overlapping_intervals": (q_overlapping_intervals, SQL_OVERLAPPING_INTERVALS),
    "overlap_partners": (q_overlap_partners, SQL_OVERLAP_PARTNERS),
    "quarantine_lineitem": (q_quarantine_lineitem, SQL_QUARANTINE_LINEITEM),
    "custom_rule_sql": (q_custom_rule_sql, SQL_CUSTOM_RULE_SQL),
    "schema_definition_orders": (q_schema_definition_orders, SQL_SCHEMA_DEFINITION_ORDERS),
    "optional_metadata_documents": (q_optional_metadata_documents, SQL_OPTIONAL_METADATA_DOCUMENTS),
    "value_set_role": (q_value_set_role, SQL_VALUE_SET_ROLE),
    "latest_turn_per_role": (q_latest_turn_per_role, SQL_LATEST_TURN_PER_ROLE),
    "enrich_latest_status": (q_enrich_latest_status, SQL_ENRICH_LATEST_STATUS),
    "dup_document_rows": (q_dup_document_rows, SQL_DUP_DOCUMENT_ROWS),
    "defect_counts_by_segment": (q_defect_counts_by_segment, SQL_DEFECT_COUNTS_BY_SEGMENT),
    "release_decision_by_segment": (q_release_decision_by_segment, SQL_RELEASE_DECISION_BY_SEGMENT),
    "root_cause": (q_root_cause, SQL_ROOT_CAUSE),
    "slug": (q_slug, SQL_SLUG),
    "link": (q_link, SQL_LINK),
    "events_checks_fused": (q_events_checks_fused, SQL_EVENTS_CHECKS_FUSED),
    "fk_events_customer": (q_fk_events_customer, SQL_FK_EVENTS_CUSTOMER),
    "fk_events_customer_orphans": (q_fk_events_customer_orphans, SQL_FK_EVENTS_CUSTOMER_ORPHANS),
    "csv_roundtrip_documents": (q_csv_roundtrip_documents, SQL_CSV_ROUNDTRIP_DOCUMENTS),
    "feed_presence_documents": (q_feed_presence_documents, SQL_FEED_PRESENCE_DOCUMENTS),
    "file_metadata_documents": (q_file_metadata_documents, SQL_FILE_METADATA_DOCUMENTS),
    "gate_empty_group": (q_gate_empty_group, SQL_GATE_EMPTY_GROUP),
    "gate_bundles": (q_gate_bundles, SQL_GATE_BUNDLES),
    "gate_bundle_orphans": (q_gate_bundle_orphans, SQL_GATE_BUNDLE_ORPHANS),
    "gate_bundle_decisions": (q_gate_bundle_decisions, SQL_GATE_BUNDLE_DECISIONS),
    "gate_bundle_payload": (q_gate_bundle_payload, SQL_GATE_BUNDLE_PAYLOAD),
    "repeated_texts_documents": (q_repeated_texts_documents, SQL_REPEATED_TEXTS_DOCUMENTS),
    "frequent_prices_lineitem": (q_frequent_prices_lineitem, SQL_FREQUENT_PRICES_LINEITEM),
    "fk_presets": (q_fk_presets, SQL_FK_PRESETS),
    "fk_documents_labels_orphans": (q_fk_documents_labels_orphans, SQL_FK_DOCUMENTS_LABELS_ORPHANS),
    "timestamp_text_orders": (q_timestamp_text_orders, SQL_TIMESTAMP_TEXT_ORDERS),
}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Gated outcome rows of the lineitem key check: payload + gate status."""
    flat = duplicates.detect_duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                                        "lineitem-uniqueness-unique-1")
    out = reporting.with_payload(to_outcomes(flat))
    status = reporting.gate_status(out).select("status")
    return out.select("*", status.scalar().alias("gate_status"))
