"""The feed expectation suites and their checkpoint, over many bundles.

Four suites (candidates, exam results, certification status, freshness) run
as one checkpoint; the exam table is validated twice (its own suite and the
freshness suite). Evaluation parameters (min/max of exam dates and receipt
times) are computed **per bundle** with one small aggregation and joined on
the bundle key (one row per bundle), so each bundle is checked against its
own bounds. ``params_source`` lets the bounds come from a different table
than the one checked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import expectations as ex
from ..operators.schema import ordered_columns_by_file
from ..sources.csv_feeds import BUNDLE_COL

G = (BUNDLE_COL,)

# The four expectation suites of the certification feeds.
SUITES: dict[str, list[dict]] = {
    "candidates_suite": [
        {"expectation_type": "expect_table_columns_to_match_ordered_list",
         "kwargs": {"column_list": ["candidate_id", "birth_date", "email", "first_name",
                                    "last_name", "created_ts", "source_system"]}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "candidate_id"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "email"}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "candidate_id"}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "email"}},
    ],
    "exam_results_suite": [
        {"expectation_type": "expect_table_columns_to_match_ordered_list",
         "kwargs": {"column_list": ["exam_result_id", "candidate_id", "exam_code", "exam_date",
                                    "attempt_number", "score", "score_scaled", "pass_fail",
                                    "exam_location", "file_received_ts"]}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "exam_result_id"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "candidate_id"}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "exam_result_id"}},
        {"expectation_type": "expect_compound_columns_to_be_unique",
         "kwargs": {"column_list": ["candidate_id", "exam_code", "attempt_number"]}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "score", "min_value": 0, "max_value": 100}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "score_scaled", "min_value": 0, "max_value": 100}},
        {"expectation_type": "expect_column_values_to_be_in_set",
         "kwargs": {"column": "pass_fail", "value_set": ["Pass", "Fail", "P", "F", "pass", "fail"]}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "exam_date", "min_value": "$PARAMETER.min_exam_date",
                    "max_value": "$PARAMETER.max_exam_date"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "file_received_ts"}},
    ],
    "cert_status_suite": [
        {"expectation_type": "expect_table_columns_to_match_ordered_list",
         "kwargs": {"column_list": ["cert_status_id", "candidate_id", "certification_level",
                                    "certification_status", "certified_ts", "status_source",
                                    "status_effective_ts"]}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "cert_status_id"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "candidate_id"}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "cert_status_id"}},
        {"expectation_type": "expect_compound_columns_to_be_unique",
         "kwargs": {"column_list": ["candidate_id", "certification_level"]}},
        {"expectation_type": "expect_column_values_to_be_in_set",
         "kwargs": {"column": "certification_status",
                    "value_set": ["Certified", "Certification Granted", "NeedsReview",
                                  "Certification Pending", "Not Certified"]}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "certification_level"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "certification_status"}},
    ],
    "freshness_suite": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "file_received_ts"}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "file_received_ts", "min_value": "$PARAMETER.min_file_received_ts",
                    "max_value": "$PARAMETER.max_file_received_ts"}},
    ],
}

# Fixed values: (feed, suite, batch identifier) pairs of the checkpoint.
VALIDATIONS = (
    ("candidates", "candidates_suite", "candidates"),
    ("exam_results", "exam_results_suite", "exams"),
    ("certification_status", "cert_status_suite", "certifications"),
    ("exam_results", "freshness_suite", "freshness"),
)

# Evaluation parameters: name -> (feed, column, aggregate).
PARAMETERS = {
    "min_exam_date": ("exam_results", "exam_date", "min"),
    "max_exam_date": ("exam_results", "exam_date", "max"),
    "min_file_received_ts": ("exam_results", "file_received_ts", "min"),
    "max_file_received_ts": ("exam_results", "file_received_ts", "max"),
}


def bundle_parameters(tables: Mapping[str, DataFrame],
                      parameters: Mapping[str, tuple[str, str, str]] = PARAMETERS) -> dict[str, DataFrame]:
    """Per feed: one row per bundle with that feed's parameters as columns."""
    by_feed: dict[str, list] = {}
    for name, (feed, col, fn) in parameters.items():
        agg = F.min(col) if fn == "min" else F.max(col)
        by_feed.setdefault(feed, []).append(agg.alias(f"__p_{name}"))
    return {feed: tables[feed].groupBy(BUNDLE_COL).agg(*aggs) for feed, aggs in by_feed.items()}


def run_feed_checkpoint(tables: Mapping[str, DataFrame], headers: Mapping[str, DataFrame],
                        run_name: str | None = None,
                        validations: Sequence[tuple[str, str, str]] = VALIDATIONS,
                        suites: Mapping[str, list[dict]] = SUITES,
                        params_source: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Expectation results per (bundle, batch, expectation) for all validations.

    A feed that several suites check is scanned once: its bounds are joined to
    it once, and all its suites share the pass.
    """
    ptables = bundle_parameters(params_source or tables)
    parsed = [(feed, suite, batch, [ex.from_config(c) for c in suites[suite]]) for feed, suite, batch in validations]
    params: dict = {}
    joined: dict[str, DataFrame] = {}
    for feed in dict.fromkeys(v[0] for v in parsed):
        uses = {p.name for f, _, _, exps in parsed if f == feed for e in exps for p in (e.min_value, e.max_value) if isinstance(p, ex.Param)}
        df = tables[feed]
        for pt in ptables.values():
            names = [c for c in pt.columns if c.startswith("__p_") and c[4:] in uses]
            if names:  # one row per bundle: a bounded, key-partitioned lookup table
                df = df.join(pt.select(BUNDLE_COL, *names), BUNDLE_COL, "left")
                params.update({n[4:]: F.col(n) for n in names})
        joined[feed] = df
    values = [(batch, joined[feed], suite, [None if e.expectation_type == ex._ORDERED else e for e in exps]) for feed, suite, batch, exps in parsed]
    out = ex.run_checkpoint(values, params, group_cols=G)
    for feed, suite, batch, exps in parsed:
        for i, e in enumerate(exps):
            if e.expectation_type == ex._ORDERED:  # from the file's header, not the frame's columns
                out = out.unionByName(_ordered_results(headers[feed], suite, i, e).withColumn("batch_identifier", F.lit(batch)), allowMissingColumns=True)
    if run_name is not None:
        out = out.withColumn("run_name", F.lit(run_name))
    return out


def _ordered_results(headers: DataFrame, suite: str, index: int, e: ex.Expectation) -> DataFrame:
    r = ordered_columns_by_file(headers, e.column_list, "ordered", group_cols=G)
    return r.select(BUNDLE_COL, F.lit(suite).alias("suite"), F.lit(index).alias("expectation_index"),
                    F.lit(e.expectation_type).alias("expectation_type"),
                    F.lit(e.column_name).alias("column_name"), F.col("passed").alias("success"),
                    F.lit(True).alias("bounds_resolved"))
