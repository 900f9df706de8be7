"""Business rules: outcome->status mapping, freshness, score range, date window.

The status mapping is planned key-first: the fact table (exam rows) is
aggregated to one row per candidate key *before* it meets the latest-status
table, so the join is between two key-sized frames and a candidate holding a
third of all exam rows never forms a skewed join partition. Because the
latest status is a property of the key, every pass (fail) row of a key is an
offender or none is, so per-key counts are exact.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import coerce_timestamp, hours_between, strict_double
from ..outcome import CRITICAL, INFO, WARNING
from .fusion import AggCheck, Row, run_flat
from .integrity import first_n, latest_per_key

# Outcome vocabularies of the exam and certification feeds.
PASSING_VALUES = ("Pass", "pass", "P")
FAILING_VALUES = ("Fail", "fail", "F")
CERTIFIED_STATUSES = ("Certified", "Certification Granted")
FAIL_ALLOWED_STATUSES = ("NeedsReview", "Certification Pending", "Not Certified")

SAMPLE_SIZE = 5


def _ts_lit(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return F.lit(value.isoformat(sep=" ")).cast("timestamp")
    if isinstance(value, _dt.date):
        return F.lit(value.isoformat()).cast("timestamp")
    return coerce_timestamp(F.lit(str(value)))


def status_mapping_keys(exam: DataFrame, cert: DataFrame, *, key: str = "candidate_id",
                        cert_key: str | None = None, outcome_col: str = "pass_fail",
                        status_col: str = "certification_status",
                        ts_col: str = "status_effective_ts", tie_cols: Sequence[str] = (),
                        order_col: str | None = None, passing=PASSING_VALUES,
                        failing=FAILING_VALUES, certified=CERTIFIED_STATUSES,
                        group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per (group, key): pass/fail row counts, first row order, latest status."""
    cert_key = cert_key or key
    oc = F.col(f"`{outcome_col}`")
    order = F.col(f"`{order_col or key}`")
    is_pass, is_fail = oc.isin(list(passing)), oc.isin(list(failing))
    per_key = exam.groupBy(*group_cols, F.col(f"`{key}`").alias("key")).agg(
        F.count_if(is_pass).alias("n_pass"),
        F.count_if(is_fail).alias("n_fail"),
        F.min(F.when(is_pass, order)).alias("first_pass"),
        F.min(F.when(is_fail, order)).alias("first_fail"),
    ).where((F.col("n_pass") > 0) | (F.col("n_fail") > 0))
    latest = latest_per_key(cert.select(*group_cols, F.col(f"`{cert_key}`").alias("key"),
                                        F.col(f"`{status_col}`").alias("status"),
                                        F.col(f"`{ts_col}`").alias("__ts"),
                                        *[F.col(f"`{t}`") for t in tie_cols]),
                            [*group_cols, "key"], "__ts", tie_cols).select(
        *group_cols, F.col("key").alias("__k"), "status")
    cond = [per_key["key"].eqNullSafe(latest["__k"])]
    cond += [per_key[g] == latest[g] for g in group_cols]
    j = per_key.join(latest, cond, "left").select(
        *[per_key[g] for g in group_cols], per_key["key"], "n_pass", "n_fail",
        "first_pass", "first_fail", "status")
    status = F.coalesce(F.col("status"), F.lit(""))
    is_cert = status.isin(list(certified))
    return j.select(
        *group_cols, "key", "n_pass", "n_fail", "first_pass", "first_fail", "status",
        F.when(~is_cert, F.col("n_pass")).otherwise(0).alias("pass_mismatch"),
        F.when(F.col("status").isNull(), F.col("n_pass")).otherwise(0).alias("pass_missing"),
        F.when(is_cert, F.col("n_fail")).otherwise(0).alias("fail_mismatch"))


def check_pass_fail_certification(exam: DataFrame, cert: DataFrame, rule_id_prefix: str = "BR-05",
                                  *, sample_size: int = SAMPLE_SIZE,
                                  group_cols: Sequence[str] = (), groups: DataFrame | None = None,
                                  **kw) -> DataFrame:
    """Two flat outcome rows per group: ``{prefix}-pass`` and ``{prefix}-fail``.

    Columns: mismatch_count, missing_count (pass side only; missing is a
    subset of mismatch), allowed_fail_statuses (fail side only),
    sample_candidates (first ``sample_size`` offending keys in ``order_col``
    order). ``groups`` (a row per group) makes groups without rows report, too.
    """
    # The per-key frame feeds the totals and both samples through one exchange
    # (key-sized), so the fact table is scanned and shuffled a single time.
    keys = status_mapping_keys(exam, cert, group_cols=group_cols, **kw).repartition(*group_cols, "key")
    tot = keys.groupBy(*group_cols).agg(
        F.coalesce(F.sum("pass_mismatch"), F.lit(0)).cast("long").alias("pass_mismatch_count"),
        F.coalesce(F.sum("pass_missing"), F.lit(0)).cast("long").alias("pass_missing_count"),
        F.coalesce(F.sum("fail_mismatch"), F.lit(0)).cast("long").alias("fail_mismatch_count"))
    if groups is not None:
        tot = groups.select(*group_cols).join(tot, list(group_cols), "left").na.fill(0)
    pass_id, fail_id = f"{rule_id_prefix}-pass", f"{rule_id_prefix}-fail"
    pass_failed = (F.col("pass_mismatch_count") > 0) | (F.col("pass_missing_count") > 0)
    fail_failed = F.col("fail_mismatch_count") > 0
    rows = tot.select(*group_cols, F.inline(F.array(
        F.struct(F.lit(pass_id).alias("rule_id"),
                 F.lit("Pass exams should map to Certified statuses.").alias("description"),
                 (~pass_failed).alias("passed"),
                 F.when(pass_failed, F.lit(CRITICAL)).otherwise(F.lit(INFO)).alias("severity"),
                 F.col("pass_mismatch_count").alias("mismatch_count"),
                 F.col("pass_missing_count").alias("missing_count"),
                 F.lit(None).cast("array<string>").alias("allowed_fail_statuses")),
        F.struct(F.lit(fail_id).alias("rule_id"),
                 F.lit("Fail attempts should not result in Certified statuses.").alias("description"),
                 (~fail_failed).alias("passed"),
                 F.when(fail_failed, F.lit(WARNING)).otherwise(F.lit(INFO)).alias("severity"),
                 F.col("fail_mismatch_count").alias("mismatch_count"),
                 F.lit(None).cast("long").alias("missing_count"),
                 F.array(*[F.lit(x) for x in FAIL_ALLOWED_STATUSES]).alias("allowed_fail_statuses")))))
    # Samples are attached ABOVE the counts: a consumer that does not read
    # them lets Catalyst prune the top-k plans entirely.
    ps = first_n(keys.where(F.col("pass_mismatch") > 0), ["first_pass", "key"], sample_size,
                 F.col("key").cast("string"), group_cols, "pass_sample")
    fs = first_n(keys.where(F.col("fail_mismatch") > 0), ["first_fail", "key"], sample_size,
                 F.col("key").cast("string"), group_cols, "fail_sample")
    empty = F.array().cast("array<string>")
    if group_cols:
        samples = ps.join(fs, list(group_cols), "full")
        rows = rows.join(samples, list(group_cols), "left")
        pick = F.when(F.col("rule_id") == pass_id, F.col("pass_sample")).otherwise(F.col("fail_sample"))
    else:
        pick = F.when(F.col("rule_id") == pass_id, ps.scalar()).otherwise(fs.scalar())
    return rows.select(*group_cols, "rule_id", "description", "passed", "severity",
                       "mismatch_count", "missing_count", "allowed_fail_statuses",
                       F.coalesce(pick, empty).alias("sample_candidates"))


def freshness_check(df: DataFrame, *, reference_ts, timestamp_column: str | None = None,
                    metadata_columns: Sequence[str] = (), file_time_column: str | None = None,
                    max_allowed_hours: float = 24, warning_hours: float | None = None,
                    rule_id: str = "BR-08",
                    thresholds: Mapping[str, tuple[float, float]] | None = None,
                    threshold_key: str | None = None) -> AggCheck:
    """Freshness as a single-pass check.

    latest data time = newest of max(timestamp_column) and the metadata
    columns (nulls skipped); if none exists, the newest file modification
    time (``timestamp_source = 'filesystem'``). lag = max(0, ref - latest) in
    hours; <= max -> info/pass, <= warning (default 2 x max) -> warning, else
    critical. ``thresholds`` maps a group value (``threshold_key``, a group
    column) to (max, warning) hours, for per-feed limits.
    """
    cols = set(df.columns)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    meta = [c for c in metadata_columns if c in cols and c != timestamp_column]
    has_col = bool(timestamp_column and timestamp_column in cols)
    default_warn = float(warning_hours if warning_hours is not None else 2 * max_allowed_hours)

    def build(p: str):
        aggs = []
        if has_col:
            aggs.append(F.max(coerce_timestamp(F.col(f"`{timestamp_column}`"),
                                               dtypes[timestamp_column])).alias(f"{p}col"))
        for i, c in enumerate(meta):
            aggs.append(F.max(coerce_timestamp(F.col(f"`{c}`"), dtypes[c])).alias(f"{p}meta{i}"))
        if file_time_column:
            aggs.append(F.max(F.col(file_time_column).cast("timestamp")).alias(f"{p}file"))
        reported = ([F.col(f"{p}col")] if has_col else []) + [F.col(f"{p}meta{i}") for i in range(len(meta))]
        data_ts = (F.greatest(*reported) if len(reported) > 1 else reported[0]) if reported \
            else F.lit(None).cast("timestamp")
        fallback = F.col(f"{p}file") if file_time_column else F.lit(None).cast("timestamp")
        latest = F.coalesce(data_ts, fallback)
        label = F.when(data_ts.isNotNull(), F.lit(timestamp_column or "metadata")).when(
            fallback.isNotNull(), F.lit("filesystem"))
        ref = _ts_lit(reference_ts)
        lag = F.when(latest.isNotNull(), F.greatest(F.lit(0.0), hours_between(ref, latest)))
        if thresholds:
            tk = F.col(threshold_key).cast("string")
            mx_map = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v[0])))])
            wn_map = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v[1])))])
            mx = F.coalesce(F.try_element_at(mx_map, tk), F.lit(float(max_allowed_hours)))
            wn = F.coalesce(F.try_element_at(wn_map, tk), F.lit(default_warn))
        else:
            mx, wn = F.lit(float(max_allowed_hours)), F.lit(default_warn)
        # No data time at all: nothing proves freshness, so it is critical.
        ok = lag.isNotNull() & (lag <= mx)
        warn = lag.isNotNull() & (lag <= wn)
        row = Row(F.lit(rule_id),
                  F.when(ok, F.lit("Freshness is within allowed lag."))
                  .when(warn, F.lit("Freshness crosses warning threshold."))
                  .otherwise(F.lit("Freshness exceeds the critical lag threshold.")),
                  ok, F.when(ok, F.lit(INFO)).when(warn, F.lit(WARNING)).otherwise(F.lit(CRITICAL)),
                  {"lag_hours": F.round(lag, 2), "lag_hours_exact": lag, "reference_time": ref,
                   "latest_data_time": latest, "timestamp_source": label,
                   "max_allowed_hours": mx, "warning_hours": wn})
        return aggs, [row]
    defaults = {f"meta{i}": c for i, c in enumerate(meta)}
    return AggCheck(build, {**defaults, "file": file_time_column} if file_time_column else defaults)


def evaluate_freshness(df: DataFrame, *, reference_ts, timestamp_column: str | None = None,
                       metadata_columns: Sequence[str] = (), file_time_column: str | None = None,
                       max_allowed_hours: float = 24, warning_hours: float | None = None,
                       rule_id: str = "BR-08", group_cols: Sequence[str] = (),
                       thresholds: Mapping[str, tuple[float, float]] | None = None,
                       threshold_key: str | None = None) -> DataFrame:
    """Flat freshness outcome per group (see ``freshness_check``)."""
    if thresholds and threshold_key is None:
        threshold_key = group_cols[0]
    chk = freshness_check(df, reference_ts=reference_ts, timestamp_column=timestamp_column,
                          metadata_columns=metadata_columns, file_time_column=file_time_column,
                          max_allowed_hours=max_allowed_hours, warning_hours=warning_hours,
                          rule_id=rule_id, thresholds=thresholds, threshold_key=threshold_key)
    return run_flat(df, chk, group_cols)


def score_range_check(df: DataFrame, column: str, rule_id: str, min_value: float = 0.0,
                      max_value: float = 100.0, value: Column | None = None) -> AggCheck:
    """Counts non-null unparseable values and parsed values outside [min, max].

    ``value`` overrides the raw column (e.g. a JSON field of a text column).
    A missing column is reported as a failed outcome instead of an error.
    """
    lo, hi = float(min_value), float(max_value)
    missing = value is None and column not in df.columns

    def build(p: str):
        if missing:
            return [], [Row(F.lit(rule_id), F.lit(f"Column '{column}' is missing."), F.lit(False),
                            F.lit(WARNING), {"invalid_format_count": F.lit(None).cast("long"),
                                             "out_of_range_count": F.lit(None).cast("long"),
                                             "column": F.lit(column)})]
        raw = value if value is not None else F.col(f"`{column}`")
        dtype = None if value is not None else {f.name: f.dataType for f in df.schema.fields}[column]
        n = strict_double(raw, dtype)
        aggs = [F.count_if(raw.isNotNull() & n.isNull()).alias(f"{p}invalid"),
                F.count_if((n < F.lit(lo)) | (n > F.lit(hi))).alias(f"{p}oor")]
        inv, oor = F.col(f"{p}invalid"), F.col(f"{p}oor")
        ok = (inv == 0) & (oor == 0)
        return aggs, [Row(F.lit(rule_id),
                          F.when(ok, F.lit(f"Column '{column}' stays within {lo}-{hi}."))
                          .otherwise(F.lit("Score range violation.")),
                          ok, F.when(ok, F.lit(INFO)).otherwise(F.lit(WARNING)),
                          {"invalid_format_count": inv, "out_of_range_count": oor,
                           "column": F.lit(column)})]
    return AggCheck(build)


def check_score_range(df: DataFrame, column: str, rule_id: str, min_value: float = 0.0,
                      max_value: float = 100.0, group_cols: Sequence[str] = (),
                      value: Column | None = None) -> DataFrame:
    """Flat form of ``score_range_check``."""
    return run_flat(df, score_range_check(df, column, rule_id, min_value, max_value, value),
                    group_cols)


def date_window_check(df: DataFrame, reference_date, months: int = 12, rule_id: str = "BR-06",
                      column: str = "exam_date") -> AggCheck:
    """Dates outside [ref - int(30.5*months) days, ref]; null dates never violate."""
    window_days = int(30.5 * months)
    dtype = {f.name: f.dataType for f in df.schema.fields}.get(column)

    def build(p: str):
        ref = _ts_lit(reference_date)
        start = ref - F.make_dt_interval(F.lit(window_days))
        # An absent column has no dates, and null dates never violate.
        d = (coerce_timestamp(F.col(f"`{column}`"), dtype) if dtype is not None
             else F.lit(None).cast("timestamp"))
        aggs = [F.count_if((d < start) | (d > ref)).alias(f"{p}out")]
        out = F.col(f"{p}out")
        ok = out == 0
        return aggs, [Row(F.lit(rule_id),
                          F.when(ok, F.lit("Exam dates fall within the rolling 12-month window."))
                          .otherwise(F.lit("Exam dates are outside the allowed window.")),
                          ok, F.when(ok, F.lit(INFO)).otherwise(F.lit(WARNING)),
                          {"window_start": start, "window_end": ref,
                           "window_days": F.lit(window_days), "out_of_window": out})]
    return AggCheck(build)


def check_exam_date_window(df: DataFrame, reference_date, months: int = 12,
                           rule_id: str = "BR-06", column: str = "exam_date",
                           group_cols: Sequence[str] = ()) -> DataFrame:
    """Flat form of ``date_window_check``."""
    return run_flat(df, date_window_check(df, reference_date, months, rule_id, column), group_cols)


def offender_sample(keys: DataFrame, n: int = SAMPLE_SIZE, rule_id_prefix: str = "BR-05",
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """First ``n`` offending keys per side in row order, one row per sample entry.

    The rank filter is planned as a WindowGroupLimit before the shuffle, so
    only ``n`` rows per side and task are exchanged.
    """
    from pyspark.sql import Window

    p = keys.where(F.col("pass_mismatch") > 0).select(
        *group_cols, F.lit(f"{rule_id_prefix}-pass").alias("rule_id"), "key",
        F.col("first_pass").alias("first_row"))
    f = keys.where(F.col("fail_mismatch") > 0).select(
        *group_cols, F.lit(f"{rule_id_prefix}-fail").alias("rule_id"), "key",
        F.col("first_fail").alias("first_row"))
    w = Window.partitionBy(*group_cols, "rule_id").orderBy("first_row", "key")
    return (p.unionByName(f).withColumn("sample_rank", F.row_number().over(w))
            .where(F.col("sample_rank") <= n)
            .select(*group_cols, "rule_id", "sample_rank",
                    F.col("key").cast("string").alias("candidate"), "first_row"))
