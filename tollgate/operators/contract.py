"""Operators specified by the feed contract (business-rule docs, severity matrix).

* late master record (C1), per-row arrival lag (C2), record without a fact
  (C3, an info-level foreign key), overlapping status intervals (C4), keep
  latest per level (C5), optional metadata (C6), per-feed freshness limits
  (C7), row quarantine (C8), extra feed FK (C9), value-set presets (C10).

Overlap detection (C4) is a running maximum per key. A plain window per key
would put a hot key's rows into one task, so the scan is split in two
levels: rows are range-partitioned on (key, start, tie) into contiguous
chunks (a hot key spans many chunks); a small per-chunk aggregate gives each
chunk the maximum end of all earlier chunks of its key (window over chunk
rows only); inside a (key, chunk) an ordinary running max over
``(start, tie)`` finishes the scan. Results equal a per-key window exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import coerce_timestamp, hours_between
from ..outcome import CRITICAL, INFO, WARNING, finish
from .fusion import AggCheck, Row, run_flat
from .integrity import foreign_key_reference, latest_per_key
from ..session import cut_lineage

# Certification levels allowed by the contract and the
# per-feed freshness limits (max, warning) in hours.
CERTIFICATION_LEVELS = ("Associate", "Professional", "Expert")
FEED_FRESHNESS_HOURS = {"candidates": (24.0, 72.0), "exam_results": (24.0, 48.0),
                        "certification_status": (24.0, 48.0)}


def _ts(df: DataFrame, c: str) -> Column:
    dtype = {f.name: f.dataType for f in df.schema.fields}[c]
    return coerce_timestamp(F.col(f"`{c}`"), dtype)


def check_late_master(fact: DataFrame, master: DataFrame, *, key: str, fact_time: str,
                      master_time: str, master_key: str | None = None,
                      rule_id: str = "BR-07-late-master", severity: str = WARNING,
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """Fact rows whose master record was created after the fact."""
    master_key = master_key or key
    m = master.select(*group_cols, F.col(f"`{master_key}`").alias("__mk"),
                      _ts(master, master_time).alias("__mt"))
    f = fact.select(*group_cols, F.col(f"`{key}`").alias("__fk"), _ts(fact, fact_time).alias("__ft"))
    cond = [f["__fk"] == m["__mk"]] + [f[g] == m[g] for g in group_cols]
    j = f.join(m, cond, "inner").select(*[f[g] for g in group_cols], "__ft", "__mt", "__fk")
    agg = j.groupBy(*group_cols).agg(F.count_if(F.col("__mt") > F.col("__ft")).alias("late_count"),
                                     F.count(F.lit(1)).alias("matched_rows"))
    return finish(agg, rule_id=rule_id, passed=F.col("late_count") == 0, severity_fail=severity,
                  severity_pass=INFO,
                  description_pass="Master records precede their facts.",
                  description_fail="Master records were created after their facts.",
                  keep=["late_count", "matched_rows"], group_cols=group_cols)


def arrival_lag_check(df: DataFrame, *, received_col: str, event_col: str,
                      max_hours: float = 24.0, rule_id: str = "BR-08-arrival",
                      severity: str = WARNING) -> AggCheck:
    """Rows received more than ``max_hours`` after their event."""
    def build(p: str):
        lag = hours_between(_ts(df, received_col), _ts(df, event_col))
        aggs = [F.count_if(lag > F.lit(float(max_hours))).alias(f"{p}late"),
                F.count(F.lit(1)).alias(f"{p}rows")]
        late = F.col(f"{p}late")
        ok = late == 0
        return aggs, [Row(F.lit(rule_id),
                          F.when(ok, F.lit("Rows arrive within the allowed lag."))
                          .otherwise(F.lit("Rows arrive later than the allowed lag.")),
                          ok, F.when(ok, F.lit(INFO)).otherwise(F.lit(severity)),
                          {"late_rows": late, "row_count": F.col(f"{p}rows"),
                           "max_hours": F.lit(float(max_hours))})]
    return AggCheck(build)


def check_arrival_lag(df: DataFrame, *, received_col: str, event_col: str,
                      max_hours: float = 24.0, rule_id: str = "BR-08-arrival",
                      severity: str = WARNING, group_cols: Sequence[str] = ()) -> DataFrame:
    """Flat form of ``arrival_lag_check``."""
    return run_flat(df, arrival_lag_check(df, received_col=received_col, event_col=event_col,
                                          max_hours=max_hours, rule_id=rule_id, severity=severity),
                    group_cols)


def check_without_fact(master: DataFrame, fact: DataFrame, key: str,
                       rule_id: str = "BR-07-cert-without-attempt",
                       group_cols: Sequence[str] = ()) -> DataFrame:
    """Master keys without any fact row, reported at info level."""
    return foreign_key_reference(master, fact, key, key, rule_id,
                                 "Every record has a corresponding attempt.", severity=INFO,
                                 group_cols=group_cols)


def interval_overlaps(df: DataFrame, keys: Sequence[str], start_col: str, end_col: str,
                      tie_cols: Sequence[str] = (), num_chunks: int | None = None,
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows whose interval starts before an earlier interval of the key ends.

    Returns every input row with a non-null start plus ``prev_max_end``,
    ``overlaps`` and ``partner``: the ties (the id) of the earlier interval that
    ends last, of equal ends the one with the greatest ties, null where nothing
    overlaps. One partner a row, never all pairs. Rows are range-partitioned on (groups, keys, start, ties)
    into ``num_chunks`` (default: the shuffle partition count) contiguous
    chunks, so a hot key is split by row count however its times are spread.
    The chunked rows are written once: both their uses read the same chunk
    numbers, whatever the optimizer reuses. A small per-chunk aggregate
    carries each chunk the interval of the key's earlier chunks that ends last,
    and a running maximum inside each (key, chunk) finishes the sweep.
    """
    spark = df.sparkSession
    keys = [*group_cols, *keys]
    n = num_chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    start = _ts(df, start_col)
    end = _ts(df, end_col)
    base = df.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{t}`") for t in tie_cols],
                     start.alias("__start"), end.alias("__end")).where(F.col("__start").isNotNull())
    order = [*[F.col(f"`{k}`") for k in keys], F.col("__start"), *[F.col(f"`{t}`") for t in tie_cols]]
    # Partition ids of a range exchange follow the sort order of (keys, start, ties).
    ranged = cut_lineage(base.repartitionByRange(n, *order).withColumn("__chunk", F.spark_partition_id()))
    chunk_keys = [*keys, "__chunk"]
    last = F.max(F.when(F.col("__end").isNotNull(), F.struct("__end", *[F.col(f"`{t}`") for t in tie_cols])))
    chunks = ranged.groupBy(*chunk_keys).agg(last.alias("__chunk_max"))
    carry_w = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.select(*chunk_keys, F.max("__chunk_max").over(carry_w).alias("__carry"))
    b, c = ranged.alias("b"), carry.alias("c")
    # Null-safe on the key so a null key forms its own group, as in a window.
    cond = [F.col(f"b.`{k}`").eqNullSafe(F.col(f"c.`{k}`")) for k in chunk_keys]
    j = b.join(c, cond, "inner").select("b.*", "c.__carry")
    in_w = (Window.partitionBy(*chunk_keys).orderBy("__start", *tie_cols)
            .rowsBetween(Window.unboundedPreceding, -1))
    out = j.withColumn("__prev", F.greatest(F.col("__carry"), last.over(in_w))).withColumn("prev_max_end", F.col("__prev.__end"))
    overlaps = F.coalesce(F.col("__start") < F.col("prev_max_end"), F.lit(False))
    partner = F.when(overlaps, F.struct(*[F.col(f"__prev.`{t}`").alias(t) for t in tie_cols])) if tie_cols else F.lit(None).cast("struct<>")
    return out.select(*keys, *tie_cols, F.col("__start").alias(start_col),
                      F.col("__end").alias(end_col), "prev_max_end", overlaps.alias("overlaps"), partner.alias("partner"))


def check_overlapping_intervals(df: DataFrame, keys: Sequence[str], start_col: str, end_col: str,
                                tie_cols: Sequence[str] = (), rule_id: str = "BR-09",
                                severity: str = CRITICAL, num_chunks: int | None = None,
                                group_cols: Sequence[str] = ()) -> DataFrame:
    """Flat outcome (C4): overlapping rows and keys with an overlap (per group)."""
    ov = interval_overlaps(df, keys, start_col, end_col, tie_cols, num_chunks, group_cols)
    per_key = ov.groupBy(*group_cols, *keys).agg(F.count_if("overlaps").alias("n"))
    agg = per_key.groupBy(*group_cols).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("overlap_count"),
                      F.count_if(F.col("n") > 0).alias("keys_with_overlap"))
    return finish(agg, rule_id=rule_id, passed=F.col("overlap_count") == 0, severity_fail=severity,
                  description_pass="No overlapping status intervals.",
                  description_fail="Overlapping status intervals found.",
                  keep=["overlap_count", "keys_with_overlap"], group_cols=group_cols)


def keep_latest_per_level(cert: DataFrame, keys: Sequence[str] = ("candidate_id", "certification_level"),
                          ts_col: str = "status_effective_ts",
                          tie_cols: Sequence[str] = ("cert_status_id",)) -> DataFrame:
    """Remediation of BR-09: latest status row per (candidate, level)."""
    return latest_per_key(cert, list(keys), ts_col, list(tie_cols))


def optional_metadata_check(df: DataFrame, columns: Sequence[str], rule_id: str = "BR-10") -> AggCheck:
    """Per optional column: present?, non-null count/ratio; info severity."""
    present = [c for c in columns if c in df.columns]

    def build(p: str):
        aggs = [F.count(F.lit(1)).alias(f"{p}rows")]
        aggs += [F.count(F.col(f"`{c}`")).alias(f"{p}nn{i}") for i, c in enumerate(present)]
        rows_total = F.col(f"{p}rows")
        rows = []
        for c in columns:
            nn = F.col(f"{p}nn{present.index(c)}") if c in present else F.lit(None).cast("long")
            ratio = F.when(rows_total > 0, nn.cast("double") / rows_total.cast("double"))
            ok = F.coalesce(F.lit(c in present) & (nn == rows_total), F.lit(False))
            rows.append(Row(F.lit(f"{rule_id}-{c}"),
                            F.when(ok, F.lit("Optional metadata is present."))
                            .otherwise(F.lit("Optional metadata is missing or incomplete.")),
                            ok, F.lit(INFO),
                            {"column": F.lit(c), "present": F.lit(c in present),
                             "non_null_count": nn, "row_count": rows_total,
                             "non_null_ratio": ratio}))
        return aggs, rows
    return AggCheck(build)


def check_optional_metadata(df: DataFrame, columns: Sequence[str], rule_id: str = "BR-10",
                            group_cols: Sequence[str] = ()) -> DataFrame:
    """Flat form of ``optional_metadata_check``."""
    return run_flat(df, optional_metadata_check(df, columns, rule_id), group_cols)


def feed_freshness(feeds: Mapping[str, tuple[DataFrame, str]], *, reference_ts,
                   thresholds: Mapping[str, tuple[float, float]] = FEED_FRESHNESS_HOURS,
                   rule_id: str = "BR-08", group_cols: Sequence[str] = ()) -> DataFrame:
    """Per-feed freshness (C7): one max per feed, limits looked up per feed name."""
    from .business import evaluate_freshness

    out = None
    for name, (df, ts_col) in feeds.items():
        mx, wn = thresholds.get(name, (24.0, 48.0))
        r = evaluate_freshness(df, reference_ts=reference_ts, timestamp_column=ts_col,
                               max_allowed_hours=mx, warning_hours=wn,
                               rule_id=f"{rule_id}-{name}", group_cols=group_cols)
        r = r.withColumn("feed", F.lit(name))
        out = r if out is None else out.unionByName(r)
    return out


def with_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``violations``: names of the rules a row breaks, in rule order."""
    names = F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name))
                                      for name, cond in rules.items()]))
    return df.withColumn("violations", names)


def split_quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with ``violations``) from one tagged plan."""
    tagged = with_violations(df, rules)
    good = tagged.where(F.size("violations") == 0).drop("violations")
    bad = tagged.where(F.size("violations") > 0)
    return good, bad


def write_quarantine(df: DataFrame, rules: Mapping[str, Column], path: str,
                     mode: str = "overwrite") -> None:
    """Good and quarantined rows in ONE pass: rows are tagged once and written
    partitioned by ``quarantined`` (two consumers of the same scan would read
    the input twice)."""
    tagged = with_violations(df, rules).withColumn("quarantined", F.size("violations") > 0)
    tagged.write.mode(mode).partitionBy("quarantined").parquet(path)


def score_quarantine_rules(columns: Sequence[str] = ("score", "score_scaled")) -> dict[str, Column]:
    """Contract rule: null or non-numeric scores invalidate the row."""
    from ..functions.coerce import strict_double
    return {f"{c}_invalid": strict_double(F.col(c)).isNull() for c in columns}


def check_flag_candidate_fk(flags: DataFrame, candidates: DataFrame, rule_id: str = "BR-07c",
                            group_cols: Sequence[str] = (), orphans: DataFrame | None = None) -> DataFrame:
    """Disciplinary flags must reference a known candidate."""
    return foreign_key_reference(flags, candidates, "candidate_id", "candidate_id", rule_id,
                                 "Every disciplinary flag references a known candidate.",
                                 group_cols=group_cols, orphans=orphans)


def value_set_check(column: str, values: Sequence, rule_id: str,
                    severity: str = WARNING) -> AggCheck:
    """Non-null values outside an allowed set, as an outcome (C10 presets)."""
    def build(p: str):
        c = F.col(f"`{column}`")
        aggs = [F.count_if(c.isNotNull() & ~c.isin(list(values))).alias(f"{p}bad")]
        bad = F.col(f"{p}bad")
        ok = bad == 0
        return aggs, [Row(F.lit(rule_id),
                          F.when(ok, F.lit(f"All {column} values are in the allowed set."))
                          .otherwise(F.lit(f"{column} has values outside the allowed set.")),
                          ok, F.when(ok, F.lit(INFO)).otherwise(F.lit(severity)),
                          {"unexpected_count": bad})]
    return AggCheck(build)


def check_value_set(df: DataFrame, column: str, values: Sequence, rule_id: str,
                    severity: str = WARNING, group_cols: Sequence[str] = ()) -> DataFrame:
    """Flat form of ``value_set_check``."""
    return run_flat(df, value_set_check(column, values, rule_id, severity), group_cols)


def check_certification_level(cert: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    return check_value_set(cert, "certification_level", CERTIFICATION_LEVELS,
                           "BR-05-certification-level", group_cols=group_cols)
