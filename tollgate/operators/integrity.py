"""Cross-table checks: foreign keys (anti-join), latest row per key, enrich.

Foreign key: distinct non-null child keys that have no parent key. Both
sides are reduced to distinct keys with map-side partial aggregation before
the single shuffle on the key; the anti join then reuses that partitioning.
AQE turns it into a broadcast join at run time only when the measured
distinct-parent side is below the broadcast threshold, so no side is
broadcast on a guess.

The outcome row carries the exact orphan count and, as ``sample_values``, the
first ``sample_size`` orphans in key order. The complete list is a distributed
table (``orphan_keys``, ``orphan_details``) that the gate writes for every
foreign key rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..outcome import CRITICAL, INFO

SAMPLE_SIZE = 20


def _key_type_pair(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str):
    ct = dict(child.dtypes)[child_col]
    pt = dict(parent.dtypes)[parent_col]
    if ct == pt:
        return F.col(f"`{child_col}`"), F.col(f"`{parent_col}`")
    # Different declared types (e.g. string ids vs. bigint ids): compare text.
    return F.col(f"`{child_col}`").cast("string"), F.col(f"`{parent_col}`").cast("string")


def _distinct_keys(child: DataFrame, parent: DataFrame, child_column: str,
                   parent_column: str, group_cols: Sequence[str], key_alias: str,
                   carry: Sequence[str] = ()):
    ck, pk = _key_type_pair(child, child_column, parent, parent_column)
    c = child.select(*group_cols, *carry, ck.alias(key_alias)).distinct()
    p = (parent.select(*group_cols, pk.alias(key_alias)).where(F.col(key_alias).isNotNull())
         .distinct())
    return c, p


def orphan_keys(child: DataFrame, parent: DataFrame, child_column: str,
                parent_column: str | None = None, group_cols: Sequence[str] = (),
                key_alias: str = "key", carry: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null child keys without a parent (per group).

    ``carry``: child columns that stay with the keys, e.g. the rule that asks,
    so that several rules share one anti join.
    """
    c, p = _distinct_keys(child, parent, child_column, parent_column or child_column,
                          group_cols, key_alias, carry)
    return c.where(F.col(key_alias).isNotNull()).join(p, [*group_cols, key_alias], "left_anti")


def first_n(df: DataFrame, order_cols: Sequence[str], n: int, value: Column,
            group_cols: Sequence[str] = (), alias: str = "sample") -> DataFrame:
    """First ``n`` values per group in ascending ``order_cols`` as an array.

    A bounded top-k: a global one plans as TakeOrderedAndProject, a grouped
    one as a rank filter pushed below the shuffle (WindowGroupLimit).
    """
    ordered = [F.col(f"`{c}`") for c in order_cols]
    if not group_cols:
        top = df.orderBy(*ordered).limit(n)
        return top.agg(F.transform(F.array_sort(F.collect_list(
            F.struct(*ordered, value.alias("__v")))), lambda s: s["__v"]).alias(alias))
    w = Window.partitionBy(*group_cols).orderBy(*ordered)
    top = df.withColumn("__rk", F.row_number().over(w)).where(F.col("__rk") <= n)
    return top.groupBy(*group_cols).agg(F.transform(F.array_sort(F.collect_list(
        F.struct(F.col("__rk"), value.alias("__v")))), lambda s: s["__v"]).alias(alias))


def foreign_key_reference(child: DataFrame, parent: DataFrame, child_column: str,
                          parent_column: str | None, rule_id: str, description: str,
                          severity: str = CRITICAL, group_cols: Sequence[str] = (),
                          sample_size: int = SAMPLE_SIZE,
                          orphans: DataFrame | None = None) -> DataFrame:
    """Flat outcome: ``missing_count`` (exact) and ``sample_values`` (first k sorted).

    Groups listed in ``group_cols`` that exist in the child and have no orphan
    get a passing row. ``orphans``: the written ``orphan_keys`` of the rule,
    where the caller has them.
    """
    # Count and sample read one exchange of the orphan keys, so the anti join
    # runs once; a consumer that reads neither runs no join at all.
    if orphans is None:
        orphans = orphan_keys(child, parent, child_column, parent_column, group_cols).repartition(*group_cols, "key")
    if group_cols:
        counts = orphans.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("missing_count"))
        sample = first_n(orphans, ["key"], sample_size, F.col("key").cast("string"),
                         group_cols, "sample_values")
        # Groups come from the distinct child keys the anti join already
        # aggregates (same plan, reused exchange), not from a second scan.
        c, _p = _distinct_keys(child, parent, child_column, parent_column or child_column,
                               group_cols, "key")
        groups = c.select(*group_cols).distinct()
        m = (groups.join(counts, list(group_cols), "left").join(sample, list(group_cols), "left")
             .select(*group_cols, F.coalesce("missing_count", F.lit(0)).alias("missing_count"),
                     F.coalesce("sample_values", F.array().cast("array<string>"))
                     .alias("sample_values")))
    else:
        sample = first_n(orphans, ["key"], sample_size, F.col("key").cast("string"),
                         alias="sample_values")
        # The sample is a scalar subquery of the count row: no join at all.
        m = orphans.agg(F.count(F.lit(1)).alias("missing_count")).select(
            "missing_count", sample.scalar().alias("sample_values"))
    return orphan_outcomes(m, F.lit(rule_id), F.lit(description), severity, group_cols)


def orphan_outcomes(m: DataFrame, rule_id: Column, description: Column, severity: str = CRITICAL,
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Flat outcomes of (groups..., missing_count, sample_values) rows."""
    ok = F.col("missing_count") == 0
    return m.select(*group_cols, rule_id.alias("rule_id"),
                    F.when(ok, description).otherwise(F.concat(description, F.lit(" Mismatched candidates found."))).alias("description"),
                    ok.alias("passed"), F.when(ok, F.lit(INFO)).otherwise(F.lit(severity)).alias("severity"),
                    "missing_count", "sample_values")


def orphan_details(orphans: DataFrame, rule_id: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """The complete orphan list of a rule: (groups..., rule_id, missing_value), a row per key."""
    return orphans.select(*group_cols, F.lit(rule_id).alias("rule_id"), F.col("key").cast("string").alias("missing_value"))


def check_exam_candidate_fk(exam_df: DataFrame, candidates_df: DataFrame,
                            rule_id: str = "BR-07", group_cols: Sequence[str] = ()) -> DataFrame:
    return foreign_key_reference(exam_df, candidates_df, "candidate_id", "candidate_id", rule_id,
                                 "Every exam candidate_id exists in the master list.",
                                 group_cols=group_cols)


def check_cert_candidate_fk(cert_df: DataFrame, candidates_df: DataFrame,
                            rule_id: str = "BR-07b", group_cols: Sequence[str] = ()) -> DataFrame:
    return foreign_key_reference(cert_df, candidates_df, "candidate_id", "candidate_id", rule_id,
                                 "Every certification row references a known candidate.",
                                 group_cols=group_cols)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts_column: str,
                   tie_columns: Sequence[str] = (), null_ts_wins: bool = True) -> DataFrame:
    """One row per key: the greatest ``ts_column``; a null timestamp wins.

    ``row_number() = 1`` is planned as a WindowGroupLimit below the shuffle,
    so each map task forwards only its best row per key (a hot key costs at
    most one row per task in the exchange).
    """
    ts = F.col(f"`{ts_column}`")
    order = [ts.desc_nulls_first() if null_ts_wins else ts.desc_nulls_last()]
    order += [F.col(f"`{t}`").desc_nulls_first() for t in tie_columns]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def enrich_latest(fact: DataFrame, latest: DataFrame, key: str, columns: Sequence[str],
                  latest_key: str | None = None) -> DataFrame:
    """``fact`` LEFT JOIN latest-row-per-key on a null-safe key."""
    latest_key = latest_key or key
    lk = "__latest_key"
    right = latest.select(F.col(f"`{latest_key}`").alias(lk), *[F.col(f"`{c}`") for c in columns])
    return fact.join(right, fact[key].eqNullSafe(right[lk]), "left").drop(lk)
