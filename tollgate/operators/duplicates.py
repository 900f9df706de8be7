"""Duplicate detection on key subsets (pandas ``duplicated(keep=False)``).

Every member of a duplicate group counts (three equal rows -> 3) and null
keys are equal to each other, which is exactly how ``groupBy`` treats them.

Plan: ``groupBy(group + keys)`` with map-side partial counts, then a second
aggregation per group over the (already shuffled) key counts. A key that
holds a third of all rows is collapsed to one partial count per map task
before the shuffle, so a hot key costs no more than a cold one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..outcome import CRITICAL, finish

# Name of the per-key row count; unlikely to clash with user columns.
N = "__n"


def _key_columns(keys: Sequence[str], hashed: Sequence[str]) -> list[Column]:
    # Long text keys are grouped by their SHA-256 digest: the shuffle moves
    # 32 bytes per key instead of the whole text (collisions ~2^-128).
    return [F.sha2(F.col(f"`{k}`").cast("string"), 256).alias(k) if k in hashed else F.col(f"`{k}`")
            for k in keys]


def key_counts(df: DataFrame, keys: Sequence[str], group_cols: Sequence[str] = (),
               hashed: Sequence[str] = (), drop_nulls: str | None = None) -> DataFrame:
    """One row per distinct (group, key) with its row count ``__n``.

    ``drop_nulls``: None keeps null keys (pandas); "any" ignores rows with a
    null key column (column-uniqueness expectation); "all" ignores rows whose keys are
    all null (compound-uniqueness expectation).
    """
    base = df
    if drop_nulls:
        base = base.na.drop(how=drop_nulls, subset=list(keys))
    return (base.groupBy(*[F.col(g) for g in group_cols], *_key_columns(keys, hashed))
            .agg(F.count(F.lit(1)).alias(N)))


def duplicate_metrics(df: DataFrame, keys: Sequence[str], group_cols: Sequence[str] = (),
                      hashed: Sequence[str] = (), drop_nulls: str | None = None) -> DataFrame:
    counts = key_counts(df, keys, group_cols, hashed, drop_nulls)
    dup = F.col(N) > 1
    return counts.groupBy(*group_cols).agg(
        F.coalesce(F.sum(F.when(dup, F.col(N))), F.lit(0)).cast("long").alias("duplicate_count"),
        F.count_if(dup).alias("duplicate_groups"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(N), F.lit(0)).cast("long").alias("row_count"),
    )


def detect_duplicates(df: DataFrame, subset: Sequence[str], rule_id: str,
                      severity: str = CRITICAL, group_cols: Sequence[str] = (),
                      hashed: Sequence[str] = (), drop_nulls: str | None = None) -> DataFrame:
    """Flat outcome: ``duplicate_count`` (all members), ``duplicate_groups``."""
    subset = list(subset)
    m = duplicate_metrics(df, subset, group_cols, hashed, drop_nulls)
    passed = F.col("duplicate_count") == 0
    return finish(
        m, rule_id=rule_id, passed=passed, severity_fail=severity,
        description_pass="No duplicate rows detected for subset.",
        description_fail="Duplicate rows detected.",
        keep=[F.array(*[F.lit(k) for k in subset]).alias("subset"),
              "duplicate_count", "duplicate_groups"],
        group_cols=group_cols)


def grouping_counts(df: DataFrame, sets: Sequence[Sequence[str]],
                    group_cols: Sequence[str] = ()) -> tuple[DataFrame, list[int]]:
    """Row counts of several key sets at once: one scan, one exchange (GROUPING SETS).

    Returns the counts (group columns, every key column, ``__set``, ``__n``)
    and the ``__set`` value of each set; a key column is null in the rows of
    sets without it. Equal sets share their rows. Partial counts are taken per
    set before the exchange, so a hot key is one row per task.
    """
    columns = list(dict.fromkeys([*group_cols, *(c for s in sets for c in s)]))
    place = {c: 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)}
    ids = [sum(place[c] for c in columns if c not in {*group_cols, *s}) for s in sets]
    distinct = [[F.col(f"`{c}`") for c in columns if not place[c] & i] for i in dict.fromkeys(ids)]
    counts = df.groupingSets(distinct, *[F.col(f"`{c}`") for c in columns]).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias(N))
    return counts, ids


def check_uniqueness(df: DataFrame, constraints: Sequence[Sequence[str]], rule_id_prefix: str,
                     severity: str = CRITICAL, group_cols: Sequence[str] = (),
                     hashed: Sequence[str] = (), groups: DataFrame | None = None) -> DataFrame:
    """All key sets of a table as one flat frame; rule ids ``{prefix}-unique-{i}`` from 1.

    The table is read once and its keys of all sets cross one exchange.
    ``groups`` (a row per group) makes groups without rows report, too.
    """
    keys = list(dict.fromkeys(k for c in constraints for k in c))
    name = {k: f"__k{i}" for i, k in enumerate(keys)}
    base = df.select(*[F.col(f"`{g}`") for g in group_cols],
                     *[c.alias(name[k]) for k, c in zip(keys, _key_columns([*keys], hashed))])
    counts, ids = grouping_counts(base, [[name[k] for k in c] for c in constraints], group_cols)
    aggs = []
    for i, s in enumerate(ids):
        dup = (F.col("__set") == s) & (F.col(N) > 1)
        aggs += [F.coalesce(F.sum(F.when(dup, F.col(N))), F.lit(0)).cast("long").alias(f"c{i}"), F.count_if(dup).alias(f"g{i}")]
    rows = [F.struct(F.lit(f"{rule_id_prefix}-unique-{i + 1}").alias("rule_id"), F.array(*[F.lit(k) for k in c]).alias("subset"),
                     F.col(f"c{i}").alias("duplicate_count"), F.col(f"g{i}").alias("duplicate_groups"))
            for i, c in enumerate(constraints)]
    m = counts.groupBy(*group_cols).agg(*aggs)
    if groups is not None:
        m = groups.select(*group_cols).join(m, list(group_cols), "left").na.fill(0)
    m = m.select(*group_cols, F.inline(F.array(*rows)))
    return finish(m, rule_id=F.col("rule_id"), passed=F.col("duplicate_count") == 0, severity_fail=severity,
                  description_pass="No duplicate rows detected for subset.",
                  description_fail="Duplicate rows detected.",
                  keep=["subset", "duplicate_count", "duplicate_groups"], group_cols=group_cols)


def validate_uniqueness_constraints(df: DataFrame, constraints: Sequence[Sequence[str]],
                                    rule_id_prefix: str, severity: str = CRITICAL,
                                    group_cols: Sequence[str] = (),
                                    hashed: Sequence[str] = ()) -> list[DataFrame]:
    """One duplicate check per key set, rule ids ``{prefix}-unique-{i}`` from 1.

    A frame per set, for callers that want them apart; ``check_uniqueness``
    evaluates all sets in one pass.
    """
    return [detect_duplicates(df, keys, f"{rule_id_prefix}-unique-{i}", severity,
                              group_cols, hashed)
            for i, keys in enumerate(constraints, start=1)]


def duplicate_rows(df: DataFrame, keys: Sequence[str], hashed: Sequence[str] = ()) -> DataFrame:
    """Rows that belong to a duplicate group, with the group size ``dup_count``.

    Joins the (small, aggregated) duplicate keys back instead of a window over
    the keys, so a hot key never lands in one sort task; AQE broadcasts the key
    side when its measured size allows, and splits skewed partitions otherwise.
    Keys listed in ``hashed`` are matched by their SHA-256 digest on both
    sides, so long texts are never shuffled for the join.
    """
    dups = (key_counts(df, keys, hashed=hashed).where(F.col(N) > 1)
            .select(*[F.col(f"`{k}`").alias(f"__d{i}") for i, k in enumerate(keys)],
                    F.col(N).alias("dup_count")))
    probe = df.select("*", *[c.alias(f"__p{i}") for i, c in enumerate(_key_columns(keys, hashed))])
    cond = [probe[f"__p{i}"].eqNullSafe(dups[f"__d{i}"]) for i in range(len(keys))]
    return probe.join(dups, cond, "inner").select(*[probe[f"`{c}`"] for c in df.columns],
                                                  dups["dup_count"])
