"""Declarative expectation suites evaluated as fused Spark aggregations.

A suite is a list of ``Expectation`` specs. All expectations of one table, of
any number of suites, are evaluated in **one** pass: value expectations
(not-null, between, in-set) become flags of a row, and the flags and each key
set of the uniqueness expectations are grouping sets of one aggregation (one
scan, one exchange). Results are typed rows (expectation-result metrics) that
union across suites and runs (checkpoint).

Evaluation parameters (``Param``) are resolved as scalar subqueries over any
table, so a bound computed from data is part of the same plan: no collect,
no cross join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..outcome import CRITICAL
from .duplicates import N, grouping_counts, key_counts

PARTIAL_LIST_SIZE = 20


@dataclass(frozen=True)
class Param:
    """Reference to an evaluation parameter resolved at run time."""

    name: str


@dataclass(frozen=True)
class Expectation:
    expectation_type: str
    column: str | None = None
    column_list: tuple[str, ...] = ()
    min_value: Any = None
    max_value: Any = None
    value_set: tuple[Any, ...] = ()
    mostly: float | None = None

    @property
    def column_name(self) -> str:
        return self.column if self.column is not None else ",".join(self.column_list)


def not_null(column: str, mostly: float | None = None) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", column, mostly=mostly)


def unique(column: str, mostly: float | None = None) -> Expectation:
    return Expectation("expect_column_values_to_be_unique", column, mostly=mostly)


def compound_unique(columns: Sequence[str]) -> Expectation:
    return Expectation("expect_compound_columns_to_be_unique", column_list=tuple(columns))


def between(column: str, min_value: Any = None, max_value: Any = None,
            mostly: float | None = None) -> Expectation:
    return Expectation("expect_column_values_to_be_between", column,
                       min_value=min_value, max_value=max_value, mostly=mostly)


def in_set(column: str, value_set: Sequence[Any], mostly: float | None = None) -> Expectation:
    return Expectation("expect_column_values_to_be_in_set", column,
                       value_set=tuple(value_set), mostly=mostly)


def ordered_columns(column_list: Sequence[str]) -> Expectation:
    return Expectation("expect_table_columns_to_match_ordered_list",
                       column_list=tuple(column_list))


def from_config(cfg: Mapping[str, Any]) -> Expectation:
    """Build from a ``{expectation_type, kwargs}`` dict (suite JSON entry)."""
    kw = dict(cfg.get("kwargs", {}))

    def val(v):
        if isinstance(v, str) and v.startswith("$PARAMETER."):
            return Param(v[len("$PARAMETER."):])
        if isinstance(v, dict) and "$PARAMETER" in v:
            return Param(v["$PARAMETER"])
        return v

    return Expectation(
        cfg["expectation_type"], kw.get("column"), tuple(kw.get("column_list", ()) or ()),
        val(kw.get("min_value")), val(kw.get("max_value")),
        tuple(kw.get("value_set", ()) or ()), kw.get("mostly"))


def parameter(df: DataFrame, expr: Column) -> Column:
    """A scalar-subquery Column over ``df`` (e.g. ``F.min('d')``)."""
    return df.agg(expr.alias("v")).scalar()


def parameters(df: DataFrame, exprs: Mapping[str, Column]) -> dict[str, Column]:
    """Several parameters of one table from a single scalar subquery (one scan)."""
    s = df.agg(F.struct(*[e.alias(k) for k, e in exprs.items()]).alias("p")).scalar()
    return {k: s.getField(k) for k in exprs}


_SCALAR = {"expect_column_values_to_not_be_null", "expect_column_values_to_be_between",
           "expect_column_values_to_be_in_set"}
_UNIQUE = {"expect_column_values_to_be_unique", "expect_compound_columns_to_be_unique"}
_ORDERED = "expect_table_columns_to_match_ordered_list"


def _bound(v: Any, params: Mapping[str, Column]) -> Column | None:
    if v is None:
        return None
    if isinstance(v, Param):
        if v.name not in params:
            raise KeyError(f"evaluation parameter '{v.name}' is not defined")
        return params[v.name]
    return v if isinstance(v, Column) else F.lit(v)


def _pct(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") * F.lit(100) / den.cast("double"))


def run_suite(df: DataFrame, suite: str, expectations: Sequence[Expectation],
              params: Mapping[str, Column] | None = None, group_cols: Sequence[str] = (),
              partial_lists: bool = False) -> DataFrame:
    """Evaluate a suite; one result row per (group, expectation).

    Columns: suite, expectation_index, expectation_type, column_name, success,
    element_count, missing_count, missing_percent, unexpected_count,
    unexpected_percent, unexpected_percent_total, unexpected_percent_nonmissing,
    bounds_resolved.
    """
    params = dict(params or {})
    out = _table_results(df, [(None, suite, i, e) for i, e in enumerate(expectations)], params, group_cols).drop("batch_identifier")
    if partial_lists:
        scalar = [(i, e) for i, e in enumerate(expectations) if e.expectation_type in _SCALAR]
        lists = [partial_unexpected(df, scalar, params, group_cols)] if scalar else []
        lists += [partial_repeats(df, i, e, group_cols) for i, e in enumerate(expectations)
                  if e.expectation_type in _UNIQUE]
        if lists:
            pl = lists[0]
            for x in lists[1:]:
                pl = pl.unionByName(x)
            out = out.join(pl, [*group_cols, "expectation_index"], "left")
    return out


def _unexpected_condition(e: Expectation, params: Mapping[str, Column]) -> tuple[Column, Column]:
    """(unexpected predicate on non-missing values, bounds_resolved)."""
    c = F.col(f"`{e.column}`")
    if e.expectation_type == "expect_column_values_to_not_be_null":
        return c.isNull(), F.lit(True)
    if e.expectation_type == "expect_column_values_to_be_in_set":
        return c.isNotNull() & ~c.isin(list(e.value_set)), F.lit(True)
    lo, hi = _bound(e.min_value, params), _bound(e.max_value, params)
    conds, resolved = [], F.lit(True)
    if lo is not None:
        conds.append(c < lo)
        resolved = resolved & lo.isNotNull()
    if hi is not None:
        conds.append(c > hi)
        resolved = resolved & hi.isNotNull()
    bad = F.lit(False)
    for x in conds:
        bad = bad | F.coalesce(x, F.lit(False))
    return c.isNotNull() & bad, resolved


#: Flags of one packed long.
_FLAGS = 60


def _table_results(df: DataFrame, items: Sequence[tuple], params: Mapping[str, Column], group_cols: Sequence[str]) -> DataFrame:
    """Results of all (batch, suite, index, expectation) of one table: one scan, one exchange.

    A row's verdicts on the value expectations (missing, unexpected, bound not
    resolved) are packed into flags; the flags are one grouping set, each
    distinct key set of the uniqueness expectations another. All metrics are
    sums over the counts of these sets, so expectations of any number of suites
    share the pass. Distinct flag patterns are few and collapse before the
    exchange, as do hot keys.
    """
    flags: list[Column] = []
    at: dict[int, tuple[int, int, int | None]] = {}  # item -> places of its flags
    keys: list[str] = []
    for n, (_, _, _, e) in enumerate(items):
        if e.expectation_type in _SCALAR:
            cond, resolved = _unexpected_condition(e, params)
            bounded = isinstance(e.min_value, Param) or isinstance(e.max_value, Param)
            at[n] = (len(flags), len(flags) + 1, len(flags) + 2 if bounded else None)
            flags += [F.col(f"`{e.column}`").isNull(), cond] + ([~resolved] if bounded else [])
        elif e.expectation_type in _UNIQUE:
            keys += [k for k in _keys_of(e) if k not in keys]
        elif e.expectation_type != _ORDERED:
            raise ValueError(f"unsupported expectation {e.expectation_type}")
    key_name = {k: f"__k{i}" for i, k in enumerate(keys)}
    packed = [sum((F.when(f, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, f in enumerate(flags[i:i + _FLAGS])), F.lit(0).cast("long"))
              .alias(f"__f{i // _FLAGS}") for i in range(0, max(1, len(flags)), _FLAGS)]
    base = df.select(*[F.col(f"`{g}`") for g in group_cols], *packed, *[F.col(f"`{k}`").alias(key_name[k]) for k in keys])
    unique = [n for n, (_, _, _, e) in enumerate(items) if e.expectation_type in _UNIQUE]
    sets = [[f"__f{i}" for i in range(len(packed))], *([key_name[k] for k in _keys_of(items[n][3])] for n in unique)]
    counts, ids = grouping_counts(base, sets, group_cols)
    rows_of_table = F.col("__set") == ids[0]

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col(N))), F.lit(0)).cast("long")

    def flagged(place: int) -> Column:
        return rows_of_table & (F.col(f"__f{place // _FLAGS}").bitwiseAND(F.lit(1 << (place % _FLAGS)).cast("long")) != 0)

    aggs = [total(rows_of_table).alias("element_count")]
    for n, (missing, unexpected, unresolved) in at.items():
        aggs += [total(flagged(missing)).alias(f"m{n}"), total(flagged(unexpected)).alias(f"u{n}")]
        if unresolved is not None:
            aggs.append((total(flagged(unresolved)) == 0).alias(f"r{n}"))
    for n, set_id in zip(unique, ids[1:]):
        e = items[n][3]
        # Column uniqueness ignores null values; compound uniqueness ignores
        # rows whose keys are all null.
        nulls = [F.col(key_name[k]).isNull() for k in _keys_of(e)]
        missing = nulls[0]
        for x in nulls[1:]:
            missing = (missing & x) if e.column is None else (missing | x)
        mine = F.col("__set") == set_id
        aggs += [total(mine & missing).alias(f"m{n}"), total(mine & ~missing & (F.col(N) > 1)).alias(f"u{n}")]

    rows = []
    for n, (batch, suite, index, e) in enumerate(items):
        ordered = e.expectation_type == _ORDERED
        number = lambda c: F.lit(None).cast("long") if ordered else F.col(c)  # noqa: E731,B023
        rows.append(F.struct(
            F.lit(batch).cast("string").alias("batch_identifier"), F.lit(suite).alias("suite"), F.lit(index).alias("expectation_index"),
            F.lit(e.expectation_type).alias("expectation_type"), F.lit(e.column_name).alias("column_name"),
            number(f"m{n}").alias("missing_count"), number(f"u{n}").alias("unexpected_count"),
            (F.col(f"r{n}") if n in at and at[n][2] is not None else F.lit(True)).alias("bounds_resolved"),
            F.lit(e.mostly).cast("double").alias("mostly"),
            F.lit(e.expectation_type == "expect_column_values_to_not_be_null").alias("is_null_check"),
            F.lit(list(df.columns) == list(e.column_list) if ordered else None).cast("boolean").alias("fixed")))
    m = counts.groupBy(*group_cols).agg(*aggs).select(*group_cols, "element_count", F.inline(F.array(*rows)))
    return _finish_metrics(m, group_cols)


def _keys_of(e: Expectation) -> list[str]:
    return [e.column] if e.column is not None else list(e.column_list)


def _pct_sql(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) * 100 / CAST({den} AS DOUBLE) END"


def _finish_metrics(m: DataFrame, group_cols) -> DataFrame:
    """Expectation-result metrics from (element, missing, unexpected) counts.

    Written as one ``selectExpr`` (each derived metric is one SQL string) so
    the projection is built with a single JVM call.
    """
    nonmissing = "(element_count - missing_count)"
    den = f"CASE WHEN is_null_check THEN element_count ELSE {nonmissing} END"
    ratio = (f"CASE WHEN {den} > 0 THEN CAST({den} - unexpected_count AS DOUBLE) "
             f"/ CAST({den} AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END")
    return m.selectExpr(
        *[f"`{g}`" for g in group_cols],
        "suite",
        "expectation_index", "expectation_type", "column_name",
        f"coalesce(fixed, bounds_resolved AND CASE WHEN mostly IS NULL THEN unexpected_count = 0 "
        f"ELSE {ratio} >= mostly END) AS success",
        "element_count",
        "CASE WHEN is_null_check THEN CAST(NULL AS BIGINT) ELSE missing_count END AS missing_count",
        f"CASE WHEN is_null_check THEN CAST(NULL AS DOUBLE) "
        f"ELSE {_pct_sql('missing_count', 'element_count')} END AS missing_percent",
        "unexpected_count",
        f"CASE WHEN is_null_check THEN {_pct_sql('unexpected_count', 'element_count')} "
        f"ELSE {_pct_sql('unexpected_count', nonmissing)} END AS unexpected_percent",
        f"{_pct_sql('unexpected_count', 'element_count')} AS unexpected_percent_total",
        f"CASE WHEN is_null_check THEN CAST(NULL AS DOUBLE) "
        f"ELSE {_pct_sql('unexpected_count', nonmissing)} END AS unexpected_percent_nonmissing",
        "bounds_resolved",
        "batch_identifier",
    )


def partial_unexpected(df: DataFrame, scalar, params, group_cols,
                       size: int = PARTIAL_LIST_SIZE) -> DataFrame:
    """Top ``size`` unexpected values per expectation with their counts.

    Every row emits (expectation, value) for each expectation it violates;
    ``heavy_values`` finds the most frequent ones without shuffling every
    distinct value.
    """
    items = []
    for i, e in scalar:
        cond, _ = _unexpected_condition(e, params)
        val = F.col(f"`{e.column}`").cast("string")
        items.append(F.when(cond, F.struct(F.lit(i).alias("expectation_index"), val.alias("value"))))
    ex = df.select(*group_cols, F.explode(F.array_compact(F.array(*items))).alias("x")).select(*group_cols, "x.expectation_index", "x.value")
    return _top_values(heavy_values(ex, [*group_cols, "expectation_index"], "value", size), group_cols, size)


#: Counters of a heavy-hitter summary, per list: 2**16 rows at most cross its exchange.
SUMMARY_BITS = 16


def heavy_values(rows: DataFrame, keys: Sequence[str], value: str, size: int) -> DataFrame:
    """(keys, value, count) of a superset of each key's ``size`` most frequent values, counted exactly.

    A mergeable summary counts values by a hash into 2**16 counters per key: a
    counter is an upper bound of each value's count behind it. The values
    behind the ``size`` highest counters are counted exactly; the ``size``-th of
    them is a lower bound of what the list needs. Then only values behind
    counters that reach the bound are counted and shuffled, however many
    distinct ones there are. Values of a top list and ties with its last place
    always reach the bound, so the list taken from the result is exact.
    """
    keys = list(keys)
    hashed = rows.withColumn("__h", F.xxhash64(F.col(value)).bitwiseAND(F.lit((1 << SUMMARY_BITS) - 1)).cast("int"))
    summary = hashed.groupBy(*keys, "__h").agg(F.count(F.lit(1)).alias("__upper"))
    part = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    highest = summary.withColumn("__r", F.row_number().over(part.orderBy(F.desc("__upper"), "__h"))).where(F.col("__r") <= size)

    def matched(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
        """Equi-join in which null keys are equal, as they are to groupBy."""
        named = right.withColumnsRenamed({c: f"__on_{i}" for i, c in enumerate(on)})
        out = left.join(named, [F.col(f"`{c}`").eqNullSafe(F.col(f"__on_{i}")) for i, c in enumerate(on)], how)
        return out.drop(*[f"__on_{i}" for i in range(len(on))])

    def counted(chosen: DataFrame) -> DataFrame:
        # at most 2**SUMMARY_BITS rows a key; AQE broadcasts them by their measured size
        some = matched(hashed, chosen.select(*keys, "__h"), [*keys, "__h"], "left_semi")
        return some.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("count"))

    some = counted(highest).withColumn("__r", F.row_number().over(part.orderBy(F.desc("count")))).where(F.col("__r") <= size)
    # fewer than ``size`` values behind the highest counters prove nothing
    least = some.groupBy(*keys).agg(F.when(F.count(F.lit(1)) >= size, F.min("count")).otherwise(F.lit(0)).alias("__least"))
    if keys:
        wanted = matched(summary, least, keys, "inner").where(F.col("__upper") >= F.col("__least"))
    else:
        wanted = summary.where(F.col("__upper") >= F.coalesce(least.select("__least").scalar(), F.lit(0)))
    return counted(wanted)


def partial_repeats(df: DataFrame, i: int, e: Expectation, group_cols, size: int = PARTIAL_LIST_SIZE) -> DataFrame:
    """Top ``size`` repeated keys of a uniqueness expectation with their row
    counts; a compound key is given as JSON."""
    keys = [e.column] if e.column is not None else list(e.column_list)
    cols = [F.col(f"`{k}`") for k in keys]
    if len(keys) == 1:
        value, missing = cols[0].cast("string"), cols[0].isNull()
    else:
        value, missing = F.to_json(F.struct(*cols)), F.greatest(*[c.isNotNull().cast("int") for c in cols]) == 0
    rows = df.where(~missing).select(*group_cols, value.alias("value"))
    vc = heavy_values(rows, group_cols, "value", size).where(F.col("count") > 1)
    return _top_values(vc.select(*group_cols, F.lit(i).alias("expectation_index"), "value", "count"), group_cols, size)


def _top_values(vc: DataFrame, group_cols, size: int) -> DataFrame:
    w = Window.partitionBy(*group_cols, "expectation_index").orderBy(
        F.col("count").desc(), F.col("value").asc_nulls_first())
    top = vc.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= size)
    return top.groupBy(*group_cols, "expectation_index").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rk", "value", "count"))),
                    lambda s: F.struct(s["value"].alias("value"), s["count"].alias("count")))
        .alias("partial_unexpected_counts"))


def suite_statistics(results: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """evaluated / successful / unsuccessful / success_percent / success per suite."""
    keys = [*group_cols, "suite"]
    return results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if(F.col("success")).alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
        _pct(F.count_if(F.col("success")), F.count(F.lit(1))).alias("success_percent"),
        F.bool_and(F.col("success")).alias("success"),
    )


def run_checkpoint(validations: Sequence[tuple[str, DataFrame, str, Sequence[Expectation]]],
                   params: Mapping[str, Column] | None = None, run_name: str | None = None,
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """Several (batch id, table, suite, expectations) in one plan.

    Validations of the same table (the same frame) are evaluated together,
    whatever their suites: a table is scanned once. An expectation given as
    None keeps its place and is left out.
    """
    tables: dict[int, tuple[DataFrame, list[tuple]]] = {}
    for batch_id, df, suite, exps in validations:
        tables.setdefault(id(df), (df, []))[1].extend((batch_id, suite, i, e) for i, e in enumerate(exps) if e is not None)
    out = None
    for df, items in tables.values():
        if items:
            r = _table_results(df, items, dict(params or {}), group_cols)
            out = r if out is None else out.unionByName(r)
    if run_name is not None:
        out = out.withColumn("run_name", F.lit(run_name))
    return out


def expectation_outcomes(results: DataFrame, severity: str = CRITICAL,
                         group_cols: Sequence[str] = ()) -> DataFrame:
    """Convert expectation results to flat outcome rows (one rule per expectation)."""
    rid = F.concat_ws("-", F.col("suite"), F.col("expectation_type"), F.col("column_name"))
    return results.select(
        *group_cols, rid.alias("rule_id"),
        F.when(F.col("success"), F.lit("Expectation met."))
         .otherwise(F.lit("Expectation failed.")).alias("description"),
        F.col("success").alias("passed"), F.lit(severity).alias("severity"),
        "element_count", "unexpected_count", "unexpected_percent", "missing_count")
