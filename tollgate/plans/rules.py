"""Rules of a gate as descriptors, and the compiler that plans them together.

A gate's feeds are ``SchemaDefinition``s, its rules the descriptors below; none
of it names a column of any particular feed. ``RuleCompiler`` turns them into
as few plans as the rules allow:

* what the header answers (presence, required and ordered columns) is one small
  frame a feed;
* every check that one pass can answer (malformed records, type audit, ranges,
  windows, value sets, freshness) joins the one aggregation of its feed;
* all uniqueness keys of a feed share one scan and one exchange;
* foreign keys to the same parent key share one anti join and one outcome plan:
  child keys carry their rule's id, the parent's keys are shuffled once.

Every run gets every rule: a run whose feed is empty or lacks a column gets
what the rule says of that.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import business, contract, custom, duplicates, fusion, schema
from ..operators.integrity import SAMPLE_SIZE, first_n, orphan_keys, orphan_outcomes
from ..operators.schema import SchemaDefinition
from ..outcome import CRITICAL, WARNING, finish, json_list, to_outcomes
from ..session import cut_lineage
from ..sources import csv_feeds
from ..sources.csv_feeds import BUNDLE_COL, MTIME_COL, ORDER_COL

G = (BUNDLE_COL,)


@dataclass
class Feed:
    """A loaded feed: raw texts, typed view, header rows and the globs that found it."""

    name: str
    raw: DataFrame
    typed: DataFrame
    headers: DataFrame
    paths: list[str]

    def none(self) -> DataFrame:
        """The typed feed without rows."""
        return self.typed.where(F.lit(False))


@dataclass(frozen=True)
class ForeignKey:
    """Every non-null ``column`` of ``child`` is a ``parent_column`` of ``parent`` in the same run.

    ``file_name``: the child is an optional feed, read when any run has the file.
    """

    child: str
    parent: str
    column: str
    rule_id: str
    description: str
    parent_column: str | None = None
    file_name: str | None = None


@dataclass(frozen=True)
class StatusMapping:
    """Outcomes in ``facts`` agree with the latest status in ``statuses``; options go to the operator."""

    facts: str
    statuses: str
    rule_id: str = "BR-05"
    options: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Freshness:
    """The newest time of ``column`` and ``metadata`` columns, else the file's, is recent."""

    feed: str
    column: str | None = None
    metadata: tuple[str, ...] = ()
    hours: float = 24
    warning_hours: float | None = None
    rule_id: str = "BR-08"


@dataclass(frozen=True)
class NumberRange:
    feed: str
    column: str
    rule_id: str
    low: float = 0
    high: float = 100


@dataclass(frozen=True)
class DateWindow:
    feed: str
    column: str
    months: int = 12
    rule_id: str = "BR-06"


@dataclass(frozen=True)
class ValueSet:
    feed: str
    column: str
    values: tuple
    rule_id: str
    severity: str = WARNING


@dataclass(frozen=True)
class UserRule:
    """A callable or SQL text over all typed feeds."""

    rule: Callable[[Mapping[str, DataFrame]], DataFrame] | str


@dataclass(frozen=True)
class TableCheck:
    """f(tables, group columns, reference time) -> flat outcomes; also asked about empty tables."""

    check: Callable[[Mapping[str, DataFrame], Sequence[str], Any], DataFrame]


class RuleCompiler:
    """Outcome frames (with ``seq``, the order of evaluation) of a set of declared feeds and rules."""

    def __init__(self, spark: SparkSession, feeds: Mapping[str, Feed], runs: DataFrame, reference: Any,
                 metadata: Mapping[str, Any], multi_line: bool, read_optional: Callable[[str], DataFrame | None]) -> None:
        self.spark, self.feeds, self.runs, self.reference = spark, dict(feeds), runs, reference
        self.metadata, self.multi_line, self.read_optional = metadata, multi_line, read_optional
        self.parts: list[DataFrame] = []
        self.written: list[DataFrame] = []
        #: (bundle, rule_id, missing_value) frames of the foreign keys.
        self.orphans: list[DataFrame] = []
        self.next_seq = 0  # rules are numbered in their order, from 0
        self._fused: dict[str, list[tuple[int, fusion.AggCheck]]] = {n: [] for n in feeds}
        self._needs: dict[str, dict[str, list[str]]] = {n: {} for n in feeds}

    # -- placing rules ---------------------------------------------------------
    def take(self, n: int = 1) -> int:
        """The place of the next rule, or of the first of ``n``."""
        self.next_seq += n
        return self.next_seq - n

    def add(self, flat: DataFrame, empty: DataFrame | None = None, seqs: Mapping[str, int] | None = None) -> None:
        """Rows of one rule, or of the rules in ``seqs`` (rule id -> place).

        ``empty``: what the rules say of an empty feed, for runs without rows.
        """
        if empty is not None:
            flat = fusion.fill_groups(flat, empty, self.runs, G)
        if seqs is None:
            seq = F.lit(self.take())
        else:
            seq = F.element_at(F.create_map(*[F.lit(x) for kv in seqs.items() for x in kv]), F.col("rule_id"))
        self.parts.append(to_outcomes(flat, G).withColumn("seq", seq))

    def fuse(self, feed: str, check: fusion.AggCheck, needs: Mapping[str, Sequence[str]] | None = None, seq: int | None = None) -> None:
        """A check that joins its feed's one aggregation; ``needs``: rule id -> columns a file must have."""
        self._fused[feed].append((self.take() if seq is None else seq, check))
        self._needs[feed].update({k: list(v) for k, v in (needs or {}).items()})

    # -- feeds --------------------------------------------------------------------
    def schemas(self, definitions: Sequence[SchemaDefinition], prefix: Callable[[str, str], str], ordered: bool = False) -> None:
        """Presence of every feed file, then header, malformed records, declared types and keys of each feed."""
        present = {d.name: self.take() for d in definitions}
        for d in definitions:
            self._feed(d, present[d.name], prefix(d.name, "dtype"), prefix(d.name, "uniqueness"), ordered)

    def _feed(self, d: SchemaDefinition, present: int, dtype_prefix: str, uniqueness_prefix: str, ordered: bool) -> None:
        f = self.feeds[d.name]
        rows = self.runs.join(f.headers.select(BUNDLE_COL, "columns"), BUNDLE_COL, "left").withColumn("present", F.col("columns").isNotNull())
        have = rows.where("present")
        self.parts.append(to_outcomes(finish(
            rows, rule_id=f"{d.name}-schema-file-present", passed=F.col("present"), severity_fail=CRITICAL, description_pass="Feed file is present.",
            description_fail=f"Missing ingest file {d.file_name}.", keep=[F.lit(d.file_name).alias("file_name")], group_cols=G), G).withColumn("seq", F.lit(present)))
        self.add(schema.required_columns_by_file(have, d.required_columns, f"{d.name}-required-columns", group_cols=G))
        if ordered:
            self.add(schema.ordered_columns_by_file(have, d.required_columns, f"{d.name}-schema-ordered-columns", group_cols=G))
        self._malformed(f)
        declared = {**d.dtype_map, **dict.fromkeys(d.parse_dates, "datetime64[ns]")}
        self.fuse(d.name, schema.dtype_audit_check(f.raw, declared, dtype_prefix, emit_passed=False))
        if d.uniqueness_constraints:
            keys = d.uniqueness_constraints
            unique = duplicates.check_uniqueness(f.typed, keys, uniqueness_prefix, group_cols=G, groups=self.runs)
            needs = {f"{uniqueness_prefix}-unique-{i}": list(k) for i, k in enumerate(keys, start=1)}
            first = self.take(len(keys))
            self.add(_require_columns(unique, f.headers, needs, CRITICAL, "Uniqueness key columns are missing."),
                     seqs={rule: first + i for i, rule in enumerate(needs)})

    def _malformed(self, f: Feed) -> None:
        """Records that do not fit their header, per run."""
        texts = ("Every record fits its header.", "Records with surplus fields or unclosed quotes found.")
        if self.multi_line:
            def build(p: str):
                n = F.col(f"{p}surplus")
                return [F.count_if(F.col(csv_feeds.SURPLUS_COL).isNotNull()).alias(f"{p}surplus")], [fusion.Row(
                    F.lit(f"{f.name}-schema-malformed-rows"), F.when(n == 0, F.lit(texts[0])).otherwise(F.lit(texts[1])), n == 0, F.lit(CRITICAL), {"malformed_rows": n})]

            self.fuse(f.name, fusion.AggCheck(build))
            return
        m = f.raw.groupBy(BUNDLE_COL).agg(F.count_if(F.col(csv_feeds.SURPLUS_COL).isNotNull()).alias("surplus"))
        m = self.runs.join(m, BUNDLE_COL, "left").join(csv_feeds.unclosed_quotes(self.spark, f.paths), BUNDLE_COL, "left")
        n = F.coalesce("surplus", F.lit(0)) + F.coalesce("unclosed", F.lit(0))
        self.add(finish(m.withColumn("malformed_rows", n), rule_id=f"{f.name}-schema-malformed-rows", passed=F.col("malformed_rows") == 0,
                        severity_fail=CRITICAL, description_pass=texts[0], description_fail=texts[1], keep=["malformed_rows"], group_cols=G))

    # -- rules --------------------------------------------------------------------
    def rules(self, declared: Sequence[Any]) -> None:
        """Plan the descriptors, in order."""
        keys = {r: self.next_seq + i for i, r in enumerate(declared) if isinstance(r, ForeignKey)}
        tables = {n: f.typed for n, f in self.feeds.items()}
        self._foreign_keys(keys)
        for r in declared:
            if isinstance(r, ForeignKey):
                self.take()  # planned above, together
            elif isinstance(r, StatusMapping):
                self.add(business.check_pass_fail_certification(tables[r.facts], tables[r.statuses], r.rule_id, group_cols=G, groups=self.runs,
                                                                **{"order_col": ORDER_COL, **r.options}))
            elif isinstance(r, Freshness):
                self.fuse(r.feed, business.freshness_check(
                    self.feeds[r.feed].raw, reference_ts=self.reference, timestamp_column=r.column, metadata_columns=r.metadata,
                    file_time_column=MTIME_COL, max_allowed_hours=r.hours, warning_hours=r.warning_hours, rule_id=r.rule_id))
            elif isinstance(r, NumberRange):
                self.fuse(r.feed, business.score_range_check(self.feeds[r.feed].raw, r.column, r.rule_id, r.low, r.high), {r.rule_id: [r.column]})
            elif isinstance(r, DateWindow):
                self.fuse(r.feed, business.date_window_check(self.feeds[r.feed].raw, self.reference, r.months, r.rule_id, r.column))
            elif isinstance(r, ValueSet):
                self.fuse(r.feed, contract.value_set_check(r.column, r.values, r.rule_id, r.severity), {r.rule_id: [r.column]})
            elif isinstance(r, UserRule):
                self.add(custom.run_rule(r.rule, tables, self.spark, G))
            elif isinstance(r, TableCheck):
                none = {n: f.none() for n, f in self.feeds.items()}
                self.add(r.check(tables, G, self.reference), r.check(none, (), self.reference))
            else:
                raise TypeError(f"not a rule: {r!r}")

    def _foreign_keys(self, keys: Mapping[ForeignKey, int]) -> None:
        """Plan the foreign keys (rule -> place): one anti join and one outcome frame for each parent key."""
        shared: dict[tuple, list[tuple[ForeignKey, DataFrame]]] = {}
        for k in keys:
            child = self.read_optional(k.file_name) if k.file_name else self.feeds[k.child].typed
            if child is None:
                continue
            parent_column = k.parent_column or k.column
            same = dict(child.dtypes)[k.column] == dict(self.feeds[k.parent].typed.dtypes)[parent_column]
            shared.setdefault((k.parent, parent_column, same), []).append((k, child))
        for (parent, parent_column, same), group in shared.items():
            value = (lambda c: F.col(f"`{c}`")) if same else (lambda c: F.col(f"`{c}`").cast("string"))
            tagged = runs = None
            for k, child in group:
                t = child.select(BUNDLE_COL, F.lit(k.rule_id).alias("rule_id"), value(k.column).alias("key"))
                tagged = t if tagged is None else tagged.unionByName(t)
                # an optional feed is judged where it is delivered
                r = (child.select(BUNDLE_COL).distinct() if k.file_name else self.runs).select(BUNDLE_COL, F.lit(k.rule_id).alias("rule_id"), F.lit(k.description).alias("text"))
                runs = r if runs is None else runs.unionByName(r)
            lost = cut_lineage(orphan_keys(tagged, self.feeds[parent].typed.select(BUNDLE_COL, value(parent_column).alias("key")), "key",
                                           group_cols=G, carry=["rule_id"]).hint("rebalance"), self.spark)
            self.written.append(lost)
            self.orphans.append(lost.select(BUNDLE_COL, "rule_id", F.col("key").cast("string").alias("missing_value")))
            each = [BUNDLE_COL, "rule_id"]
            counts = lost.groupBy(*each).agg(F.count(F.lit(1)).alias("missing_count"))
            sample = first_n(lost, ["key"], SAMPLE_SIZE, F.col("key").cast("string"), each, "sample_values")
            m = runs.join(counts.join(sample, each), each, "left").select(
                *each, "text", F.coalesce("missing_count", F.lit(0)).alias("missing_count"),
                F.coalesce("sample_values", F.array().cast("array<string>")).alias("sample_values"))
            self.add(orphan_outcomes(m, F.col("rule_id"), F.col("text"), group_cols=G), seqs={k.rule_id: keys[k] for k, _ in group})

    def finish(self) -> list[DataFrame]:
        """All outcome frames; the fused checks of a feed are one aggregation."""
        for name, checks in self._fused.items():
            if checks:
                f = self.feeds[name]
                groups = self.runs.join(csv_feeds.file_times(self.spark, f.paths), BUNDLE_COL, "left").withColumns(dict(self.metadata))
                out = fusion.fused(f.raw, [c for _, c in checks], G, seqs=[q for q, _ in checks], groups=groups)
                if self._needs[name]:
                    out = _require_columns(out, f.headers, self._needs[name], WARNING)
                self.parts.append(out)
        self._fused = {}
        return self.parts


def _require_columns(rows: DataFrame, headers: DataFrame, rule_columns: Mapping[str, Sequence[str]], severity: str,
                     description: str | None = None) -> DataFrame:
    """Fail a rule for runs whose file lacks a column it needs; works on flat frames and on outcome rows.

    ``rule_columns``: rule id -> columns; a flat frame gets the list as
    ``missing_columns``, an outcome row in its details.
    """
    have = headers.groupBy(BUNDLE_COL).agg(F.flatten(F.collect_list("columns")).alias("__have"))
    need = F.try_element_at(F.create_map(*[x for rid, cols in rule_columns.items()
                                           for x in (F.lit(rid), F.array(*[F.lit(c) for c in cols]))]), F.col("rule_id"))
    # a run without the file has no header to blame; its absence is an outcome of its own
    missing = F.coalesce(F.array_except(need, F.col("__have")), F.array().cast("array<string>"))
    lacking = F.size("__missing") > 0
    text = F.lit(description) if description else F.concat(F.lit("Column '"), F.array_join("__missing", "', '"), F.lit("' is missing."))
    out = (rows.join(have, BUNDLE_COL, "left").withColumn("__missing", missing)
           .withColumn("passed", F.when(lacking, F.lit(False)).otherwise(F.col("passed")))
           .withColumn("severity", F.when(lacking, F.lit(severity)).otherwise(F.col("severity")))
           .withColumn("description", F.when(lacking, text).otherwise(F.col("description"))))
    if "details" in rows.columns:
        out = out.withColumn("details", F.when(lacking, F.map_concat("details", F.create_map(F.lit("missing_columns"), json_list(F.col("__missing")))))
                             .otherwise(F.col("details")))
    else:
        out = out.withColumn("missing_columns", F.col("__missing"))
    return out.drop("__have", "__missing")
