"""Release gate over many bundles in one Spark job.

``ReleaseGate.run`` reads each declared feed across all bundles (one DataFrame
per feed, ``bundle`` column from the folder), has ``rules.RuleCompiler`` plan
every schema check and declared rule grouped by ``bundle``, and unions them
into one outcome table ``[bundle, rule_id, description, passed, severity,
details, seq]``. Reports (status, summaries, decision) are aggregations of that
table, so thousands of bundles cost one set of scans, not thousands of jobs.

Feeds and rules are descriptors (``RuleSet.definitions``, ``RuleSet.declared``);
without them the three certification feeds and their rules are gated.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import business, contract, custom, fusion
from ..operators.schema import SCHEMA_DEFINITIONS, SchemaDefinition
from ..outcome import to_outcomes
from ..session import cut_lineage, release_tables
from ..sources import csv_feeds, sinks
from ..sources.csv_feeds import BUNDLE_COL
from ..sources.run_store import RunStore
from . import reporting
from .rules import DateWindow, Feed, ForeignKey, Freshness, NumberRange, RuleCompiler, StatusMapping, TableCheck, UserRule

G = (BUNDLE_COL,)

GateTables = Mapping[str, DataFrame]
RuleCallable = Callable[[GateTables], DataFrame]


@dataclass(frozen=True)
class RuleSet:
    """What a run checks.

    definitions: the feeds to gate, in evaluation order, and declared: their
    rules as descriptors of ``plans.rules``; any feeds can be gated this way.
    ordered_columns: also ask for the declared column order. Without
    ``definitions`` the certification feeds named in ``feeds`` are gated, and
    without ``declared`` their rules, which the fields from ``business`` on set.

    prefixes: (feed, "dtype" or "uniqueness") -> rule id prefix, where the
    default is not wanted. business: rules (callables or SQL) that take the place of the default ones.
    contracts: names out of ``CONTRACTS``, checked after them.
    fresh_*: the feed, column and limits (hours) of the freshness rule;
    fresh_metadata names columns, or entries of ``GateConfig.metadata``, whose
    times count as well.
    """

    feeds: tuple[str, ...] = tuple(SCHEMA_DEFINITIONS)
    definitions: tuple[SchemaDefinition, ...] = ()
    declared: tuple[Any, ...] | None = None
    ordered_columns: bool = False
    prefixes: Mapping[tuple[str, str], str] = field(default_factory=dict)
    business: tuple[RuleCallable | str, ...] = ()
    contracts: tuple[str, ...] = ()
    # Score ranges (BR-04) and the exam date window (BR-06).
    ranges_and_window: bool = True
    fresh_feed: str = "exam_results"
    fresh_column: str | None = "file_received_ts"
    fresh_metadata: tuple[str, ...] = ()
    fresh_hours: float = 24
    fresh_warning_hours: float | None = None
    fresh_rule: str = "BR-08"
    # Optional feed: disciplinary flags must reference known candidates.
    flags_file: str | None = "disciplinary_flags.csv"

    def prefix(self, feed: str, kind: str) -> str:
        return self.prefixes.get((feed, kind), f"{feed}-{kind}")

    def schemas(self) -> list[SchemaDefinition]:
        return list(self.definitions) or [SCHEMA_DEFINITIONS[n] for n in self.feeds]

    def rules(self) -> list[Any]:
        """The descriptors of a run, in evaluation order."""
        if self.declared is not None:
            out = list(self.declared)
        elif self.business:
            out = [UserRule(r) for r in self.business]
        else:
            out = [ForeignKey("exam_results", "candidates", "candidate_id", "BR-07", "Every exam candidate_id exists in the master list."),
                   ForeignKey("certification_status", "candidates", "candidate_id", "BR-07b", "Every certification row references a known candidate."),
                   StatusMapping("exam_results", "certification_status", "BR-05", {"tie_cols": ("cert_status_id",)}),
                   Freshness(self.fresh_feed, self.fresh_column, self.fresh_metadata, self.fresh_hours, self.fresh_warning_hours, self.fresh_rule)]
            if self.ranges_and_window:
                out += [NumberRange("exam_results", "score", "BR-04-score"), NumberRange("exam_results", "score_scaled", "BR-04-score-scaled"),
                        DateWindow("exam_results", "exam_date", 12, "BR-06")]
            if self.flags_file:
                out.append(ForeignKey("disciplinary_flags", "candidates", "candidate_id", "BR-07c",
                                      "Every disciplinary flag references a known candidate.", file_name=self.flags_file))
        return [*out, *(TableCheck(CONTRACTS[n]) for n in self.contracts)]


#: Optional checks: name -> f(tables, group columns, reference time) giving a flat outcome frame.
CONTRACTS: dict[str, Callable[[GateTables, Sequence[str], Any], DataFrame]] = {
    "late_master": lambda t, g, ref: contract.check_late_master(
        t["exam_results"], t["candidates"], key="candidate_id", fact_time="file_received_ts", master_time="created_ts", group_cols=g),
    "arrival_lag": lambda t, g, ref: contract.check_arrival_lag(
        t["exam_results"], received_col="file_received_ts", event_col="exam_date", group_cols=g),
    "without_fact": lambda t, g, ref: contract.check_without_fact(t["certification_status"], t["exam_results"], "candidate_id", group_cols=g),
    "overlaps": lambda t, g, ref: contract.check_overlapping_intervals(
        t["certification_status"], ["candidate_id", "certification_level"], "certified_ts", "status_effective_ts", ["cert_status_id"], group_cols=g),
    "optional_metadata": lambda t, g, ref: contract.check_optional_metadata(t["exam_results"], ["exam_location"], group_cols=g),
    "feed_freshness": lambda t, g, ref: contract.feed_freshness(
        {"exam_results": (t["exam_results"], "file_received_ts"), "candidates": (t["candidates"], "created_ts")}, reference_ts=ref, rule_id="BR-08-feed", group_cols=g),
    "value_sets": lambda t, g, ref: fusion.run_flat(
        t["exam_results"], contract.value_set_check("pass_fail", business.PASSING_VALUES + business.FAILING_VALUES, "BR-10-pass-fail"), g),
}


@dataclass(frozen=True)
class GateConfig:
    data_root: str = "data"
    bundles: str | tuple[str, ...] = "*"
    reports_dir: str = "reports"
    rules: RuleSet = field(default_factory=RuleSet)
    reference_ts: str | _dt.datetime | None = None
    # Facts about the delivery, e.g. a receipt time that no feed column holds.
    metadata: Mapping[str, Any] = field(default_factory=dict)
    # Quoted fields may hold line breaks; a file is then the work of one task.
    multi_line: bool = True
    materialize_outcomes: bool = True


class ReleaseGate:
    def __init__(self, spark: SparkSession, config: GateConfig) -> None:
        self.spark = spark
        self.config = config
        self._report: GateReport | None = None
        self._tables: list[DataFrame] = []

    # -- loading ---------------------------------------------------------
    def load(self) -> dict[str, Feed]:
        cfg = self.config
        defs = cfg.rules.schemas()
        feeds: dict[str, Feed] = {}
        loaded = csv_feeds.load_bundles(self.spark, cfg.data_root, defs, cfg.bundles, cfg.multi_line)
        for d in defs:
            raw, headers = loaded[d.name]
            if raw is None:
                raise FileNotFoundError(
                    f"Missing ingest files: no {d.file_name} under {cfg.data_root}")
            # Each CSV is parsed once: all rules read the written feed.
            written = cut_lineage(raw, self.spark)
            self._tables += [written, headers]
            raw = written.withColumns({k: v for k, v in self._metadata().items() if k not in written.columns})
            feeds[d.name] = Feed(d.name, raw, csv_feeds.typed_view(raw, d), headers,
                                 csv_feeds._existing(self.spark, csv_feeds.feed_glob(cfg.data_root, d.file_name, cfg.bundles)))
        return feeds

    def _reference(self):
        return self.config.reference_ts if self.config.reference_ts is not None else F.current_timestamp()

    def _metadata(self) -> dict:
        return {k: F.lit(str(v)) for k, v in self.config.metadata.items() if v is not None}

    # -- rules -------------------------------------------------------------
    def _read_optional(self, file_name: str) -> DataFrame | None:
        """A feed that runs may leave out, as texts; None when no run has the file."""
        paths = csv_feeds._existing(self.spark, csv_feeds.feed_glob(self.config.data_root, file_name, self.config.bundles))
        return csv_feeds.read_feed(self.spark, paths, multi_line=self.config.multi_line) if paths else None

    def _compile(self, feeds: dict[str, Feed]) -> RuleCompiler:
        cfg = self.config
        runs = None
        for f in feeds.values():
            b = f.headers.select(BUNDLE_COL)
            runs = b if runs is None else runs.unionByName(b)
        self._runs = cut_lineage(runs.distinct(), self.spark)
        self._tables.append(self._runs)
        plan = RuleCompiler(self.spark, feeds, self._runs, self._reference(), self._metadata(), cfg.multi_line, self._read_optional)
        plan.schemas(cfg.rules.schemas(), cfg.rules.prefix, cfg.rules.ordered_columns)
        plan.rules(cfg.rules.rules())
        self._tables += plan.written
        return plan

    def run(self, extra_rules: Sequence[RuleCallable | str] = ()) -> "GateReport":
        feeds = self.load()
        tables = {n: f.typed for n, f in feeds.items()}
        plan = self._compile(feeds)
        parts = plan.finish()
        for i, r in enumerate(extra_rules):
            parts.append(to_outcomes(custom.run_rule(r, tables, self.spark, G), G)
                         .withColumn("seq", F.lit(plan.next_seq + i)))
        cols = [*G, "rule_id", "description", "passed", "severity", "details", "seq"]
        outcomes = None
        for p in parts:
            p = p.select(*cols)
            outcomes = p if outcomes is None else outcomes.unionByName(p)
        if self.config.materialize_outcomes:
            # Written once under the checkpoint folder so every report reads it
            # without re-running the checks. "rebalance" lets AQE size the
            # files by its advisory partition size (bundles x rules rows), so a
            # small run writes one file instead of one per union partition.
            outcomes = cut_lineage(outcomes.hint("rebalance"), self.spark)
        orphans = None
        for o in plan.orphans:
            orphans = o if orphans is None else orphans.unionByName(o)
        self._report = GateReport(outcomes, self._runs, orphans=orphans)
        return self._report

    def __enter__(self) -> "ReleaseGate":
        return self

    def __exit__(self, *_: Any) -> None:
        self.close()

    def close(self) -> None:
        """Remove the tables written by ``run``; its reports must be stored by then."""
        release_tables(*self._tables, *([self._report.outcomes] if self._report else []))
        self._tables, self._report = [], None

    def run_checkpoint(self, run_name: str | None = None, store_path: str | None = None) -> DataFrame:
        """The feed expectation suites over all bundles (results per bundle);
        appended to ``store_path`` partitioned by suite and run when given."""
        from . import suites
        feeds = self.load()
        res = suites.run_feed_checkpoint({n: f.typed for n, f in feeds.items()},
                                         {n: f.headers for n, f in feeds.items()}, run_name)
        if store_path:
            sinks.store_results(res, store_path, run_name)
        return res

    def store(self, store: RunStore, run_name: str) -> None:
        """Publish the run's outcomes under a name; a retry of the name replaces them as a whole."""
        if self._report is None:
            raise RuntimeError("no reports yet: call run() first")
        store.write(self._report.outcomes, run_name)

    @property
    def report(self) -> "GateReport | None":
        return self._report

    def write_reports(self, report_dir: str | None = None) -> str:
        if self._report is None:
            raise RuntimeError("no reports yet: call run() first")
        return self._report.write(report_dir or self.config.reports_dir)


class GateReport:
    """Reports over a gate's outcome table (one row per bundle each)."""

    def __init__(self, outcomes: DataFrame, runs: DataFrame | None = None,
                 timestamp: _dt.datetime | None = None, orphans: DataFrame | None = None) -> None:
        self.outcomes = outcomes
        self.runs = runs
        #: Complete orphan lists of the foreign key rules: (bundle, rule_id, missing_value).
        self.orphans = orphans
        self.timestamp = timestamp or _dt.datetime.now(_dt.timezone.utc)

    @property
    def keys(self) -> list[str]:
        return [BUNDLE_COL] if BUNDLE_COL in self.outcomes.columns else []

    def status(self) -> DataFrame:
        return reporting.gate_status(self.outcomes, self.keys, self.runs)

    def validation_summary(self) -> DataFrame:
        return reporting.validation_summary(self.outcomes, self.keys)

    def defect_summary(self) -> DataFrame:
        return reporting.defect_summary(self.outcomes, self.keys, self.runs)

    def release_decision(self) -> DataFrame:
        return reporting.release_decision(self.outcomes, self.keys, self.runs)

    def write(self, directory: str) -> str:
        ts = self.timestamp.isoformat()
        out = sinks.write_reports({"validation_summary": self.validation_summary(),
                                   "defect_summary": self.defect_summary(),
                                   "release_decision": self.release_decision()},
                                  directory, self.keys, ts)
        if self.orphans is not None:
            sinks.write_json_report(self.orphans, f"{out}/missing_values", self.keys)
        return out
