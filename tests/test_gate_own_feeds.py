"""The gate over feeds and rules of one's own: shops, sales and refunds."""

import pytest

from tollgate.operators.schema import SchemaDefinition
from tollgate.plans.gate import GateConfig, ReleaseGate, RuleSet
from tollgate.plans.rules import DateWindow, ForeignKey, Freshness, NumberRange, StatusMapping, TableCheck, UserRule, ValueSet
from tollgate.operators import contract

SHOPS = SchemaDefinition("shops", "shops.csv", ("shop", "state", "since"), {"shop": "string", "state": "string"}, ("since",), (("shop",),))
SALES = SchemaDefinition("sales", "sales.csv", ("id", "shop", "paid", "day", "amount"), {"id": "Int64", "shop": "string", "paid": "string", "amount": "float64"},
                         ("day",), (("id",), ("shop", "day")))
RULES = (
    ForeignKey("sales", "shops", "shop", "FK-1", "Every sale has a shop."),
    ForeignKey("refunds", "sales", "sale", "FK-2", "Every refund has a sale.", parent_column="id", file_name="refunds.csv"),
    StatusMapping("sales", "shops", "MAP", {"key": "shop", "outcome_col": "paid", "passing": ("yes",), "failing": ("no",), "status_col": "state",
                                            "ts_col": "since", "certified": ("open",)}),
    Freshness("sales", "day", hours=48, rule_id="FRESH"),
    NumberRange("sales", "amount", "AMOUNT", 0, 100),
    DateWindow("sales", "day", 1, "WINDOW"),
    ValueSet("shops", "state", ("open", "closed"), "STATE"),
    UserRule("SELECT bundle, 'SQL-1' AS rule_id, 'Sales are paid.' AS description, count_if(paid = 'no') = 0 AS passed, 'warning' AS severity FROM {sales} GROUP BY bundle"),
    TableCheck(lambda t, g, ref: contract.check_without_fact(t["shops"], t["sales"], "shop", group_cols=g)),
)


def bundle(root, name, **feeds):
    for feed, text in feeds.items():
        (root / name).mkdir(parents=True, exist_ok=True)
        (root / name / f"{feed}.csv").write_text(text)


@pytest.fixture(scope="module")
def report(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("own")
    shops = "shop,state,since\nA,open,2026-01-01\nB,closed,2026-01-01\n"
    bundle(root, "clean", shops=shops, sales="id,shop,paid,day,amount\n1,A,yes,2026-03-01,5\n2,B,no,2026-03-02,7.5\n")
    bundle(root, "faults", shops="shop,state,since\nA,open,2026-01-01\nA,shut,soon\n",
           sales="id,shop,paid,day,amount\n1,A,yes,2025-03-01,500\n1,C,yes,2026-02-20,x\n", refunds="sale,why\n1,late\n9,lost\n8,lost\n")
    bundle(root, "short", shops=shops, sales="id,shop,paid,day\n1,A,yes,2026-03-01\n")
    bundle(root, "alone", shops=shops)
    gate = ReleaseGate(spark, GateConfig(data_root=str(root), reference_ts="2026-03-02T12:00:00Z",
                                         rules=RuleSet(definitions=(SHOPS, SALES), declared=RULES, ordered_columns=True)))
    rep = gate.run()
    return rep, {(r.bundle, r.rule_id): r for r in rep.outcomes.collect()}


def failing(rows, name):
    return {rule for (b, rule), r in rows.items() if b == name and not r.passed}


def test_each_bundle_fails_its_own_rules(report):
    _, rows = report
    assert failing(rows, "clean") == {"SQL-1"}
    assert failing(rows, "faults") == {"shops-dtype-since", "shops-uniqueness-unique-1", "sales-dtype-amount", "sales-uniqueness-unique-1", "FK-1", "FK-2",
                                       "MAP-pass", "FRESH", "AMOUNT", "WINDOW", "STATE"}
    assert failing(rows, "short") == {"sales-required-columns", "sales-schema-ordered-columns", "AMOUNT", "BR-07-cert-without-attempt"}
    assert failing(rows, "alone") == {"sales-schema-file-present", "FRESH", "BR-07-cert-without-attempt"}


def test_counts_and_lists(report):
    rep, rows = report
    detail = lambda b, r: rows[b, r].details
    assert detail("faults", "FK-2")["missing_count"] == "2" and detail("faults", "FK-2")["sample_values"] == '["8", "9"]'
    assert detail("faults", "FK-1")["sample_values"] == '["C"]' and detail("faults", "shops-uniqueness-unique-1")["duplicate_count"] == "2"
    assert detail("short", "sales-required-columns")["missing_columns"] == '["amount"]' and detail("short", "AMOUNT")["missing_columns"] == '["amount"]'
    assert detail("faults", "AMOUNT")["invalid_format_count"] == "1" and detail("faults", "AMOUNT")["out_of_range_count"] == "1"
    lost = sorted(tuple(r) for r in rep.orphans.collect())
    assert lost == [("faults", "FK-1", "C"), ("faults", "FK-2", "8"), ("faults", "FK-2", "9")]


def test_every_run_reports_every_declared_rule_in_order(report):
    rep, rows = report
    names = {b: [r.rule_id for r in sorted((r for (x, _), r in rows.items() if x == b), key=lambda r: (r.seq, r.rule_id))] for b in ("clean", "faults", "alone")}
    fixed = [n for n in names["clean"] if n != "SQL-1"]
    assert fixed.index("FK-1") < fixed.index("MAP-fail") < fixed.index("FRESH") < fixed.index("AMOUNT") < fixed.index("WINDOW") < fixed.index("STATE")
    assert fixed[:2] == ["shops-schema-file-present", "sales-schema-file-present"]
    assert {"FK-1", "MAP-pass", "MAP-fail", "FRESH", "AMOUNT", "WINDOW", "STATE", "sales-uniqueness-unique-2"} <= set(names["alone"])


def test_runs_without_defects_have_a_defect_summary(report):
    rep, _ = report
    got = {r.bundle: r for r in rep.defect_summary().collect()}
    assert set(got) == {"clean", "faults", "short", "alone"} and got["clean"].defect_count == 1
    assert got["faults"].root_cause_counts["duplicate_record"] == 2


def test_a_rule_that_is_none(spark, tmp_path):
    bundle(tmp_path, "b", shops="shop,state,since\nA,open,2026-01-01\n")
    gate = ReleaseGate(spark, GateConfig(data_root=str(tmp_path), rules=RuleSet(definitions=(SHOPS,), declared=("no rule",))))
    with pytest.raises(TypeError):
        gate.run()
