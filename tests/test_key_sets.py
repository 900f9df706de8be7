"""Many key sets and many suites in one pass: results against single checks, and the plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import sf_dir
from tollgate.operators import duplicates, expectations as ex, schema
from tollgate.plans import catalog


def frame(spark, n=400, groups=3, seed=1):
    rng = random.Random(seed)
    pick = lambda v: rng.choice([*v, None])
    rows = [(f"g{rng.randrange(groups)}", pick(range(6)), pick("abc"), pick([0.0, -0.0, float("nan"), 1.5]), "hot" if rng.random() < 0.4 else pick("xyz")) for _ in range(n)]
    return spark.createDataFrame(rows, "g string, a int, b string, `d.x` double, text string")


SETS = [("a",), ("a", "b"), ("b", "a"), ("d.x",), ("text", "d.x"), ("a", "b", "text"), ("a",)]


@pytest.mark.parametrize("group", [(), ("g",)])
@pytest.mark.parametrize("hashed", [(), ("text",)])
def test_key_sets_match_single_checks(spark, group, hashed):
    df = frame(spark)
    got = {tuple(r[c] for c in group) + (r.rule_id,): r for r in duplicates.check_uniqueness(df, SETS, "u", group_cols=group, hashed=hashed).collect()}
    one = duplicates.validate_uniqueness_constraints(df, SETS, "u", group_cols=group, hashed=hashed)
    want = [r for f in one for r in f.collect()]
    assert len(got) == len(want)
    for r in want:
        assert got[tuple(r[c] for c in group) + (r.rule_id,)].asDict() == r.asDict()


def test_key_sets_of_an_empty_table_pass(spark):
    got = duplicates.check_uniqueness(frame(spark).limit(0), SETS, "u").collect()
    assert len(got) == len(SETS) and all(r.passed and r.duplicate_count == 0 for r in got)


def executed(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0] if "== Initial Plan ==" in plan else plan


def test_one_scan_and_one_exchange_of_keys(spark):
    d = sf_dir("0.001")
    plan = executed(catalog.q_uniqueness_multi(spark, d))
    assert len(re.findall(r"FileScan parquet", plan)) == 1 and len(re.findall(r"hashpartitioning", plan)) == 1


def test_checkpoint_scans_each_table_once(spark):
    d = sf_dir("0.001")
    plan = catalog.q_expectation_results(spark, d)._jdf.queryExecution().optimizedPlan().toString()
    read = re.findall(r"Relation \[(.*?)\] parquet", plan)
    count = lambda column: sum(f"{column}#" in cols for cols in read)
    assert [count(c) for c in ("l_shipdate", "lang", "quality")] == [1, 1, 1]
    # orders appears again in the bounds that lineitem is checked against, one subquery when it runs
    assert len({cols for cols in read}) == 4


def slow(df, group, e):
    """Counts of one expectation row by row."""
    out = {}
    rows = df.collect()
    keys = [e.column] if e.column is not None else list(e.column_list)
    norm = lambda v: "nan" if isinstance(v, float) and v != v else (v + 0.0 if isinstance(v, float) else v)
    for r in rows:
        out.setdefault(tuple(r[c] for c in group), []).append(tuple(norm(r[k]) for k in keys))
    counts = {}
    for g, vals in out.items():
        if e.expectation_type.endswith("to_be_unique"):
            null = (lambda v: all(x is None for x in v)) if e.column is None else (lambda v: v[0] is None)
            live = [v for v in vals if not null(v)]
            counts[g] = (len(vals), len(vals) - len(live), sum(live.count(v) > 1 for v in live))
        else:
            v = [x[0] for x in vals]
            if e.expectation_type.endswith("not_be_null"):
                bad = sum(x is None for x in v)
            elif e.expectation_type.endswith("in_set"):
                bad = sum(x is not None and x not in e.value_set for x in v)
            else:
                bad = sum(x is not None and (e.min_value is not None and x < e.min_value or e.max_value is not None and x > e.max_value) for x in v)
            counts[g] = (len(v), sum(x is None for x in v), bad)
    return counts


@pytest.mark.parametrize("group", [(), ("g",)])
def test_suites_of_one_table_match_row_by_row_counts(spark, group):
    df = frame(spark, seed=2)
    one = [ex.not_null("a"), ex.unique("b"), ex.between("a", 1, 4), ex.in_set("text", ["hot", "x"], mostly=0.5), ex.compound_unique(["a", "b"])]
    two = [ex.between("a", None, 2) for _ in range(45)] + [ex.unique("text"), ex.ordered_columns(["g", "a", "b", "d.x", "text"]), ex.unique("d.x")]
    res = ex.run_checkpoint([("x", df, "one", one), ("y", df, "two", two)], group_cols=group).collect()
    suites = {"one": one, "two": two}
    assert len(res) == (len(one) + len(two)) * (3 if group else 1)
    for r in res:
        e = suites[r.suite][r.expectation_index]
        assert r.batch_identifier == ("x" if r.suite == "one" else "y") and r.expectation_type == e.expectation_type
        if e.expectation_type == ex._ORDERED:
            assert r.success and r.unexpected_count is None and r.missing_count is None
            continue
        n, missing, bad = slow(df, group, e)[tuple(r[c] for c in group)]
        assert (r.element_count, r.unexpected_count) == (n, bad), e
        assert r.missing_count == (None if e.expectation_type.endswith("not_be_null") else missing)


def test_unresolved_bounds_are_told_per_group(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 3, None)], "g string, v int, hi int")
    rows = {r.g: r for r in ex.run_suite(df, "s", [ex.between("v", None, ex.Param("hi"))], {"hi": F.col("hi")}, ["g"]).collect()}
    assert rows["a"].success and rows["a"].bounds_resolved and not rows["b"].success and not rows["b"].bounds_resolved


def test_schema_definition_without_a_key_column(spark):
    d = schema.SchemaDefinition("t", "t.csv", ("a", "b"), {"a": "Int64", "b": "string"}, uniqueness_constraints=(("a",), ("zz",)))
    df = spark.createDataFrame([("1", "x"), ("1", "y")], "a string, b string")
    rows = {r.rule_id: r for f in schema.apply_schema_definition(df, d)[1] for r in f.collect()}
    assert rows["t-uniqueness-unique-1"].details["duplicate_count"] == "2" and rows["t-uniqueness-unique-2"].details["missing_columns"] == '["zz"]'


@pytest.mark.parametrize("group", [(), ("g",)])
def test_heavy_values_give_the_exact_list(spark, group):
    """Zipf-like counts over many values, ties at the last place, few values, and hash counters that collide."""
    rng = random.Random(5)
    rows = [(f"g{i % 3}", f"v{int(rng.paretovariate(0.7)) % 4000}") for i in range(20_000)] + [("few", "x"), ("few", "y"), ("few", "x"), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v string")
    counts = {}
    for g, v in rows:
        if v is not None:
            k = (g if group else None, v)
            counts[k] = counts.get(k, 0) + 1
    got = ex.partial_repeats(df, 0, ex.unique("v"), list(group)).collect()
    assert len(got) == (4 if group else 1)
    for r in got:
        key = r.g if group else None
        want = sorted(((v, n) for (g, v), n in counts.items() if g == key and n > 1), key=lambda x: (-x[1], x[0]))[:20]
        assert [(x["value"], x["count"]) for x in r.partial_unexpected_counts] == want


def test_heavy_values_count_few_of_many_distinct_values(spark):
    df = spark.range(200_000).selectExpr("if(id % 4 = 0, 'hot' || (id % 200), 'cold' || id) as v")
    got = ex.heavy_values(df, [], "v", 20)
    n = got.count()
    assert 50 <= n < 5_000  # of 150,050 distinct values
