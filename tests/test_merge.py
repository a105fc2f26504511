"""The merge: rule table, an exhaustive sweep over small domains, and its laws."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from strandloom.functions.expr import values_equal
from strandloom.operators import merge

CELL = "tsid string, field string, value string, dataset_id string"
RULES = [("cur", "merged", "curator", True), ("curfix", "merged", "curator", False), ("mach", "merged", "machine", False), ("shared", "merged", "shared", False), ("key", "key", None, False), ("old", "synonym", "curator", False)]


def registry(spark):
    return spark.createDataFrame(RULES, "qc_name string, role string, ownership string, nullable boolean")


def cells(spark, rows):
    return spark.createDataFrame([(t, f, v, "D") for t, f, v in rows], CELL)


EQUAL = [
    ("a", "a", True), (" a\n", "a", True), ("a", "b", False), (None, None, True), (None, "", False), ("1.0", "1", True), ("1", "1.00", True), ("40.12345", "40.1234", True), ("40.12", "40.13", False), ("1.2", "1.21", False), ("1.23", "1.2345", True), ("1770.79170", "1770.79167", False), ("1e3", "1000", True), ("0x1A", "26", False), ("1.5d", "1.5", False), ("", "", True), ("NA", "NA", True), ("1.004", "1.00", True), ("1.00", "1.001", True), ("1.004", "1.001", False),
]


def test_values_equal_table(spark):
    df = spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(EQUAL)], "i int, x string, y string")
    for a, b in (("x", "y"), ("y", "x")):
        got = {r.i: r.e for r in df.select("i", values_equal(a, b).alias("e")).collect()}
        assert [got[i] for i in range(len(EQUAL))] == [e for *_, e in EQUAL]
    assert not df.where(values_equal("x", "y", False) & (F.col("x") == "1.0")).count()


TABLE = [
    # field, base, sheet, file (None: no such cell), resolution, value
    ("cur", "a", "a", "a", "unchanged", "a"), ("cur", "a", "b", "a", "sheet", "b"), ("cur", "a", "a", "b", "file", "b"), ("cur", "a", "b", "b", "converged", "b"), ("cur", "a", "b", "c", "sheet", "b"),
    ("shared", "a", "b", "c", "conflict", "a"), ("mach", "a", "b", "a", "unchanged", "a"), ("mach", "a", "b", "c", "file", "c"), ("key", "a", "b", "c", "error", "a"), ("key", "a", "b", "a", "sheet", "b"), ("key", "1", "1.0", "1", "sheet", "1.0"),
    ("cur", "a", "", "a", "sheet", None), ("curfix", "a", "", "a", "unchanged", "a"), ("curfix", "a", "<<CLEAR>>", "a", "sheet", None), ("cur", "a", None, "a", "unchanged", "a"), ("cur", None, "b", None, "sheet", "b"), ("cur", None, None, "b", "file", "b"), ("unknown", "a", "b", "c", "conflict", "a"), ("cur", "1.50", "1.5", "1.50", "unchanged", "1.50"), ("mach", "a", "<<CLEAR>>", "a", "unchanged", "a"),
]


def test_rule_table(spark):
    sides = [cells(spark, [(str(i), row[0], row[k]) for i, row in enumerate(TABLE) if row[k] is not None]) for k in (1, 2, 3)]
    plan = {int(r.tsid): (r.resolution, r.value) for r in merge.merge_three_way(*sides, registry(spark)).collect()}
    assert [plan[i] for i in range(len(TABLE))] == [row[4:] for row in TABLE]


def expected(b, s, f, own, nullable):
    """The rules in plain code, over value, '' or None (no cell)."""
    blank = lambda x: x in (None, "")
    clears = s == "" and nullable and not blank(b)
    se, fe = None if clears else b if blank(s) else s, b if blank(f) else f
    s_ch, f_ch = se != b and own != "machine", fe != b
    if not s_ch and not f_ch:
        return "unchanged", b
    if s_ch != f_ch:
        return ("sheet", se) if s_ch else ("file", fe)
    return ("converged", se) if se == fe else ("sheet", se) if own == "curator" else ("file", fe) if own == "machine" else ("conflict", b)


@pytest.mark.parametrize("field,own,nullable", [("cur", "curator", True), ("curfix", "curator", False), ("mach", "machine", False), ("shared", "shared", False)])
def test_all_64_cases(spark, field, own, nullable):
    cases = list(product(("A", "B", None, ""), repeat=3))
    sides = [cells(spark, [(str(i), field, c[k]) for i, c in enumerate(cases) if c[k] is not None]) for k in range(3)]
    plan = {int(r.tsid): (r.resolution, r.value) for r in merge.merge_three_way(*sides, registry(spark)).collect()}
    for i, c in enumerate(cases):
        if any(v is not None for v in c):
            assert plan[i] == expected(*c, own, nullable), c
        else:
            assert i not in plan


def test_laws(spark):
    rows = [(str(i), f, v) for i, (f, v) in enumerate(product(("cur", "mach", "shared", "key"), ("x", "1.5", " y\n")))]
    same = cells(spark, rows)
    plan = merge.merge_three_way(same, same, same, registry(spark))
    assert plan.where("resolution <> 'unchanged'").count() == 0
    edited = same.withColumn("value", F.concat("value", F.lit("2")))
    first = merge.merge_three_way(same, edited, same, registry(spark)).where("resolution <> 'error'")
    state = merge.plan_state(first)
    again = merge.merge_three_way(state, edited, state, registry(spark))
    assert again.where("resolution <> 'unchanged'").count() == 0
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, merge.merge_three_way(same.repartition(5), edited.repartition(3), same, registry(spark)).where("resolution <> 'error'").collect()))
    assert merge.duplicate_cells(same.union(same.limit(2))).count() == 2


def test_synonym_roles_take_no_part_and_gate_raises(spark):
    one = cells(spark, [("1", "old", "x")])
    assert merge.merge_three_way(one, one, one, registry(spark)).count() == 0
    base, sheet, file = (cells(spark, [("1", "key", v)]) for v in "abc")
    with pytest.raises(ValueError, match="1 key errors"):
        merge.check_plan(merge.merge_three_way(base, sheet, file, registry(spark)))
    base, sheet, file = (cells(spark, [("1", "shared", v)]) for v in "abc")
    merge.check_plan(merge.merge_three_way(base, sheet, file, registry(spark)))
    with pytest.raises(ValueError):
        merge.check_plan(merge.merge_three_way(base, sheet, file, registry(spark)), strict=True)


def test_plan_has_no_python_and_one_exchange_of_cells(spark):
    side = cells(spark, [("1", "cur", "a")])
    text = merge.merge_three_way(side, side, side, registry(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and text.count("Exchange hashpartitioning(tsid") == 1
